"""Spark jobs that track published guidance against what later filings report."""
