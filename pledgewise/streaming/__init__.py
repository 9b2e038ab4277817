"""Incremental runs: file streams, watermarks and merges."""
