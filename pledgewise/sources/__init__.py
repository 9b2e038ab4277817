"""Readers and writers of filings, records, review queues and releases."""
