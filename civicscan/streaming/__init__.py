"""Incremental (Structured Streaming) form of the page-date job."""
