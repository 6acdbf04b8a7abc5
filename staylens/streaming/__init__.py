"""Structured Streaming jobs: stream landing (A1/A6) and dead-letter alerts."""
