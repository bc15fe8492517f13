"""Load-once file ingestion on Structured Streaming."""
