"""File arrival as a stream: ingest, upsert and refresh per micro-batch."""
