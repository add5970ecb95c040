"""Incremental ingestion of newly landed files."""

from washline.streaming.ingest import ingest_stream, read_ledger, read_profile

__all__ = ["ingest_stream", "read_ledger", "read_profile"]
