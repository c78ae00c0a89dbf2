"""Streaming ingestion of the visit-log text format (the analysis is batch)."""

from visitlens.streaming.ingest import start_ingest, visit_text_stream

__all__ = ["start_ingest", "visit_text_stream"]
