"""Incremental ingestion (Structured Streaming availableNow and the keyset page loop)."""

from .ingest import RunCounters, backfill_json, ingest_pages, ingest_planned, ingest_stream, ingest_stream_deltas, land_as_json, start_ingest_stream

__all__ = ["RunCounters", "backfill_json", "ingest_pages", "ingest_planned", "ingest_stream", "ingest_stream_deltas", "land_as_json", "start_ingest_stream"]
