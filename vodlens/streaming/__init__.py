"""Structured Streaming ingest of raw logs (clean on arrival, land by day)."""

from .ingest import file_log_stream, kafka_log_stream, start_ingest

__all__ = ["file_log_stream", "kafka_log_stream", "start_ingest"]
