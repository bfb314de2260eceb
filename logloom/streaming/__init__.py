"""Incremental form of the log aggregation (Structured Streaming)."""

from .logs import aggregate_logs_stream, start_csv_stream, stream_logs, utc_session

__all__ = ["aggregate_logs_stream", "start_csv_stream", "stream_logs", "utc_session"]
