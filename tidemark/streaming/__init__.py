"""Structured Streaming forms of the capture operators."""

from tidemark.streaming.state import drop_redelivery, latest_state, use_rocksdb
from tidemark.streaming.upsert import (
    drain_staleness, stream_capture, stream_change_log, stream_changes, stream_upsert,
)

__all__ = ["drain_staleness", "drop_redelivery", "latest_state", "stream_capture",
           "stream_change_log", "stream_changes", "stream_upsert", "use_rocksdb"]
