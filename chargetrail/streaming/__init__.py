"""Structured Streaming jobs."""

from chargetrail.streaming.run import rocksdb_state, run_to_end, stop_all
from chargetrail.streaming.keyindex import KeyIndex
from chargetrail.streaming.sinks import (
    append_files,
    append_first,
    compact,
    current_view,
    is_late,
    latest_view,
    rows_dropped,
    split_late,
    upsert_log,
)
from chargetrail.streaming.sources import enrich, file_stream, rate_stream, replay
from chargetrail.streaming.status import status_events, windowed_status_counts

__all__ = [
    "KeyIndex",
    "append_files",
    "append_first",
    "compact",
    "current_view",
    "enrich",
    "file_stream",
    "is_late",
    "latest_view",
    "rate_stream",
    "replay",
    "rocksdb_state",
    "rows_dropped",
    "run_to_end",
    "split_late",
    "status_events",
    "stop_all",
    "upsert_log",
    "windowed_status_counts",
]
