"""Readers for event logs, lake tables and catalog tables."""

from chargetrail.sources.files import (
    has_delta,
    read_csv_log,
    read_json_records,
    read_last_minute,
    read_parquet,
    read_table,
    read_time_slice,
    spread,
)
from chargetrail.sources.index import with_row_index

__all__ = [
    "has_delta",
    "read_csv_log",
    "read_json_records",
    "read_last_minute",
    "read_parquet",
    "read_table",
    "read_time_slice",
    "spread",
    "with_row_index",
]
