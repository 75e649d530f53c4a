"""Column functions; all are built-in Spark expressions, no Python workers."""

from chargetrail.functions.scalar import (
    date_part_columns,
    energy_delta,
    epoch_seconds,
    hours_between,
    instant,
    parse_timestamp,
    positive_flag,
    rounded_double,
    table_name,
)

__all__ = [
    "date_part_columns",
    "energy_delta",
    "epoch_seconds",
    "hours_between",
    "instant",
    "parse_timestamp",
    "positive_flag",
    "rounded_double",
    "table_name",
]
