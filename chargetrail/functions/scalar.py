"""Scalar functions over message columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chargetrail.schemas import TYPE_LABELS

DATE_PARTS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
    "minute": F.minute,
}


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def parse_timestamp(text: Column | str) -> Column:
    """ISO 8601 text with an offset to an instant; text that does not parse gives NULL."""
    return F.try_to_timestamp(_col(text))


def instant(ts: Column | str) -> Column:
    """A timestamp, or the instant of a timestamp text; text that does not parse gives NULL."""
    return _col(ts).try_cast("timestamp")


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 (rounded down)."""
    return F.unix_seconds(_col(ts).cast("timestamp"))


def hours_between(start: Column | str, stop: Column | str) -> Column:
    """Hours from `start` to `stop`, two decimals."""
    return F.round((epoch_seconds(stop) - epoch_seconds(start)) / 3600, 2)


def energy_delta(meter_start: Column | str, meter_stop: Column | str, unit: str = "kwh") -> Column:
    """Energy between two meter readings in Wh, as `kwh` or `wh`, two decimals."""
    divisor = {"kwh": 1000, "wh": 1}[unit]
    used = _col(meter_stop).cast("double") - _col(meter_start).cast("double")
    return F.round(used / divisor, 2)


def rounded_double(text: Column | str, digits: int = 2) -> Column:
    """Number text to double, rounded; text that is no number gives NULL."""
    return F.round(_col(text).try_cast("double"), digits)


def positive_flag(value: Column | str) -> Column:
    """1 where the value is above zero, otherwise 0 (also for NULL)."""
    return F.when(_col(value) > 0, 1).otherwise(0)


def date_part_columns(ts: Column | str, parts: list[str] | tuple[str, ...] = tuple(DATE_PARTS)) -> dict[str, Column]:
    """Named date parts of `ts`, for `withColumns`; text that is no timestamp gives NULLs."""
    return {part: DATE_PARTS[part](instant(ts)) for part in parts}


def table_name(action: Column | str = "action", message_type: Column | str = "message_type") -> Column:
    """Name of the action table of a message, e.g. StopTransactionRequest."""
    label = F.lit(None)
    for code, text in TYPE_LABELS.items():
        label = F.when(_col(message_type) == code, text).otherwise(label)
    return F.concat(_col(action), label)
