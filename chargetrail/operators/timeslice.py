"""Date partition columns and filters on them."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargetrail.functions import date_part_columns, parse_timestamp

DAY = ("year", "month", "day")
MINUTE = ("year", "month", "day", "hour", "minute")


def with_date_parts(df: DataFrame, ts: str = "write_timestamp", parts: tuple[str, ...] = MINUTE) -> DataFrame:
    """Add integer columns year, month, day, hour, minute (or the given ones)."""
    return df.withColumns(date_part_columns(F.col(ts), parts))


def time_slice(
    df: DataFrame, when: datetime, parts: tuple[str, ...] = MINUTE, ts: str = "write_timestamp"
) -> DataFrame:
    """Rows of the year, month, day, hour or minute of `when` (UTC), whichever is the last of `parts`.

    Part columns that the table has are compared by name, which prunes folders. If some are missing, a range of `ts`
    does the rest, which a Parquet scan can use to skip row groups where `ts` is a timestamp.
    """
    matches = F.lit(True)
    for part in parts:
        if part in df.columns:
            matches = matches & (F.col(part) == getattr(when, part))
    if not set(parts) <= set(df.columns):
        begin, end = _bounds(when, parts[-1])
        written = parse_timestamp(ts) if dict(df.dtypes)[ts] == "string" else F.col(ts)
        matches = matches & (written >= F.lit(begin)) & (written < F.lit(end))
    return df.where(matches)


def _bounds(when: datetime, part: str) -> tuple[datetime, datetime]:
    """Begin and end (exclusive) of the `part` that `when` falls in."""
    given = [getattr(when, name) for name in MINUTE[: MINUTE.index(part) + 1]]
    begin = datetime(*(given + [1, 1])[: max(3, len(given))], tzinfo=timezone.utc)
    if part in ("year", "month"):
        months = begin.year * 12 + begin.month - 1 + (12 if part == "year" else 1)
        return begin, begin.replace(year=months // 12, month=months % 12 + 1)
    return begin, begin + timedelta(**{f"{part}s": 1})
