"""Live charger status: the batch operators on a stream, with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargetrail.functions import parse_timestamp
from chargetrail.operators.messages import of_class, unpack_json
from chargetrail.operators.stats import status_counts
from chargetrail.schemas import STATUS, MessageClass


def status_events(log: DataFrame, message: MessageClass = STATUS) -> DataFrame:
    """charge_point_id, status and timestamp of the log's status notifications."""
    return (
        log.transform(of_class, message.action, message.message_type)
        .transform(unpack_json, message.body, other_names=message.other_names)
        .select(
            "charge_point_id",
            F.col("new_body.status").alias("status"),
            parse_timestamp("new_body.timestamp").alias("timestamp"),
        )
    )


def windowed_status_counts(
    events: DataFrame,
    key: str = "charge_point_id",
    status: str = "status",
    ts: str = "timestamp",
    lateness: str = "10 minutes",
    width: str = "5 minutes",
    name: str | None = None,
) -> DataFrame:
    """Counts per key, status and window; rows of windows closed by the watermark are dropped."""
    return events.withWatermark(ts, lateness).transform(status_counts, key, status, ts, width, name)

