import random
from datetime import datetime, timezone

import numpy as np
import pytest

from chargetrail.operators.stats import distribution, event_count, histogram, status_counts
from conftest import plan_text, rows


@pytest.mark.parametrize("by", [[], ["g"]])
def test_distribution_matches_numpy(spark, by):
    draw = random.Random(2)
    data = [(draw.choice(["hot", "hot", None, "b"]), round(draw.lognormvariate(1, 2), 1)) for _ in range(500)]
    df = spark.createDataFrame(data + [("b", None)], "g string, v double").repartition(4)
    got = {r.g if by else "all": r for r in distribution(df, "v", by, digits=8).collect()}
    groups = {}
    for g, v in data:
        groups.setdefault(g if by else "all", []).append(v)
    assert got.keys() == groups.keys()
    for g, values in groups.items():
        q1, median, q3 = np.percentile(values, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        want = [len(values), np.mean(values), min(values), q1, median, q3, max(values), low, high,
                sum(v < low or v > high for v in values)]
        assert list(got[g])[len(by):] == pytest.approx(want, abs=1e-6)


def test_histogram(spark):
    df = spark.createDataFrame([(-0.5,), (0.0,), (1.9,), (2.0,), (None,)], "v double")
    assert rows(histogram(df, "v", 2.0)) == [(-2.0, 1), (0.0, 2), (2.0, 1)]


def test_status_counts(spark):
    at = datetime(2022, 1, 1, 0, 4, 59, tzinfo=timezone.utc)
    df = spark.createDataFrame([("a", "x", at), ("a", None, at), ("a", "x", at)], "charge_point_id string, status string, timestamp timestamp")
    counted = status_counts(df)
    assert counted.columns == ["charge_point_id", "status", "window", "count(status)"]
    assert rows(counted.selectExpr("status", "unix_seconds(window.start)", "`count(status)`")) == [
        ("x", 1640995200, 2),
        (None, 1640995200, 0),
    ]
    # counts are combined before the shuffle
    assert "partial_count" in plan_text(counted)


def test_event_count(spark):
    assert event_count(spark.range(5)).first().n == 5
