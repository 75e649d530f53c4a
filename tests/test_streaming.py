import os
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from chargetrail.operators.stats import status_counts
from chargetrail.streaming import (
    KeyIndex,
    append_files,
    append_first,
    compact,
    current_view,
    enrich,
    file_stream,
    latest_view,
    rate_stream,
    replay,
    rocksdb_state,
    rows_dropped,
    run_to_end,
    split_late,
    stop_all,
    upsert_log,
    windowed_status_counts,
)
from conftest import rows

SCHEMA = "charge_point_id string, status string, timestamp timestamp"
NIGHT = datetime(2022, 1, 1, tzinfo=timezone.utc)


def arrive(spark, folder, *events, schema=SCHEMA):
    """One more file in the inbox, with a later file time than the one before."""
    data = [(cp, "Available", NIGHT + timedelta(minutes=m)) for cp, m in events]
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder + "/inbox")
    inbox = folder + "/inbox"
    files = sorted((f for f in os.listdir(inbox) if f.endswith(".parquet")), key=lambda f: os.path.getmtime(f"{inbox}/{f}"))
    now = time.time()
    for nth, name in enumerate(files):
        os.utime(f"{inbox}/{name}", (now - 100 + 5 * nth,) * 2)
    time.sleep(0.05)


def readable(df):
    return rows(df.selectExpr("charge_point_id", "(unix_seconds(window.start) - 1640995200) DIV 60", "n"))


def test_late_rows_are_dropped(spark, folder):
    for events in ([("cp1", 60)], [("cp1", 61)], [("cp1", 52), ("cp1", 41)], [("cp2", 120)]):
        arrive(spark, folder, *events)
    stream = file_stream(spark, folder + "/inbox", SCHEMA, files_per_batch=1)
    with rocksdb_state(spark):
        query = run_to_end(
            append_files(windowed_status_counts(stream, name="n"), folder + "/out", folder + "/progress"), timeout=120
        )
    assert readable(spark.read.parquet(folder + "/out")) == [("cp1", 50, 1), ("cp1", 60, 2)]
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped == 1


def test_update_mode_keeps_the_newest_count(spark, folder):
    for events in ([("cp1", 60)], [("cp1", 61), ("cp2", 61)], [("cp1", 62)]):
        arrive(spark, folder, *events)
    stream = file_stream(spark, folder + "/inbox", SCHEMA, files_per_batch=1)
    run_to_end(upsert_log(windowed_status_counts(stream, name="n"), folder + "/live", folder + "/progress"), timeout=120)
    changes = spark.read.parquet(folder + "/live")
    assert changes.count() == 4
    live = latest_view(changes, ["charge_point_id", "status", "window"])
    batch = status_counts(spark.read.parquet(folder + "/inbox"), name="n")
    assert readable(live) == readable(batch) == [("cp1", 60, 3), ("cp2", 60, 1)]


def test_compaction_keeps_the_newest_row_of_every_key(spark, folder):
    path, keys = folder + "/live", ["charge_point_id", "status", "window"]
    seen = []
    for k in range(9):
        arrive(spark, folder, (f"cp{k % 3}", 60 + k % 2), (f"cp{k}", 70))
        stream = file_stream(spark, folder + "/inbox", SCHEMA, files_per_batch=1)
        run_to_end(upsert_log(windowed_status_counts(stream, name="n"), path, folder + "/progress", keys, 2), timeout=120)
        batch = status_counts(spark.read.parquet(folder + "/inbox"), name="n")
        assert readable(current_view(spark, path, keys)) == readable(batch)
        seen.append(len([name for name in os.listdir(path) if name.startswith("batch=")]))
    # Old change folders and bases go: what a reader opens does not grow with the number of batches.
    assert max(seen) <= 5 and len(os.listdir(path + "/_base")) <= 2
    assert len([name for name in os.listdir(path + "/_manifest") if name.isdigit()]) <= 2


def test_a_compaction_that_broke_off_is_done_again(spark, folder):
    path, keys = folder + "/live", ["k"]
    for batch in range(3):
        spark.range(batch, batch + 2).selectExpr("id AS k", f"{batch} AS v").write.parquet(f"{path}/batch={batch}")
    spark.range(5).selectExpr("id AS k", "99 AS v", "9L AS batch").write.parquet(path + "/_base/upto=2")  # not published
    wanted = [(0, 0), (1, 1), (2, 2), (3, 2)]
    assert rows(current_view(spark, path, keys)) == wanted
    compact(spark, path, keys, 2)
    assert rows(current_view(spark, path, keys)) == wanted
    spark.createDataFrame([(0, 7)], "k long, v int").write.parquet(path + "/batch=3")
    assert rows(current_view(spark, path, keys)) == [(0, 7), *wanted[1:]]


def test_late_rows_are_kept_apart(spark, folder):
    arrivals = [[("cp1", 60)], [("cp1", 61), ("cp2", None)], [("cp1", 52), ("cp1", 41), ("cp1", 49)], [("cp2", 120)], [("cp3", 60), ("cp3", 104), ("cp3", 105)]]
    for nth, events in enumerate(arrivals):
        data = [(cp, "Available", None if m is None else NIGHT + timedelta(minutes=m)) for cp, m in events]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder + "/inbox")
        inbox = file_stream(spark, folder + "/inbox", SCHEMA)
        run_to_end(split_late(inbox, folder + "/split", folder + "/progress"), timeout=120)
    minutes = lambda name: sorted(
        ((r.timestamp - NIGHT.replace(tzinfo=None)).total_seconds() // 60 if r.timestamp else -1)
        for r in spark.read.parquet(f"{folder}/split/{name}").collect()
    )
    # newest 61: the window that ended at 50 is behind 51; newest 120: the one that ended at 105 or 110 is
    assert minutes("late") == [41, 49, 60, 104, 105]
    assert minutes("on_time") == [-1, 52, 60, 61, 120]
    # counted with a watermark, the rows on time lose none, and the late ones are those that Spark drops
    whole = file_stream(spark, f"{folder}/split/on_time/*", SCHEMA, files_per_batch=1)
    query = run_to_end(append_files(windowed_status_counts(whole, name="n"), folder + "/o", folder + "/p"), timeout=120)
    assert rows_dropped(query) == 0


def test_spark_drops_what_is_kept_apart(spark, folder):
    dropped = 0
    for events in ([("cp1", 60)], [("cp1", 52), ("cp1", 41), ("cp1", 49), ("cp1", 30)], [("cp2", 120)], [("cp2", 60)]):
        arrive(spark, folder, *events)
        stream = lambda: file_stream(spark, folder + "/inbox", SCHEMA)
        query = run_to_end(append_files(windowed_status_counts(stream(), name="n"), folder + "/o", folder + "/p"), timeout=120)
        dropped += rows_dropped(query)
        run_to_end(split_late(stream(), folder + "/split", folder + "/progress"), timeout=120)
    assert dropped == spark.read.parquet(folder + "/split/late").count() == 4


def test_restart_goes_on_after_the_checkpoint(spark, folder):
    for minute in (0, 30, 60):
        arrive(spark, folder, ("cp1", minute), ("cp1", minute + 1))
        stream = file_stream(spark, folder + "/inbox", SCHEMA)
        run_to_end(
            append_files(windowed_status_counts(stream, name="n"), folder + "/out", folder + "/progress"), timeout=120
        )
    assert readable(spark.read.parquet(folder + "/out")) == [("cp1", 0, 2), ("cp1", 30, 2)]


@pytest.mark.parametrize("files", [1, None])
def test_append_first_keeps_late_first_arrivals(spark, folder, files):
    arrive(spark, folder, ("a", 500), ("b", 501), ("a", 500), ("a", 499))
    arrive(spark, folder, ("c", 3), ("a", 500), ("c", 4))
    arrive(spark, folder, ("d", 900), ("b", 501))
    stream = file_stream(spark, folder + "/inbox", SCHEMA, files_per_batch=files)
    run_to_end(append_first(stream, folder + "/out", folder + "/progress", "charge_point_id", "timestamp"), timeout=120)
    assert rows(spark.read.parquet(folder + "/out").select("charge_point_id")) == [("a",), ("b",), ("c",), ("d",)]


@pytest.mark.parametrize("files", [1, None])
def test_append_first_keeps_rows_without_a_key(spark, folder, files):
    arrive(spark, folder, (None, 1), ("a", 2), (None, 1))
    arrive(spark, folder, ("a", 2), (None, 1))
    stream = file_stream(spark, folder + "/inbox", SCHEMA, files_per_batch=files)
    run_to_end(append_first(stream, folder + "/out", folder + "/progress", "charge_point_id", "timestamp"), timeout=120)
    got = [r[0] for r in spark.read.parquet(folder + "/out").select("charge_point_id").collect()]
    assert sorted(got, key=str) == [None, None, None, "a"]


def test_key_index_opens_only_what_a_batch_needs(spark, folder):
    """A batch with few keys opens few files, however many batches were written before."""
    index = KeyIndex(folder + "/keys", "k", "string", buckets=16, fan=3)
    opened, written = [], set()
    for batch in range(20):
        keys = {f"key-{batch}-{i}" for i in range(40)}
        index.clean(spark, batch)
        if batch:
            asked = sorted(keys)[:2] + sorted(written)[:2]
            asked = spark.createDataFrame([(key,) for key in asked], "k string")
            buckets = [r[0] for r in asked.select(index.bucket()).distinct().collect()]
            seen = index.seen(spark, batch, buckets)
            assert {r.k for r in seen.join(asked, "k").collect()} == set(sorted(written)[:2])
            scan = seen._jdf.queryExecution().executedPlan()
            seen_rows = scan.executeCollect()
            files = [leaf.metrics().apply("numFiles").value() for leaf in leaves(scan)]
            opened.append(sum(files))
            assert len(buckets) <= 4 and len(seen_rows) < len(written) / 2 + 40
        index.add(spark.createDataFrame([(key,) for key in keys], "k string").coalesce(1), batch)
        written |= keys
    # At most fan - 1 runs of each of the log(20) levels, and 4 buckets of each.
    assert max(opened) <= 4 * 2 * 3 and max(opened[10:]) <= max(opened[:10]) + 8
    live = [run for level in os.listdir(folder + "/keys") for run in os.listdir(f"{folder}/keys/{level}")]
    assert len(live) <= 2 * 4 + 3 * 3


def leaves(plan):
    found = plan.collectLeaves()
    return [found.apply(i) for i in range(found.size())]


def test_a_repeated_batch_finds_its_runs(spark, folder):
    index = KeyIndex(folder + "/keys", "k", "long", buckets=4, fan=2)
    for batch in (0, 1, 1, 2, 3, 3, 4):
        index.clean(spark, batch)
        if batch:
            assert sorted(r.k for r in index.seen(spark, batch, [0, 1, 2, 3]).collect()) == list(range(10 * batch))
        index.add(spark.range(10 * batch, 10 * batch + 10).selectExpr("id AS k"), batch)


@pytest.mark.parametrize("fan", [2, 8])
def test_append_first_over_many_batches_and_stops(spark, folder, fan):
    names = [f"cp{k}" for k in range(6)]
    for nth in range(7):
        arrive(spark, folder, *[(name, nth) for name in names[max(0, nth - 4) : nth + 1]], (None, nth))
        stream = file_stream(spark, folder + "/inbox", SCHEMA, files_per_batch=1)
        run_to_end(
            append_first(stream, folder + "/out", folder + "/progress", "charge_point_id", "timestamp", 4, fan), timeout=120
        )
    got = [r[0] for r in spark.read.parquet(folder + "/out").select("charge_point_id").collect()]
    assert sorted(got, key=str) == [None] * 7 + names


def test_a_path_with_data_needs_its_checkpoint(spark, folder):
    arrive(spark, folder, ("a", 1))
    stream = file_stream(spark, folder + "/inbox", SCHEMA)
    first = lambda progress: append_first(stream, folder + "/out", folder + progress, "charge_point_id", "timestamp")
    run_to_end(first("/progress"), timeout=120)
    run_to_end(first("/progress"), timeout=120)
    for sink in (first, lambda progress: upsert_log(stream, folder + "/out", folder + progress), lambda p: split_late(stream, folder + "/out", folder + p)):
        with pytest.raises(ValueError, match="has data"):
            sink("/other")


def test_enrich_and_replay(spark, folder):
    static = spark.createDataFrame(
        [(0, "m0", 1, 2), (1, "m1", 1, 2)], "index long, message_id string, write_timestamp int, write_timestamp_epoch long"
    )
    numbers = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 3).load()
    for nth, joined in enumerate((enrich(numbers, static), replay(numbers, static))):
        run_to_end(append_files(joined, f"{folder}/out{nth}", f"{folder}/progress{nth}"), timeout=120)
    enriched = spark.read.parquet(folder + "/out0")
    assert rows(enriched.select("value", "message_id"))[:3] == [(0, "m0"), (1, "m1"), (2, None)]
    replayed = spark.read.parquet(folder + "/out1")
    assert set(replayed.columns) == {"write_timestamp", "message_id", "write_timestamp_epoch"}
    assert replayed.where(F.unix_seconds("write_timestamp") != F.col("write_timestamp_epoch")).count() == 0


def test_rate_source_and_stop_all(spark, folder):
    stream = rate_stream(spark)
    assert stream.isStreaming and stream.columns == ["timestamp", "value"]
    stream.writeStream.format("noop").option("checkpointLocation", folder + "/progress").start()
    assert len(spark.streams.active) == 1
    stop_all(spark)
    assert not spark.streams.active


def test_failures_are_raised(spark, folder):
    arrive(spark, folder, ("cp1", 0))
    stream = file_stream(spark, folder + "/inbox", SCHEMA).selectExpr("CAST(status AS int) AS broken")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|STREAM_FAILED"):
        run_to_end(append_files(stream, folder + "/out", folder + "/progress"), timeout=120)
