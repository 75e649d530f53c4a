"""Starting and stopping streams."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, off the JVM heap; needed for many keys."""
    before = spark.conf.get(_STATE_STORE, None)
    spark.conf.set(_STATE_STORE, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STATE_STORE)
        else:
            spark.conf.set(_STATE_STORE, before)


def run_to_end(writer: DataStreamWriter, timeout: float | None = None) -> StreamingQuery:
    """Process all input that is there now, then stop; errors of the stream are raised."""
    query = writer.trigger(availableNow=True).start()
    try:
        if query.awaitTermination(timeout) is False:
            raise TimeoutError(f"stream still running after {timeout} s")
    finally:
        query.stop()
    return query


def stop_all(spark: SparkSession) -> None:
    """Stop every active stream of the session."""
    for query in spark.streams.active:
        query.stop()
