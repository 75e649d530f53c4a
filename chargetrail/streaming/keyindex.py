"""An index of the keys that a stream has written, which a batch opens only in part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chargetrail.storage import remove

BUCKET = "bucket"


class KeyIndex:
    """Keys of all batches below `path`, in runs of batches and hash buckets within each run.

    A batch adds a run of level 0. When `fan` runs of a level are complete, they are merged into one of the next level. So
    the keys of n batches lie in at most (`fan` - 1) * log(n) runs, a key is rewritten log(n) times, and which runs there are
    follows from the number of the batch alone. A lookup reads, in each run, only the buckets of the keys it has.

    Batches are numbered from 0 without gaps, and a batch only begins when the one before has been committed, as in
    Structured Streaming. A repeated batch writes the same folders again; runs that were merged stay until the next batch
    begins, so it finds what it needs.
    """

    def __init__(self, path: str, key: str, kind: str, buckets: int = 64, fan: int = 8):
        if buckets < 1 or fan < 2:
            raise ValueError("an index needs a bucket and merges two runs at least")
        self.path, self.key, self.kind, self.buckets, self.fan = path, key, kind, buckets, fan

    def bucket(self) -> Column:
        """The bucket of a row's key."""
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _folder(self, level: int, run: int) -> str:
        return f"{self.path}/level={level}/run={run}"

    def _live(self, batches: int) -> list[tuple[int, int]]:
        """Level and number of the runs that hold the first `batches` batches."""
        runs, level = [], 0
        while batches:
            runs += [(level, run) for run in range(batches - batches % self.fan, batches)]
            batches, level = batches // self.fan, level + 1
        return runs

    def _merges(self, batches: int) -> list[tuple[int, int]]:
        """Level and number of the runs that are complete exactly after `batches` batches, but for level 0."""
        runs, level = [], 1
        while batches and batches % self.fan == 0:
            batches //= self.fan
            runs.append((level, batches - 1))
            level += 1
        return runs

    def _read(self, spark: SparkSession, runs: list[tuple[int, int]]) -> DataFrame:
        reader = spark.read.option("basePath", self.path)
        reader = reader.schema(f"`{self.key}` {self.kind}, level int, run int, {BUCKET} int")
        return reader.parquet(*[self._folder(*run) for run in runs]).select(self.key, BUCKET)

    def _write(self, keys: DataFrame, level: int, run: int) -> None:
        placed = keys.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, self.key)
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(self._folder(level, run))

    def seen(self, spark: SparkSession, batch: int, buckets: list[int]) -> DataFrame:
        """The keys that batches before `batch` have written in these `buckets`."""
        return self._read(spark, self._live(batch)).where(F.col(BUCKET).isin(buckets)).select(self.key)

    def add(self, keys: DataFrame, batch: int) -> None:
        """Write the new keys of `batch` and merge the runs that it completes."""
        self._write(keys.select(self.key, self.bucket()), 0, batch)
        for level, run in self._merges(batch + 1):
            parts = [(level - 1, run * self.fan + k) for k in range(self.fan)]
            self._write(self._read(keys.sparkSession, parts), level, run)

    def clean(self, spark: SparkSession, batch: int) -> None:
        """Remove the runs that were merged when the batch before `batch` ended."""
        for level, run in self._merges(batch):
            for k in range(self.fan):
                remove(spark, self._folder(level - 1, run * self.fan + k))
