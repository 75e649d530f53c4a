"""Quality classifier by compression: which of two dictionaries makes a text smaller."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargetrail.llm.labels import class_weights, crc_fold, fit_line, sigmoid, training_sample
from chargetrail.llm.registry import query, read

BLOCK = 2048
DICTIONARY = 112_640
LEVEL = 3
MOST_PER_CLASS = 3000
FOLDS, HELD_OUT = 3, 1


@dataclass
class CompressionModel:
    """Two dictionaries and the line from normalised size difference to log-odds."""

    bad: bytes
    good: bytes
    slope: float
    intercept: float

    def scorer(self):
        return _Sizes(self.bad, self.good)

    def scores(self, differences: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * differences + self.intercept)


class _Sizes:
    def __init__(self, bad: bytes, good: bytes):
        self.compressors = [
            zstandard.ZstdCompressor(
                level=LEVEL,
                dict_data=zstandard.ZstdCompressionDict(data) if data else None,
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
            for data in (bad, good)
        ]

    def difference(self, text: str | None) -> float:
        """(size under the bad dictionary - size under the good one) / bytes, over all blocks of the text."""
        data = _bytes(text)
        bad, good = (sum(len(c.compress(block)) for block in _blocks(data)) for c in self.compressors)
        return (bad - good) / max(len(data), 1)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _blocks(data: bytes) -> list[bytes]:
    """The whole text in blocks, so that a dictionary counts as much late in a long text as at its start."""
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def _dictionary(texts: list[str]) -> bytes:
    samples = [block for text in texts for block in _blocks(_bytes(text)) if len(block) >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few samples to train on: their plain content serves
        return b"".join(samples)[-DICTIONARY:]


def fit(texts: list[str], y: np.ndarray, counts: dict[int, int]) -> CompressionModel:
    """Dictionaries from every other text of each class, calibration on the rest.

    Without texts of both classes the score is the share of label 1, or 0.5 without any label.
    """
    bad, good = ([t for t, label in zip(texts, y) if label == value] for value in (0, 1))
    if len(bad) < 2 or len(good) < 2:
        total = sum(counts.values())
        share = min(max(counts.get(1, 0) / total, 0.01), 0.99) if total else 0.5
        return CompressionModel(b"", b"", 0.0, float(np.log(share / (1 - share))))
    model = CompressionModel(_dictionary(bad[::2]), _dictionary(good[::2]), 0.0, 0.0)
    sizes = model.scorer()
    x = np.array([sizes.difference(text) for text in bad[1::2] + good[1::2]])
    rest = np.array([0] * len(bad[1::2]) + [1] * len(good[1::2]))
    model.slope, model.intercept = fit_line(x, rest, class_weights(rest, counts))
    return model


def train_quality(
    docs: DataFrame, labels: DataFrame, most_per_class: int = MOST_PER_CLASS, folds: int = FOLDS, held_out: int = HELD_OUT
) -> CompressionModel:
    """Fit on at most `most_per_class` labelled documents of each class (whole texts), in one task of that bounded
    size; ids whose CRC fold is `held_out` are never used."""
    usable = F.coalesce(crc_fold("doc_id", folds) != held_out, F.lit(False))
    sample, counts = training_sample(docs, labels, "quality", usable, most_per_class)

    def fit_sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"text": [], "label": []}), *batches])
        order = rows["text"].map(_bytes).argsort(kind="stable") if len(rows) else []
        rows = rows.iloc[order]
        model = fit(rows["text"].fillna("").tolist(), rows["label"].to_numpy(dtype=int), counts)
        yield pd.DataFrame([vars(model)])

    schema = "bad binary, good binary, slope double, intercept double"
    row = sample.repartition(1).mapInPandas(fit_sample, schema).first()
    if row is None:  # no labelled text, so no task
        return fit([], np.zeros(0, dtype=int), counts)
    return CompressionModel(bytes(row["bad"]), bytes(row["good"]), row["slope"], row["intercept"])


def score_quality(docs: DataFrame, model: CompressionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id and `score`, the probability of label 1 for the whole text.

    NULL and empty texts have difference 0. Rows are scored one by one, so repeats score alike; other columns are
    ignored, and an empty table gives an empty result.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = model.scorer()
        for batch in batches:
            x = np.array([sizes.difference(text.as_py()) for text in batch.column(1)], dtype=float)
            yield pa.record_batch([batch.column(0), pa.array(model.scores(x))], names=["_id", "score"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"_id {kind}, score double").withColumnRenamed("_id", id_col)


def keep_good(docs: DataFrame, model: CompressionModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of `docs` whose text scores at least `least`, with all columns and without a shuffle."""
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = model.scorer()
        for batch in batches:
            x = np.array([sizes.difference(text.as_py()) for text in batch.column(place)], dtype=float)
            yield batch.filter(pa.array(model.scores(x) >= least))

    return docs.mapInArrow(keep, docs.schema)


@query()
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = score_quality(docs, train_quality(docs, read(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(crc_fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
