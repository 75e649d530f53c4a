"""From raw documents to token ids: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chargetrail.llm.chunked_bpe import encode_and_decode, tokenizer_spec
from chargetrail.llm.exact_dedup import drop_exact_copies
from chargetrail.llm.mixing import emit_mix
from chargetrail.llm.near_dedup import drop_near_copies
from chargetrail.llm.quality import keep_good, train_quality
from chargetrail.llm.registry import prepared, read
from chargetrail.session import materialise

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labels, does not reject."""
    return keep_good(docs, train_quality(docs, read(prepared(spark), sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal texts."""
    prepared(spark)
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8."""
    prepared(spark)
    return drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their sources' target weights."""
    prepared(spark)
    return emit_mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: `doc_id`, `n_tokens`, `ids` (little-endian unsigned 32-bit) and `decoded`."""
    prepared(spark)
    return encode_and_decode(docs, tokenizer_spec(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("minhash near dedup", near_copies),
    ("mix sources", mix),
    ("bpe encode and decode", tokenise),
]

#: The classifier and the signatures are beyond SQL; `tests/llm/test_pipeline.py` computes every stage's rows in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to `documents`."""
    docs = read(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
