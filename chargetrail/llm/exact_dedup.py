"""Exact deduplication by progressive refinement, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chargetrail.llm.registry import query, read
from chargetrail.session import materialise

PREFIX = 256
_SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: str | Column = "text") -> Column:
    """Each run of ASCII white space as one space; NULL as the empty text."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), _SPACES, " ")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: str | None = None,
    mark: str | None = None,
) -> DataFrame:
    """Per row of `docs`: id, `keep_id`, `group_size` and `kept`, for groups of rows with equal normalised texts.

    1. The length of the text and the hash of its first `PREFIX` characters are written, a few bytes a row.
    2. Lengths that occur once are settled; of the others, (length, prefix hash) pairs that occur once.
    3. Only rows of the surviving pairs have their full SHA-256 computed, and are grouped by it.

    Counts are combined before each shuffle, so a group may hold any share of the rows. The groups to look up are
    written tables: Spark broadcasts them if they are small and otherwise sorts and splits hot keys.

    The row with the smallest id stays. NULL and empty texts are equal. A NULL id is larger than any other; rows that
    repeat an id with an equal text are one document, so they are kept or dropped together, and each counts in
    `group_size`. `digest` adds the SHA-256 of every row's normalised text under that name, `mark` a 64-bit hash of the text as
    it is. Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    whole = normalised("_text")
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = base.select(
        "_id",
        "_text",
        F.length(whole).alias("_length"),
        F.xxhash64(F.substring(whole, 1, PREFIX)).alias("_prefix"),
        *([F.sha2(whole, 256).alias("_digest")] if digest else []),
        *([F.xxhash64("_text").alias("_mark")] if mark else []),
    )
    short = materialise(rows.select("_length", "_prefix"), "prefixes")
    lengths = materialise(_repeated(short, ["_length"]), "lengths")
    prefixes = materialise(_repeated(short.join(lengths, "_length", "left_semi"), ["_length", "_prefix"]), "pairs")

    extra = [*(["_digest"] if digest else []), *(["_mark"] if mark else [])]
    marked = rows.join(prefixes.withColumn("_again", F.lit(True)), ["_length", "_prefix"], "left")
    full = F.when(F.col("_again"), F.sha2(whole, 256)).alias("_full")
    fingerprints = materialise(marked.select("_id", "_length", full, *extra), "fingerprints")

    several = fingerprints.where(F.col("_full").isNotNull())
    groups = several.groupBy("_length", "_full").agg(F.min("_id").alias("_keep"), F.count("*").alias("_size"))
    groups = materialise(groups.where("_size > 1"), "groups")
    decided = fingerprints.join(groups, ["_length", "_full"], "left")
    alone = F.col("_size").isNull()
    keep = F.when(alone, F.col("_id")).otherwise(F.col("_keep"))
    return decided.select(
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("_size")).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        *([F.col("_digest").alias(digest)] if digest else []),
        *([F.col("_mark").alias(mark)] if mark else []),
    )


def _repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("_rows")).where("_rows > 1").drop("_rows")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the rows that `exact_groups` does not keep, with all columns.

    Rows go by id and text, so of an id with several texts only copies of an earlier document go. Rows with a NULL id can't
    be told apart, so they are all left; NULL and empty texts are equal.
    """
    found = exact_groups(docs, id_col, text_col, mark="_mark").where(~F.col("kept"))
    dropped = found.select(F.col(id_col).alias("_dropped"), "_mark").where("_dropped IS NOT NULL")
    dropped = materialise(dropped.distinct(), "dropped")
    same = (docs[id_col] == dropped["_dropped"]) & (F.xxhash64(docs[text_col]) == dropped["_mark"])
    return docs.join(dropped, same, "left_anti")


@query(
    r"""
    WITH t AS (
      SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
    ), g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
    FROM t JOIN g USING (norm)
    """
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read(spark, sf_dir, "documents"), digest="text_sha256")
