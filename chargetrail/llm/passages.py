"""Removal of passages that already occur in an earlier document, located by sharded Aho-Corasick automata."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chargetrail.llm.registry import query, read
from chargetrail.llm.words import Words, mix, pieces, runs
from chargetrail.session import materialise

WINDOW = 13
#: Text that a task gathers before it deals out window hashes, so that each shard gets few large rows of them.
GATHERED = 12 << 20
_LAST = np.iinfo(np.int64).max
#: A row without an id is dealt as `_LAST` less its bucket; ids above this are not those of documents.
_NO_ID = _LAST - (1 << 24)
_PRIME, _FACTOR = 2_147_483_647, 1_103_515_245
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def _packed(values: np.ndarray) -> bytes:
    """Integers as compressed differences: ids and owners repeat or rise, and become small."""
    return zstandard.compress(np.diff(values, prepend=values.dtype.type(0)).tobytes(), 1)


def _unpacked(data: bytes, dtype: type) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(data), dtype=dtype), dtype=dtype)


def _window_rows(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, and of each window that lies in one text: its hash, the place of its first word, and its text."""
    hashes = words.hashes()
    counts = np.maximum(np.diff(words.first) - window + 1, 0)
    text = np.repeat(np.arange(len(words)), counts)
    at = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + words.first[text]
    found = runs(hashes, window)
    return hashes, found[at] if len(at) else np.zeros(0, np.uint64), at, text


def _deal_windows(docs: DataFrame, window: int, shards: int) -> DataFrame:
    """Rows of (`shard`, packed `docs`, `hashes`): all windows' hashes with their documents, by shards of the hash.

    The shard is drawn from the hash by another function than the stored 64 bits' order, and rows of a shard are
    in order of documents. Of a window that several documents of a task have, only what decides is dealt (`_deciding`), so a
    shard gets no more rows of it than there are buckets and tasks, whatever share of the documents has it.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, size = [], [], 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            own = [
                _LAST - zlib.crc32((texts[place] or "").encode()) % shards if i is None else i
                for place, i in enumerate(batch.column(0).to_pylist())
            ]
            own = np.array(own, dtype=np.int64)
            for group in pieces(texts):
                words = Words([texts[i] for i in group])
                _, found, _, text = _window_rows(words, window)
                ids.append(own[group][text])
                hashes.append(found)
                size += len(words.data)
            if size >= GATHERED:
                yield _dealt(np.concatenate(ids), np.concatenate(hashes), shards)
                ids, hashes, size = [], [], 0
        if ids:
            yield _dealt(np.concatenate(ids), np.concatenate(hashes), shards)

    return docs.mapInArrow(deal, "shard int, docs binary, hashes binary")


def _deciding(ids: np.ndarray, hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the documents (and hashes) of each window: the last one of every bucket, and the first of all.

    A bucket learns of a window if any of its documents comes after the first that has it.
    """
    order = np.argsort(hashes)
    ids, hashes = ids[order], hashes[order]
    same = np.append(hashes[1:] == hashes[:-1], False) if len(hashes) else np.zeros(0, bool)
    several = same | np.append(False, same[:-1])[: len(hashes)]
    own, marks = ids[several], hashes[several]
    bucket = _buckets_of(own, buckets)
    order = np.lexsort((own, bucket, marks))
    own, marks, bucket = own[order], marks[order], bucket[order]
    last = np.append((marks[1:] != marks[:-1]) | (bucket[1:] != bucket[:-1]), True)[: len(marks)]
    heads = np.flatnonzero(np.append(True, marks[1:] != marks[:-1])[: len(marks)])
    firsts = np.minimum.reduceat(own, heads) if len(heads) else own
    kept = np.minimum.reduceat(np.where(last, own, _LAST), heads) if len(heads) else own
    gone = firsts < kept
    return (
        np.concatenate([ids[~several], own[last], firsts[gone]]),
        np.concatenate([hashes[~several], marks[last], marks[heads][gone]]),
    )


def _dealt(ids: np.ndarray, hashes: np.ndarray, shards: int) -> pa.RecordBatch:
    ids, hashes = _deciding(ids, hashes, shards)
    shard = ((mix(hashes * _SPREAD) >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((ids, shard))
    ids, hashes, shard = ids[order], hashes[order], shard[order]
    present, cuts = np.unique(shard, return_index=True)
    ends = [*cuts[1:].tolist(), len(shard)]
    parts = list(zip(cuts.tolist(), ends))
    return pa.record_batch(
        [
            pa.array(present.astype(np.int32)),
            pa.array([_packed(ids[a:b]) for a, b in parts], pa.binary()),
            pa.array([hashes[a:b].tobytes() for a, b in parts], pa.binary()),
        ],
        names=["shard", "docs", "hashes"],
    )


def _bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    """A document's bucket, by arithmetic that numpy and Spark do alike and without overflow."""
    return (ids % _PRIME * _FACTOR) % _PRIME % buckets


def _buckets_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    """The buckets of documents as they are dealt; one without an id tells it."""
    return np.where(ids > _NO_ID, _LAST - ids, _bucket(ids, buckets))


def _bucket_column(ids: Column, texts: Column, buckets: int) -> Column:
    prime = F.lit(_PRIME).cast("long")
    known = F.pmod(F.pmod(F.pmod(ids, prime) * F.lit(_FACTOR).cast("long"), prime), F.lit(buckets))
    unknown = F.pmod(F.crc32(F.coalesce(texts, F.lit("")).cast("binary")), F.lit(buckets))
    return F.when(ids.isNull(), unknown).otherwise(known).cast("int")


def _recurring(dealt: DataFrame, buckets: int) -> DataFrame:
    """Rows of (`bucket`, `hashes`, packed `owners`): windows that a document of the bucket repeats from an earlier
    document, and the smallest id that has them. A bucket learns of a window once, however many of its documents
    have it."""

    def confirm(shard: pa.Table) -> pa.Table:
        ids = np.concatenate([_unpacked(row, np.int64) for row in shard.column("docs").to_pylist()])
        hashes = np.concatenate([np.frombuffer(row, np.uint64) for row in shard.column("hashes").to_pylist()])
        order = np.argsort(hashes)
        ids, hashes = ids[order], hashes[order]
        heads = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
        bucket, ids = _buckets_of(ids, buckets), np.where(ids > _NO_ID, _LAST, ids)
        owners = np.repeat(np.minimum.reduceat(ids, heads), np.diff(np.append(heads, len(ids))))
        later = ids > owners
        bucket, hashes, owners = bucket[later], hashes[later], owners[later]
        order = np.lexsort((hashes, owners, bucket))
        bucket, hashes, owners = bucket[order], hashes[order], owners[order]
        fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (bucket[1:] != bucket[:-1]))[: len(hashes)]
        bucket, hashes, owners = bucket[fresh], hashes[fresh], owners[fresh]
        present, cuts = np.unique(bucket, return_index=True)
        parts = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]))
        return pa.table(
            {
                "bucket": pa.array(present.astype(np.int32)),
                "hashes": pa.array([hashes[a:b].tobytes() for a, b in parts], pa.binary()),
                "owners": pa.array([_packed(owners[a:b]) for a, b in parts], pa.binary()),
            }
        )

    return dealt.groupBy("shard").applyInArrow(confirm, "bucket int, hashes binary, owners binary")


def _as_text(numbers: np.ndarray, width: int) -> str:
    """Word numbers as characters, `width` (1 or 2) per word; surrogates are left out."""
    half = 500_000
    codes = numbers if width == 1 else np.stack([half + numbers // half, numbers % half], axis=1).ravel()
    return (codes + 0x800 * (codes >= 0xD800)).astype("<u4").tobytes().decode("utf-32-le")


def _repeated_words(words: Words, ids: np.ndarray, hashes: np.ndarray, owners: np.ndarray, window: int) -> np.ndarray:
    """Which words of a shard of documents lie in a passage that an earlier document has.

    `hashes` and `owners` are the shard's recurring windows. Neighbouring ones with one owner are a passage; the
    passages of the shard are compiled into one automaton over words, and all its documents run through it.
    """
    all_words, found, at, text = _window_rows(words, window)
    removed = np.zeros(len(all_words) + 1, dtype=np.int32)
    if not len(hashes) or not len(found):
        return removed[:-1] > 0
    order = np.argsort(hashes)
    hashes, owners = hashes[order], owners[order]
    place = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
    hit = hashes[place] == found
    owner = np.where(hit, owners[place], _LAST)
    hit &= owner < ids[text]
    new = np.append(True, (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1]) | ~hit[:-1]) & hit
    end = np.append(new[1:] | ~hit[1:], True) & hit
    starts, ends = at[new], at[end] + window

    vocabulary, numbers = np.unique(all_words, return_inverse=True)
    width = 1 if len(vocabulary) < 1_000_000 else 2
    automaton = ahocorasick.Automaton()
    for a, b, who in zip(starts.tolist(), ends.tolist(), owner[new].tolist()):
        automaton.add_word(_as_text(numbers[a:b], width), (b - a, who))
    if len(automaton):
        automaton.make_automaton()
        for i in range(len(words)):
            own = words.span(i)
            for last, (length, who) in automaton.iter(_as_text(numbers[own], width)):
                if who < ids[i]:
                    stop = own.start + (last + 1) // width
                    removed[stop - length] += 1
                    removed[stop] -= 1
    return np.cumsum(removed[:-1]) > 0


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, texts: bool = False
) -> DataFrame:
    """Per row of `docs`: id, `n_words`, `n_removed` and `kept_sha256` (kept words joined by one space), or with
    `texts` the `kept_text`.

    A word is removed if it lies in `window` consecutive words that also start in a document with a smaller id.

    1. Hashes of all windows are dealt to shards and confirmed there: a window recurs if a smaller id has it as well.
       Equal windows are told by 64 bits besides the shard.
    2. Documents are dealt to as many buckets. Each bucket gets its recurring windows, compiles their passages into an
       Aho-Corasick automaton, and runs all its documents through it.

    There are twice `spark.sql.shuffle.partitions` shards and buckets: set it so that a bucket, its texts and about as
    much again, fits a task. Texts with fewer words lose nothing, and NULL has no words. A NULL id counts as larger than all
    others, and such rows are dealt by their texts; rows that repeat an id, or have none, don't remove each other's words.
    Ids are integers below 2^63 - 2^24. Other columns are ignored; an empty table gives no rows.
    """
    shards = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    lists = materialise(_recurring(_deal_windows(rows, window, shards), shards), "recurring")

    def remove(documents: pa.Table, recurring: pa.Table) -> pa.Table:
        ids = np.array([_LAST if i is None else i for i in documents.column("_id").to_pylist()], dtype=np.int64)
        own_texts = documents.column("_text").to_pylist()
        hashes = [np.frombuffer(row, np.uint64) for row in recurring.column("hashes").to_pylist()]
        owners = [_unpacked(row, np.int64) for row in recurring.column("owners").to_pylist()]
        words = Words(own_texts)
        gone = _repeated_words(
            words,
            ids,
            np.concatenate([np.zeros(0, np.uint64), *hashes]),
            np.concatenate([np.zeros(0, np.int64), *owners]),
            window,
        )
        removed, kept = [], []
        for i, text in enumerate(own_texts):
            mask = gone[words.span(i)]
            parts = (text or "").encode("utf-8", "surrogatepass").split()
            removed.append(int(mask.sum()))
            data = b" ".join(compress(parts, (~mask).tolist()) if removed[-1] else parts)
            kept.append(data.decode("utf-8", "surrogatepass") if texts else hashlib.sha256(data).hexdigest())
        return pa.table(
            {
                "_id": documents.column("_id"),
                "n_words": pa.array(np.diff(words.first).astype(np.int64)),
                "n_removed": pa.array(removed, pa.int64()),
                result: pa.array(kept, pa.string()),
            }
        )

    result = "kept_text" if texts else "kept_sha256"
    numbered = rows.withColumn("bucket", _bucket_column(F.col("_id"), F.col("_text"), shards))
    return (
        numbered.groupBy("bucket")
        .cogroup(lists.groupBy("bucket"))
        .applyInArrow(remove, f"_id long, n_words long, n_removed long, {result} string")
        .withColumnRenamed("_id", id_col)
    )


@query(
    r"""
    WITH t AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), w AS (
      SELECT doc_id, i, hash(words[i : i + 12]) AS h
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM t WHERE len(words) > 12)
    ), f AS (SELECT h, min(doc_id) AS first_doc FROM w GROUP BY h HAVING min(doc_id) < max(doc_id)
    ), r AS (
      SELECT DISTINCT doc_id, i + k AS j
      FROM w JOIN f USING (h), (SELECT unnest(range(13)) AS k)
      WHERE first_doc < doc_id
    ), g AS (SELECT doc_id, list(j) AS gone FROM r GROUP BY doc_id)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
           sha256(array_to_string(
             [words[x] FOR x IN range(1, len(words) + 1) IF gone IS NULL OR NOT list_contains(gone, x)], ' '
           )) AS kept_sha256
    FROM t LEFT JOIN g USING (doc_id)
    """
)
def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read(spark, sf_dir, "documents"))
