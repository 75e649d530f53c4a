"""Cross-entropy difference: how much nearer a text is to a target domain than to the corpus."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargetrail.llm.registry import query, read
from chargetrail.llm.words import Words, pieces, runs
from chargetrail.session import materialise

#: Weight of the pair estimate against the smoothed single-word estimate, and what the latter adds to each count.
MIXED, ADDED = 0.6, 0.5
#: Characters of a block of texts, which asks for the counts of its different words and pairs at once.
BLOCK = 1 << 24


def pack(values: np.ndarray) -> bytes:
    """64-bit numbers, ordered by the place of their bytes; the low five and the high three are compressed apart."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    low, high = (zstandard.compress(part.tobytes(), 1) for part in (planes[:5], planes[5:]))
    return len(low).to_bytes(4, "little") + low + high


def unpack(data: bytes) -> np.ndarray:
    cut = 4 + int.from_bytes(data[:4], "little")
    planes = zstandard.decompress(data[4:cut]) + zstandard.decompress(data[cut:])
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, whether a word of its text is before it, hash of its pair with that word (of those that have
    one), and the number of the first word of each text, with the total as last item."""
    words, pairs, inner, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, bool)], [np.zeros(1, np.int64)]
    for group in pieces(texts):
        found = Words([texts[i] for i in group], lower=True)
        hashes = found.hashes()
        follows = np.ones(len(hashes), dtype=bool)
        begins = found.first[:-1]
        follows[begins[begins < len(hashes)]] = False
        words.append(hashes)
        pairs.append(runs(hashes, 2)[follows[1:]])
        inner.append(follows)
        counts.append(np.diff(found.first))
    return np.concatenate(words), np.concatenate(inner), np.concatenate(pairs), np.cumsum(np.concatenate(counts))


def blocks(batches: Iterable[pa.RecordBatch], at: int) -> Iterator[pa.Table]:
    """The rows in blocks of about `BLOCK` characters of column `at`. A text is never cut."""
    held, size = [], 0
    for batch in batches:
        texts = batch.column(at).to_pylist()
        for group in pieces(texts, BLOCK):
            held.append(batch.slice(group[0], len(group)))
            size += sum(len(texts[i] or "") + 1 for i in group)
            if size >= BLOCK:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _by_shard(hashes: np.ndarray, bits: int, pairs: bool) -> Iterator[tuple[int, slice]]:
    """Shards, and the part of the sorted `hashes` that is theirs: even numbers for words, odd ones for pairs."""
    edges = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    for shard, (a, b) in enumerate(zip(edges, [*edges[1:], len(hashes)])):
        if a < b:
            yield 2 * shard + pairs, slice(a, b)


_DEALT = "shard int, hashes binary, counts binary"


def _dealt(parts: Iterable[tuple[np.ndarray, np.ndarray, bool]], bits: int) -> pa.RecordBatch:
    """Rows of shards of sorted hashes with their counts."""
    rows = [
        (shard, pack_sorted(hashes[own]), pack(counts[own]))
        for hashes, counts, pairs in parts
        for shard, own in _by_shard(hashes, bits, pairs)
    ]
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.binary(), pa.binary()))]
    return pa.record_batch(columns, names=["shard", "hashes", "counts"])


def _added(parts: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of all rows of a shard and the sums of their counts."""
    hashes = [unpack_sorted(x) for x in parts["hashes"].to_pylist()]
    if len(hashes) == 1:
        return hashes[0], unpack(parts["counts"][0].as_py())
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    every = np.concatenate(hashes)
    order = np.argsort(every, kind="stable")
    every = every[order]
    heads = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    counts = np.concatenate([unpack(x) for x in parts["counts"].to_pylist()])[order]
    return every[heads], np.add.reduceat(counts, heads)


@dataclass
class Model:
    """Counts of all words and pairs of one domain.

    `table` is a written table of `shard`, sorted `hashes` and their `counts`, which grows with the domain; a hash is in
    the shard of its first `bits` bits. `words` has the number of words of each shard of words, repeats counted.
    """

    table: DataFrame
    bits: int
    words: np.ndarray

    def dealt_by(self, bits: int) -> DataFrame:
        """`table` with the shards of another number of bits."""
        if bits == self.bits:
            return self.table

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard, hashes, counts in zip(*(column.to_pylist() for column in batch.columns)):
                    yield _dealt([(unpack_sorted(hashes), unpack(counts), bool(shard % 2))], bits)

        return self.table.mapInArrow(deal, _DEALT)


def count_model(texts: DataFrame, text_col: str = "text") -> Model:
    """Counts of all words and pairs of all rows, told apart by 64-bit hashes.

    Each task adds up blocks of its rows before they are dealt by the first bits of the hash, so that a hash is sent
    once a block, however common it is. There are four to eight shards of words and of pairs for each shuffle
    partition of the session.
    """
    bits = _bits(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, 0):
            words, _, pairs, _ = hashed(block.column(0).to_pylist())
            yield _dealt(((*_counted(words), False), (*_counted(pairs), True)), bits)

    def add(parts: pa.Table) -> pa.Table:
        hashes, counts = _added(parts)
        columns = [parts["shard"][:1], pa.array([pack_sorted(hashes)], pa.binary()), pa.array([pack(counts)], pa.binary())]
        return pa.table([*columns, pa.array([int(counts.sum())])], names=["shard", "hashes", "counts", "total"])

    dealt = texts.select(F.col(text_col).alias("_text")).mapInArrow(count, _DEALT)
    table = materialise(dealt.groupBy("shard").applyInArrow(add, f"{_DEALT}, total long"), "counts")
    totals = table.where("shard % 2 = 0").select("total").collect()  # a number for each shard of words
    return Model(table.drop("total"), bits, np.array([r["total"] for r in totals], dtype=np.int64))


def _bits(spark: SparkSession) -> int:
    return (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()


def _counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    held, counts = np.unique(hashes, return_counts=True)
    return held, counts.astype(np.uint64)


def _vocabulary(tables: DataFrame) -> int:
    """Number of different words of all tables."""

    def different(parts: pa.Table) -> pa.Table:
        return pa.table([pa.array([len(_added(parts)[0])], pa.int64())], names=["words"])

    words = tables.where("shard % 2 = 0").select("shard", "hashes", "counts")
    return words.groupBy("shard").applyInArrow(different, "words long").agg(F.sum("words")).first()[0] or 0


def score_difference(
    docs: DataFrame, target: Model, background: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of `docs`: id, `n_words`, mean loss per word under each model (`target_loss`, `background_loss`, in
    nats) and `score`, the mean of background loss less target loss: above 0 is nearer to the target.

    The rows are written in blocks. A block asks each shard for the counts of its different words and pairs there,
    the shard answers from both models' tables, and the block's texts are scored with its answers; a common pair is
    asked for once a block.

    Both models have the same vocabulary (the words of either), order and smoothing. Texts without words, NULL too, have losses and score 0.
    Repeated rows score alike; other columns are ignored; an empty table gives no rows.
    """
    bits = background.bits
    tables = target.dealt_by(bits).withColumn("block", F.lit(-1).cast("long")).unionByName(
        background.table.withColumn("block", F.lit(-2).cast("long"))
    )
    size = max(_vocabulary(tables), 1)
    smooth = [int(model.words.sum()) + ADDED * size for model in (target, background)]

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
        for n, block in enumerate(blocks(batches, 1)):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, block.schema, options=options) as out:
                out.write_table(block.combine_chunks())
            rows = pa.array([sink.getvalue().to_pybytes()], pa.binary())
            yield pa.record_batch([pa.array([first + n], pa.int64()), rows], names=["block", "rows"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                words, _, pairs, _ = hashed(_opened(rows).column(1).to_pylist())
                asked = [
                    (shard, pack_sorted(hashes[own]))
                    for hashes, kind in ((np.unique(words), False), (np.unique(pairs), True))
                    for shard, own in _by_shard(hashes, bits, kind)
                ]
                columns = [pa.array([x[0] for x in asked], pa.int32()), pa.array([x[1] for x in asked], pa.binary())]
                yield pa.record_batch([*columns, pa.array([block] * len(asked), pa.int64())], names=["shard", "hashes", "block"])

    def answer(parts: pa.Table) -> pa.Table:
        models = [_added(parts.filter(pc.equal(parts["block"], k))) for k in (-1, -2)]
        asked = parts.filter(pc.greater_equal(parts["block"], 0))
        found = ([], [])
        for data in asked["hashes"].to_pylist():
            wanted = unpack_sorted(data)
            for out, (hashes, counts) in zip(found, models):
                places = np.minimum(np.searchsorted(hashes, wanted), max(len(hashes) - 1, 0))
                known = hashes[places] == wanted if len(hashes) else np.zeros(len(wanted), bool)
                out.append(pack(np.where(known, counts[places], np.uint64(0)) if len(hashes) else np.zeros(len(wanted), np.uint64)))
        columns = [asked["block"], asked["shard"], *(pa.array(x, pa.binary()) for x in found)]
        return pa.table(columns, names=["block", "shard", "near", "far"])

    def score(held: pa.Table, answers: pa.Table) -> pa.Table:
        shards = np.array(answers["shard"].to_pylist(), dtype=np.int64)
        rows = _opened(held["rows"][0])
        words, inner, pairs, first = hashed(rows.column(1).to_pylist())
        different = [np.unique(x, return_inverse=True) for x in (words, pairs)]
        del words, pairs
        counts, losses = np.diff(first), []
        for name, total in zip(("near", "far"), smooth):
            packed = answers[name].to_pylist()
            times = []
            for kind, (hashes, places) in enumerate(different):
                own = [k for k in np.argsort(shards) if shards[k] % 2 == kind]
                known = np.concatenate([np.zeros(0, np.uint64), *(unpack(packed[k]) for k in own)])
                if len(known) != len(hashes):
                    raise RuntimeError("answers do not fit the block")
                times.append(known[places].astype(np.float64))
            single = (times[0] + ADDED) / total
            seen = times[0][:-1][inner[1:]]  # counts of the words before
            p = single.copy()
            mixed = MIXED * times[1] / np.maximum(seen, 1) + (1 - MIXED) * single[inner]
            p[inner] = np.where(seen > 0, mixed, single[inner])
            sums = np.concatenate([[0.0], np.cumsum(-np.log(p))])
            losses.append((sums[first[1:]] - sums[first[:-1]]) / np.maximum(counts, 1))
        near, far = losses
        columns = [rows.column(0), pa.array(counts, pa.int64()), pa.array(near), pa.array(far), pa.array(far - near)]
        return pa.table(columns, names=["_id", "n_words", "target_loss", "background_loss", "score"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, n_words long, target_loss double, background_loss double, score double"
    held = materialise(rows.mapInArrow(hold, "block long, rows binary"), "blocks")
    asked = held.mapInArrow(ask, "shard int, hashes binary, block long").withColumn("counts", F.lit(None).cast("binary"))
    answers = tables.unionByName(asked).groupBy("shard").applyInArrow(answer, "block long, shard int, near binary, far binary")
    scored = held.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema)
    return scored.withColumnRenamed("_id", id_col)


def _opened(rows: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(rows.as_buffer()).read_all()


@query()
def op1_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the benchmark's texts; background: all documents."""
    docs = read(spark, sf_dir, "documents")
    return score_difference(docs, count_model(read(spark, sf_dir, "benchmark")), count_model(docs))
