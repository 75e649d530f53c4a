"""Ranked lexical search that scores each distinct bag of query words once."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chargetrail.llm.registry import query, read
from chargetrail.session import materialise

#: Fixed constants of the ranking.
SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 8, 90
#: Item text that is searched in one pass over the documents; more items take more passes.
BLOCK_CHARS = 8 << 20
#: Scores (classes by items) that a task holds at once, and ranked rows it gathers before it drops what can't be among the best.
CELLS, GATHERED = 1 << 20, 100_000

#: A term is a run of ASCII letters and digits and of bytes beyond ASCII; A-Z in lower case.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order; none for NULL."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


class Block:
    """Items that are searched together: their ids, the vocabulary, and per term the items that hold it."""

    def __init__(self, ids: list, item_terms: list[set[bytes]]):
        self.ids = ids
        self.vocabulary = {term: place for place, term in enumerate(sorted(set().union(*item_terms)))}
        held: list[list[int]] = [[] for _ in self.vocabulary]
        for item, own in enumerate(item_terms):
            for term in own:
                held[self.vocabulary[term]].append(item)
        self.fans = np.array([len(items) for items in held], dtype=np.int64)
        self.heads = np.concatenate(([0], np.cumsum(self.fans)))[:-1]
        self.items = np.array([item for items in held for item in items], dtype=np.int64)


def _blocks(items: DataFrame, most: int) -> Iterator[Block]:
    """Blocks of items with about `most` characters of text; rows with one id (or without) are one item."""
    ids, found, size = [], [], 0
    for row in items.orderBy("_item").toLocalIterator():
        if not ids or row["_item"] != ids[-1]:
            if size >= most:
                yield Block(ids, found)
                ids, found, size = [], [], 0
            ids.append(row["_item"])
            found.append(set())
        found[-1].update(terms(row["_text"]))
        size += len(row["_text"] or "")
    if ids:
        yield Block(ids, found)


def _bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """`_id`, `n` (all terms) and `bag`: (term, occurrences) as unsigned 32-bit integers, for the vocabulary's terms."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, bags = [], []
            for text in batch.column(1).to_pylist():
                found = terms(text)
                counts = Counter(map(vocabulary.get, found))
                counts.pop(None, None)
                sizes.append(len(found))
                bags.append(np.array(sorted(counts.items()), dtype="<u4").tobytes())
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())], names=["_id", "n", "bag"]
            )

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(collect, f"_id {kind}, n long, bag binary")


def _holders(bags: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each of the `size` terms; every task adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            found = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4")[0::2]
            total += np.bincount(found, minlength=size)
        present = np.flatnonzero(total)
        yield pa.record_batch([pa.array(present), pa.array(total[present])], names=["term", "docs"])

    counted = bags.select("bag").mapInArrow(count, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs"))
    out = np.zeros(size, dtype=np.int64)
    for row in counted.collect():  # no more rows than the block has terms
        out[row["term"]] = row["docs"]
    return out


def _classes(bags: DataFrame, documents: int, total: int, k: int) -> DataFrame:
    """One row per different (bag, m): `m`, `bag` and its `k` first `members` by id.

    Rows meet by a hash of both and are told apart by the values themselves. Only a class's first `k` members can be
    among an item's best; every task drops the others before the shuffle, so a class may hold any share of the rows.
    """
    m = F.expr(f"{100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * {documents}L) div {max(total, 1)}L")
    rows = bags.where("length(bag) > 0").select("_id", m.alias("m"), "bag")
    rows = rows.withColumn("key", F.xxhash64("bag", "m"))
    own = Window.partitionBy("key", "m", "bag")
    first = rows.withColumn("_place", F.row_number().over(own.orderBy(F.col("_id").asc_nulls_last()))).where(F.col("_place") <= k)
    member = F.struct(F.col("_id").isNull().alias("late"), F.col("_id").alias("id"))
    return first.groupBy("key", "m", "bag").agg(F.sort_array(F.collect_list(member)).alias("members")).drop("key")


class _Best:
    """The best rows of each item so far: score, then ascending id, NULL last."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, dtype=np.int64)
        self.rows: dict[int, list[tuple]] = {}
        self.fresh = 0

    def add(self, scores: np.ndarray, members: list[list[dict]]) -> None:
        """`scores` has a row per class and a column per item."""
        for row, item in zip(*(found.tolist() for found in np.nonzero(scores >= self.least))):
            score = int(scores[row, item])
            self.rows.setdefault(item, []).extend((-score, m["late"], m["id"]) for m in members[row])
            self.fresh += len(members[row])
        if self.fresh > GATHERED:
            self.cut()

    def cut(self) -> None:
        for item, rows in self.rows.items():
            # A NULL id compares with none: it comes after all others, and of several any is as good.
            rows.sort(key=lambda row: (row[0], row[1], 0 if row[1] else row[2]))
            del rows[self.k :]
            if len(rows) == self.k:
                self.least[item] = -rows[-1][0]
        self.fresh = 0


def _scored(classes: DataFrame, block: Block, weights: np.ndarray, k: int, id_kind: str, item_kind: str) -> DataFrame:
    """(`_place`, `item_id`, `doc_id`, `score`): each task's `k` best documents of every item."""
    count = len(block.ids)
    fans, heads, items, ids = block.fans, block.heads, block.items, block.ids

    def matrix(m: np.ndarray, bags: list[bytes]) -> np.ndarray:
        pairs = np.frombuffer(b"".join(bags), "<u4").astype(np.int64).reshape(-1, 2)
        term, tf = pairs[:, 0], pairs[:, 1]
        row = np.repeat(np.arange(len(bags)), [len(bag) // 8 for bag in bags])
        part = weights[term] * ((SCALE * tf) // (1000 * tf + SATURATION * m[row]))
        fan = fans[term]
        within = np.arange(fan.sum()) - np.repeat(np.cumsum(fan) - fan, fan)
        cell = np.repeat(row, fan) * count + items[np.repeat(heads[term], fan) + within]
        part = np.repeat(part, fan)
        # Sums of doubles below 2^53 are exact, so the halves of the numbers are summed apart.
        low = np.bincount(cell, weights=part & 0xFFFFFFFF, minlength=len(bags) * count)
        high = np.bincount(cell, weights=part >> 32, minlength=len(bags) * count)
        return ((high.astype(np.int64) << 32) + low.astype(np.int64)).reshape(len(bags), count)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, step = _Best(count, k), max(1, CELLS // count)
        for batch in batches:
            m, bags, members = (batch.column(c) for c in range(3))
            for at in range(0, batch.num_rows, step):
                part = slice(at, at + step)
                scores = matrix(m.to_numpy()[part], bags[part].to_pylist())
                best.add(scores, members[part].to_pylist())
        best.cut()
        rows = [(item, ids[item], row[2], -row[0]) for item, found in best.rows.items() for row in found]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.record_batch([pa.array(values, kind) for values, kind in zip(columns, kinds)], names=names)

    names = ["_place", "item_id", "doc_id", "score"]
    schema = f"_place int, item_id {item_kind}, doc_id {id_kind}, score long"
    empty = classes.sparkSession.createDataFrame([], schema).toArrow().schema
    kinds = [empty.field(name).type for name in names]
    return classes.select("m", "bag", "members").mapInArrow(score, schema)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The `k` best rows of `docs` for every item: `item_id`, `rank` (from 1), `doc_id` and `score` (above 0).

    A term's weight w falls with the number of documents that hold it, and a document's score is the sum of
    w * (10^9 * tf div (1000 * tf + 8 * m)) over the item's terms, where m grows with the document's length. All but the
    logarithm is 64-bit integer arithmetic.

    1. Each document becomes the bag of its terms that some item has, beside its number of all terms.
    2. Documents with equal bags and equal m are a class: they have the same score for every item. Classes meet by a
       hash and are told apart by the bags themselves.
    3. Every class is scored once against all items that share a term; each task keeps the best of what it has seen, and
       a class's members follow in ascending order of ids.

    The vocabulary and the items' lists are sent to all tasks; items are taken in blocks of `block_chars` characters, with
    one pass over the documents for each, so what is sent has a bound. NULL and empty texts have no terms: such
    documents count for nothing and such items get no rows. A NULL id comes after all others; rows that repeat an id are
    ranked each. Rows of `items` with one id (or all without) are one item. Ids are of any type that sorts alike in Spark
    and Python. Other columns are ignored; an empty table on either side gives no rows.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_kind = base.schema["_id"].dataType.simpleString()
    wanted = items.select(F.col(item_col).alias("_item"), F.col(item_text).alias("_text"))
    item_kind = wanted.schema["_item"].dataType.simpleString()
    out = docs.sparkSession.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {id_kind}, score long")
    for block in _blocks(wanted, block_chars):
        bags = materialise(_bags(base, block.vocabulary), "bags")
        sums = bags.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("total")).first()
        documents, total = sums["documents"], sums["total"] or 0
        holders = _holders(bags, len(block.vocabulary))
        weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in holders.tolist()]
        classes = materialise(_classes(bags, documents, total, k), "classes")
        rows = _scored(classes, block, np.array(weights, dtype=np.int64), k, id_kind, item_kind)
        best = Window.partitionBy("_place").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        out = out.unionByName(ranked.select("item_id", "rank", "doc_id", "score"))
    return out


_TERM_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


@query(
    f"""
    WITH t AS (SELECT doc_id, unnest({_TERM_SQL}) AS term FROM documents),
    d AS (SELECT doc_id, count(*) AS size FROM t GROUP BY doc_id),
    s AS (SELECT count(*) AS docs, sum(size)::BIGINT AS total FROM d),
    i AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERM_SQL}) AS term FROM benchmark)),
    f AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM i) GROUP BY ALL),
    w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS weight
          FROM f, s GROUP BY term),
    r AS (
      SELECT item_id, doc_id,
             sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * docs) // total))))::BIGINT AS score
      FROM i JOIN f USING (term) JOIN w USING (term) JOIN d USING (doc_id), s
      GROUP BY item_id, doc_id
    )
    SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score
    FROM r WHERE score > 0
    WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
    QUALIFY row_number() OVER best <= 10
    """
)
def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
