"""Approximate nearest neighbours by inner product: a forest of random-projection trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chargetrail.llm.registry import query, read
from chargetrail.session import materialise

TREES = 8
SAMPLE = 16_384
LEAF = 256
#: A query searches leaves until they hold this share of the entries of all trees, and at least so many. The share is
#: what vectors without any structure need for a recall of 0.9; clustered ones do with much less.
SHARE = 0.11
LEAST = 8_000
BLOCK = 4096


@dataclass
class Forest:
    """Trees over vectors with one more component that makes all lengths equal.

    Node i of a tree sends a vector to `children[i, 0]` if `directions[i] @ vector <= cuts[i]`, else to
    `children[i, 1]`; a child c < 0 is leaf -c - 1. `roots[t]` is the first node, or leaf, of tree t. Leaves are
    numbered through all trees.
    """

    directions: np.ndarray
    cuts: np.ndarray
    children: np.ndarray
    roots: np.ndarray
    longest: float

    def extended(self, vectors: np.ndarray) -> np.ndarray:
        """Data vectors, scaled to length at most 1, with the component that makes it 1."""
        scaled = vectors / self.longest
        rest = np.sqrt(np.maximum(1 - (scaled * scaled).sum(axis=1), 0))
        return np.column_stack([scaled, rest])

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each data vector in each tree."""
        points = self.extended(vectors)
        out = np.empty((len(points), len(self.roots)), dtype=np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(points), root)
            while len(inside := np.flatnonzero(at >= 0)):
                node = at[inside]
                side = np.einsum("ij,ij->i", self.directions[node], points[inside]) > self.cuts[node]
                at[inside] = self.children[node, side.astype(int)]
            out[:, t] = -at - 1
        return out

    def probes(self, queries: np.ndarray, counts: np.ndarray, enough: int) -> list[list[int]]:
        """For each query the leaves to search: one queue for all trees, nearest side first, until the leaves hold
        `enough` vectors (one in several trees counts in each) or no leaf is left."""
        units = queries / np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-300)
        margins = np.column_stack([units, np.zeros(len(units))]) @ self.directions.T - self.cuts
        out = []
        for row in margins.tolist():
            queue = [(-np.inf, int(root)) for root in self.roots]
            found, held = [], 0
            while queue and held < enough:
                far, at = heapq.heappop(queue)
                while at >= 0:
                    margin, (low, high) = row[at], self.children[at].tolist()
                    heapq.heappush(queue, (max(far, abs(margin)), low if margin > 0 else high))
                    at = high if margin > 0 else low
                found.append(-at - 1)
                held += int(counts[-at - 1])
            out.append(found)
        return out


def grow(vectors: np.ndarray, longest: float, trees: int = TREES, leaf: int = LEAF, seed: int = 7) -> Forest:
    """Split a sample at the median of random projections until `leaf` vectors are left."""
    forest = Forest(np.zeros((0, 0)), np.zeros(0), np.zeros((0, 2), dtype=np.int64), np.zeros(0, dtype=np.int64), longest)
    points = forest.extended(vectors)
    random = np.random.default_rng(seed)
    directions, cuts, children, roots, n_leaves = [], [], [], [], 0
    for _ in range(trees):
        pending = [(np.arange(len(points)), None)]
        while pending:
            own, parent = pending.pop()
            split = None
            for _ in range(5 if len(own) > leaf else 0):
                direction = random.normal(size=points.shape[1])
                along = points[own] @ direction
                cut = float(np.median(along))
                if 0 < (along <= cut).sum() < len(own):
                    split = direction, cut, along <= cut
                    break
            if split is None:
                at = -n_leaves - 1
                n_leaves += 1
            else:
                at = len(directions)
                length = np.linalg.norm(split[0])
                directions.append(split[0] / length)
                cuts.append(split[1] / length)
                children.append([0, 0])
                pending += [(own[split[2]], (at, 0)), (own[~split[2]], (at, 1))]
            if parent is None:
                roots.append(at)
            else:
                children[parent[0]][parent[1]] = at
    width = points.shape[1]
    return Forest(
        np.array(directions).reshape(-1, width), np.array(cuts), np.array(children, dtype=np.int64).reshape(-1, 2),
        np.array(roots), longest,
    )


def usable(vector: Column) -> Column:
    """Vectors that have a direction: not NULL or empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _length(vector: str) -> Column:
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return F.sqrt(squares)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = TREES,
    sample: int = SAMPLE,
    leaf: int = LEAF,
    share: float = SHARE,
    least: int = LEAST,
) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: for each row of `vectors` where `queries` holds, the `k` nearest other
    rows found, by inner product in double precision, ties by smaller id.

    1. Equal vectors are one class, known by its smallest id, so copies neither fill a leaf nor are compared again.
    2. The forest is grown in one task on the `sample` classes with the smallest hashes. Every class is then put into
       a leaf of every tree. A further component that makes all lengths equal turns largest inner product into
       nearest direction.
    3. Each query class draws leaves from one priority queue over all trees until they hold `share` of all
       entries, and at least `least`.
    4. Leaves meet their queries, in blocks of at most about `BLOCK` vectors and queries; each block gives a query its
       best `k` + 1 classes with scores on the original vectors. The best of all blocks are ranked, and classes
       replaced by their smallest ids: the `k` + 1 smallest, which is all that can be among the `k` nearest.

    Vectors that are NULL, empty, zero or hold a NULL or non-finite component take no part, nor do NULL ids, nor
    vectors whose dimension is not the most frequent one. Rows that repeat id and vector count once. An empty table,
    or one without queries, gives no rows; with fewer than `k` others all are returned. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), queries.alias("asks")
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    shape = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("rows"), F.max(_length("vector")).alias("longest"))
    shape = shape.orderBy(F.desc("rows"), "width").first()
    out = "query_id long, rank int, vec_id long, score double"
    if shape is None:
        return spark.createDataFrame([], out)
    width, longest = shape["width"], shape["longest"]
    rows = rows.where(F.size("vector") == width)

    classes = rows.groupBy("vector").agg(F.min("id").alias("class"), F.max(F.coalesce("asks", F.lit(False))).alias("asks"))
    classes = materialise(classes, "classes")
    members = rows.join(classes.select("vector", "class"), "vector").select("id", "class", "asks").distinct()
    members = materialise(members, "members")

    forest = _grown(classes, width, longest, trees, sample, leaf)
    placed = materialise(_placed(classes, forest, width), "placed")
    # At most trees * sample leaves, whatever the size of the table.
    counts = np.zeros(int(forest.children.min(initial=0, where=forest.children < 0) * -1 + 1) + trees, dtype=np.int64)
    for row in placed.groupBy("leaf").count().collect():
        counts[row["leaf"]] = row["count"]
    enough = max(least, int(share * counts.sum()))
    asked = materialise(_asked(classes.where("asks"), forest, counts, enough, width), "asked")

    pairs = _scored(placed, asked, counts, k, width)
    pairs = pairs.groupBy("query", "class").agg(F.max("score").alias("score"))
    by_query = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    best = pairs.withColumn("place", F.row_number().over(by_query)).where(F.col("place") <= k + 1)
    by_class = Window.partitionBy("class").orderBy("id")
    few = members.select("id", "class").distinct().withColumn("nth", F.row_number().over(by_class)).where(F.col("nth") <= k + 1)
    best, few = materialise(best.drop("place"), "best"), materialise(few.drop("nth"), "few")

    listed = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    lists = best.join(few, "class").withColumn("place", F.row_number().over(listed)).where(F.col("place") <= k + 1)
    lists = lists.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("found"))
    lists = materialise(lists, "lists")
    asking = members.where("asks").select(F.col("id").alias("query_id"), F.col("class").alias("query")).distinct()
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    return (
        asking.join(lists, "query")
        .select("query_id", F.posexplode(others).alias("at", "other"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("other.id").alias("vec_id"), F.col("other.score").alias("score"))
    )


def _grown(classes: DataFrame, width: int, longest: float, trees: int, sample: int, leaf: int) -> Forest:
    chosen = classes.select("class", "vector").orderBy(F.xxhash64("class"), "class").limit(sample)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        parts = [(b.column(0).to_numpy(), _matrix(b.column(1), width)) for b in batches]
        ids = np.concatenate([i for i, _ in parts])
        forest = grow(np.concatenate([v for _, v in parts])[np.argsort(ids)], longest, trees, leaf)
        fields = [forest.directions, forest.cuts, forest.children, forest.roots]
        yield pa.record_batch([pa.array([f.tobytes()], pa.binary()) for f in fields], names=list("abcd"))

    row = chosen.repartition(1).mapInArrow(fit, "a binary, b binary, c binary, d binary").first()
    return Forest(
        np.frombuffer(row[0], float).reshape(-1, width + 1), np.frombuffer(row[1], float),
        np.frombuffer(row[2], np.int64).reshape(-1, 2), np.frombuffer(row[3], np.int64), longest,
    )


def _placed(classes: DataFrame, forest: Forest, width: int) -> DataFrame:
    """(`leaf`, `class`, `vector`): each class in its leaf of every tree."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = forest.leaves(_matrix(batch.column(1), width))
            again = pa.array(np.repeat(np.arange(batch.num_rows), leaves.shape[1]))
            yield pa.record_batch(
                [pa.array(leaves.ravel()), batch.column(0).take(again), batch.column(1).take(again)],
                names=["leaf", "class", "vector"],
            )

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.select("class", "vector").mapInArrow(place, f"leaf long, class long, vector {kind}")


def _asked(classes: DataFrame, forest: Forest, counts: np.ndarray, enough: int, width: int) -> DataFrame:
    """(`leaf`, `query`, `vector`): each query class at the leaves that it searches."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            probes = forest.probes(_matrix(batch.column(1), width), counts, enough)
            again = pa.array(np.repeat(np.arange(batch.num_rows), [len(p) for p in probes]))
            leaves = np.array([leaf for p in probes for leaf in p], dtype=np.int64)
            yield pa.record_batch(
                [pa.array(leaves), batch.column(0).take(again), batch.column(1).take(again)],
                names=["leaf", "query", "vector"],
            )

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.select("class", "vector").mapInArrow(ask, f"leaf long, query long, vector {kind}")


def _scored(placed: DataFrame, asked: DataFrame, counts: np.ndarray, k: int, width: int) -> DataFrame:
    """(`query`, `class`, `score`): the best `k` + 1 classes of each query in each block of each leaf.

    A leaf with more than `BLOCK` vectors, or as many queries, is cut into blocks by hash, and each block of the one
    meets each block of the other.
    """

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ("query", "class", "score")
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], pa.float64() if n == "score" else pa.int64()) for n in names})
        data, ids = _matrix(left.column("vector").combine_chunks(), width), left.column("class").to_numpy()
        asks, own = _matrix(right.column("vector").combine_chunks(), width), right.column("query").to_numpy()
        best, parts = min(k + 1, len(ids)), []
        # A product and the exact score differ by less than this share of both lengths; ties at the end all stay.
        bound = 4 * (width + 1) * np.finfo(float).eps * np.sqrt((data * data).sum(axis=1).max())
        for at in range(0, len(own), 512):
            some = asks[at : at + 512]
            products = some @ data.T
            least = np.partition(products, len(ids) - best, axis=1)[:, len(ids) - best]
            least -= bound * np.sqrt((some * some).sum(axis=1))
            asking, near = np.nonzero(products >= least[:, None])
            # Summed pair by pair: a pair has the same score in whatever block it is met.
            cuts = range(0, len(near), 16_384)
            exact = [(some[asking[i : i + 16_384]] * data[near[i : i + 16_384]]).sum(axis=1) for i in cuts]
            exact = np.concatenate(exact)
            order = np.lexsort((ids[near], -exact, asking))  # queries stay in their places
            place = np.arange(len(near)) - np.searchsorted(asking, asking)
            order = order[place < best]
            parts.append((own[at : at + 512][asking[order]], ids[near[order]], exact[order]))
        return pa.table({n: pa.array(np.concatenate([p[i] for p in parts])) for i, n in enumerate(names)})

    def blocks(rows: Column) -> Column:
        return F.ceil(rows / F.lit(BLOCK)).cast("int")

    sizes = placed.groupBy("leaf").agg(F.count("*").alias("data_rows")).join(
        asked.groupBy("leaf").agg(F.count("*").alias("query_rows")), "leaf"
    )
    # One row per leaf: bounded by the forest, not by the table.
    sizes = sizes.select("leaf", blocks(F.col("data_rows")).alias("nd"), blocks(F.col("query_rows")).alias("nq"))
    sizes = F.broadcast(materialise(sizes, "sizes"))

    def dealt(df: DataFrame, own: str, n_own: str, n_other: str, mine: str, other: str) -> DataFrame:
        part = F.pmod(F.xxhash64(own), F.col(n_own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(n_other) - 1))
        return df.join(sizes, "leaf").select("leaf", own, "vector", part.alias(mine), every.alias(other))

    keys = ["leaf", "db", "qb"]
    data = dealt(placed, "class", "nd", "nq", "db", "qb")
    asks = dealt(asked, "query", "nq", "nd", "qb", "db")
    return data.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInArrow(score, "query long, class long, score double")


@query()
def op3_forest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
