"""MinHash near-duplicates by an inverted join over signature coordinates.

Documents are posted under the coordinate-value pairs of their signatures, and pairs that meet in enough lists are
confirmed on their full sets. Of each document's lists only the rarest are merged (the prefix); the long ones are skipped, and
their coordinates compared only for pairs that a short list has brought together. No list is multiplied with itself:
its members meet one leader first, and what stays apart is compared in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chargetrail.llm.components import connected_components
from chargetrail.llm.registry import query, read
from chargetrail.llm.words import Words, numbers, pieces, runs
from chargetrail.session import materialise

#: Documents of either side that are compared in one task, when those that a leader did not join are compared with all.
BLOCK = 512
COORDINATES = 64
PERCENT = 85
_FACTORS, _OFFSETS = numbers(COORDINATES, 4) | np.uint64(1), numbers(COORDINATES, 5)


def least_matches(percent: int) -> int:
    """Equal coordinates that a candidate needs: 4.5 standard deviations below the mean of a pair at the limit, which
    a linked pair misses less than once in 100,000 times."""
    p = percent / 100
    return max(1, int(COORDINATES * p - 4.5 * (COORDINATES * p * (1 - p)) ** 0.5))


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of `words` words; a shorter text is one shingle."""
    out: list[np.ndarray] = []
    for group in pieces(texts):
        found = Words([texts[i] for i in group], lower=True)
        hashes = found.hashes()
        shingles = runs(hashes, words)
        for i in range(len(found)):
            own = found.span(i)
            if own.stop - own.start >= words:
                out.append(np.unique(shingles[own.start : own.stop - words + 1]))
            else:
                out.append(runs(hashes[own], max(own.stop - own.start, 1)))
    return out


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """One row of `COORDINATES` 32-bit minima per set; the sets are not empty."""
    rows = np.empty((len(sets), COORDINATES), dtype=np.uint32)
    values, heads = np.concatenate(sets), np.cumsum([0, *[len(s) for s in sets[:-1]]])
    for j, (factor, offset) in enumerate(zip(_FACTORS, _OFFSETS)):
        hashed = ((values * factor + offset) >> np.uint64(32)).astype(np.uint32)
        rows[:, j] = np.minimum.reduceat(hashed, heads)
    return rows


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _signatures(docs: DataFrame, words: int) -> DataFrame:
    """`_id`, `mark` (to tell texts of one id apart), `n` (set size), `key` (digest of the set) and `signature`; the last is
    NULL for an empty set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), words)
            rows: list = [None] * len(sets)
            for group in pieces([" " * len(s) for s in sets], 1 << 17):
                full = [i for i in group if len(sets[i])]
                if full:
                    for i, row in zip(full, minhash([sets[i] for i in full]).view(np.int32)):
                        rows[i] = row
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    pa.array(rows, pa.list_(pa.int32())),
                ],
                names=["_id", "mark", "n", "key", "signature"],
            )

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(sign, f"_id {kind}, mark long, n long, key binary, signature array<int>")


def _prefixes(nodes: DataFrame, matches: int) -> DataFrame:
    """`node` and `tokens`: the coordinate-value pairs of its prefix.

    Two nodes with `matches` equal coordinates share one of the rarest `COORDINATES - matches + 1` pairs of both, in
    one order of all pairs. Pairs that a single node has link nothing and count as the rarest; so a node with less than
    `matches` other pairs is left out, and the prefix of the rest is what remains of it after its lonely pairs.
    """
    token = F.shiftleft(F.col("place").cast("long"), 32) + F.col("value").cast("long").bitwiseAND((1 << 32) - 1)
    pairs = nodes.select("node", F.posexplode("signature").alias("place", "value")).select("node", token.alias("token"))
    counts = materialise(pairs.groupBy("token").agg(F.count("*").alias("nodes")).where("nodes > 1"), "counts")
    shared = (
        pairs.join(counts, "token")
        .groupBy("node")  # at most COORDINATES rows each
        .agg(F.sort_array(F.collect_list(F.struct("nodes", "token"))).alias("tokens"))
        .where(F.size("tokens") >= matches)
    )
    prefix = F.slice("tokens", F.lit(1), F.size("tokens") - (matches - 1))
    return shared.select("node", prefix["token"].alias("tokens"))


def _sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """`node`, `n`, `signature` and `set` (its distinct shingles) of `nodes`, which know their smallest id and digest.

    A node may have several equal rows, where rows of the table are equal.
    """

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), words)
            # Another text of the same id has another digest.
            own = [i for i, key in enumerate(batch.column(2).to_pylist()) if _digest(sets[i]) == key]
            found = [sets[i] for i in own]
            signed = list(minhash(found).view(np.int32)) if found else []
            yield pa.record_batch(
                [
                    batch.column(0).take(pa.array(own, pa.int64())),
                    pa.array([len(s) for s in found], pa.int64()),
                    pa.array(signed, pa.list_(pa.int32())),
                    pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64())),
                ],
                names=["node", "n", "signature", "set"],
            )

    wanted = docs.join(nodes.select("node", "first", "key"), F.col("_id") == F.col("first")).select("node", "_text", "key")
    return wanted.mapInArrow(collect, "node long, n long, signature array<int>, set array<long>")


def _linkable(sets: DataFrame, percent: int) -> DataFrame:
    """`node` and `s`, how many of its shingles any other node has, where these are enough for a link.

    A pair has no more in common than `s` of either, and no fewer altogether than `n` of either. So a document whose own
    words are more than the limit allows is compared with nothing, such as a form letter with its own contents.
    """
    shingles = sets.select("node", F.explode("set").alias("shingle"))
    lonely = shingles.groupBy("shingle").agg(F.count("*").alias("nodes"), F.min("node").alias("node")).where("nodes = 1")
    own = lonely.groupBy("node").agg(F.count("*").alias("own"))
    sizes = sets.groupBy("node").agg(F.min("n").alias("n"))
    shared = (F.col("n") - F.coalesce("own", F.lit(0))).alias("s")
    return sizes.join(own, "node", "left").select("node", "n", shared).where(100 * F.col("s") >= percent * F.col("n"))


def _within(s: Column, t: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether two sets of `n` and `m` shingles, `s` and `t` of them shared with any, may be similar enough."""
    common = F.least(s, t)
    return 100 * common >= percent * (n + m - common)


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _flat(column: pa.Array, kind: type) -> list[np.ndarray]:
    """The lists of a column as arrays, without a copy."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values, ends = column.values.to_numpy(zero_copy_only=False).view(kind), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends, ends[1:])]


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (`a`, `b`) with enough equal coordinates whose full sets are similar enough."""
    matches = least_matches(percent)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [_flat(batch.column(name), kind) for name, kind in zip(names, (np.uint32, np.uint32, np.uint64, np.uint64))]
            keep = [
                bool(np.count_nonzero(first == second) >= matches and _similar(x, y, percent))
                for first, second, x, y in zip(*sides)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("signature").alias(f"sig_{name}"), F.col("set").alias(f"set_{name}"))

    names = ["sig_a", "sig_b", "set_a", "set_b"]
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", *names)
    return joined.mapInArrow(confirm, "a long, b long").distinct()


def _links(postings: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stars (`node`, `component`) of all nodes that are linked, from (`token`, `node`, `n`, `s`).

    1. The leader of a list is the node with the smallest share of shingles of its own, so the one that most others
       differ least from. Collisions of each node with its lists' leaders are counted, and it is compared with the leader
       that it meets most often. That joins nearly all of a large group of copies.
    2. Lists whose nodes are not all in one component by then are gathered by leader. Nodes outside the largest component
       there are compared with all nodes of other components (`_apart`), in blocks. A pair within one component needs no
       comparison, so no link between components is lost.
    """
    rank = F.struct(F.col("s") / F.col("n"), F.col("n"), -F.col("node"))
    leaders = postings.groupBy("token").agg(F.max_by(F.struct("node", "n", "s"), rank).alias("leader"))
    leaders = materialise(leaders, "leaders")
    lead = F.col("leader.node")
    may = _within(F.col("s"), F.col("leader.s"), F.col("n"), F.col("leader.n"), percent)
    met = postings.join(leaders, "token").where((F.col("node") != lead) & may)
    collisions = met.groupBy("node", lead.alias("lead")).agg(F.count("*").alias("lists"))
    best = collisions.groupBy("node").agg(F.max_by("lead", F.struct("lists", -F.col("lead"))).alias("lead"))
    pairs = materialise(best.select(F.col("node").alias("a"), F.col("lead").alias("b")), "pairs")
    links = materialise(_confirmed(pairs, sets, percent), "links")
    stars = materialise(connected_components(links), "stars")
    more = materialise(_apart(postings, leaders, stars, sets, percent), "more")
    if more.isEmpty():
        return stars
    known = stars.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected_components(known.unionByName(more))


def _apart(postings: DataFrame, leaders: DataFrame, stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (`a`, `b`) between nodes of a list that are not in one component yet.

    The few outside a hub's largest component, and all its nodes, are dealt to blocks of about `BLOCK` each, and every block of
    the few meets every block of all in a task of its own. There, collisions of all coordinates are counted, and pairs above
    the threshold confirmed on their sets; of pairs that are joined already through others in the task none is tried. Rows
    are repeated once per block of the other side and not once per pair.
    """
    matches = least_matches(percent)
    labelled = postings.join(stars, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = materialise(labelled, "labelled")
    mixed = labelled.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.where("low != high").select("token").join(leaders.select("token", F.col("leader.node").alias("hub")), "token")
    hubs = labelled.join(mixed, "token").select("hub", "node", "component", "n", "s").distinct()
    hubs = materialise(hubs, "hubs")
    sizes = hubs.groupBy("hub", "component").agg(F.count("*").alias("nodes"))
    sizes = sizes.groupBy("hub").agg(
        F.max_by("component", F.struct("nodes", "component")).alias("largest"),
        F.sum("nodes").alias("all"),
        (F.sum("nodes") - F.max("nodes")).alias("few"),
    )

    def blocks(count: str) -> Column:
        return F.ceil(F.col(count) / BLOCK).cast("int")

    sizes = materialise(sizes.select("hub", "largest", blocks("few").alias("fews"), blocks("all").alias("alls")), "sizes")
    own = sets.dropDuplicates(["node"]).select("node", "signature", "set")
    known = hubs.join(sizes, "hub").join(own, "node")
    columns = ["node", "component", "n", "s", "signature", "set"]

    def dealt(rows: DataFrame, mine: str, others: str, names: tuple[str, str]) -> DataFrame:
        place = F.pmod(F.xxhash64("node", F.lit(mine)), F.col(mine)).cast("int").alias(names[0])
        each = F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(names[1])
        rows = rows.select("hub", place, *columns, others).select("hub", names[0], each, *columns)
        return rows.toDF(*rows.columns)  # columns of their own on either side

    few = dealt(known.where("component != largest"), "fews", "alls", ("i", "j"))
    every = dealt(known, "alls", "fews", ("j", "i"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        joined: dict[int, int] = {}

        def top(x: int) -> int:
            while (above := joined.get(x, x)) != x:
                joined[x] = joined.get(above, above)
                x = above
            return x

        out_a, out_b = [], []
        if left.num_rows and right.num_rows:
            nodes, groups = (right.column(c).to_pylist() for c in ("node", "component"))
            n, s = (right.column(c).to_numpy() for c in ("n", "s"))
            signed, found = np.stack(_flat(right.column("signature"), np.uint32)), _flat(right.column("set"), np.uint64)
            for node, group, size, shared, signature, own in zip(
                *(left.column(c).to_pylist() for c in ("node", "component", "n", "s")),
                _flat(left.column("signature"), np.uint32),
                _flat(left.column("set"), np.uint64),
            ):
                common = np.minimum(s, shared)
                likely = 100 * common >= percent * (n + size - common)
                likely &= np.count_nonzero(signed == signature, axis=1) >= matches
                for at in np.flatnonzero(likely).tolist():
                    if top(groups[at]) != top(group) and _similar(own, found[at], percent):
                        out_a.append(node)
                        out_b.append(nodes[at])
                        joined[top(groups[at])] = top(group)
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    keys = ["hub", "i", "j"]
    return few.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInArrow(compare, "a long, b long")


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(F.col(text_col)).alias("_mark")
    )


def _components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """`_id`, `mark`, `n` and `component` of every row of (`_id`, `_text`, `_mark`)."""
    matches = least_matches(percent)
    signed = materialise(_signatures(docs, words), "signatures")
    filled = signed.where("n > 0 AND _id IS NOT NULL")
    nodes = filled.groupBy("key").agg(F.min("_id").alias("first"), F.first("signature").alias("signature"))
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    # First all nodes that share enough coordinates with any; then, of these, those with enough shared shingles.
    members = materialise(nodes.join(_prefixes(nodes, matches).select("node"), "node", "left_semi"), "members")
    sets = materialise(_sets(docs, members, words), "sets")
    able = materialise(_linkable(sets, percent), "linkable")
    prefixes = _prefixes(members.join(able.select("node"), "node", "left_semi"), matches)
    postings = able.join(prefixes, "node").select("node", "n", "s", F.explode("tokens").alias("token"))
    stars = _links(materialise(postings, "postings"), sets, percent)

    classes = nodes.select("key", "first", "node").join(stars, "node", "left")
    classes = classes.withColumn("component", F.coalesce("component", "node"))
    least = classes.groupBy("component").agg(F.min("first").alias("least"))
    classes = classes.join(materialise(least, "least"), "component").select(F.col("key").alias("_key"), "least")
    classes = materialise(classes, "classes")
    joined = signed.join(classes, (F.col("key") == F.col("_key")) & (F.col("n") > 0) & F.col("_id").isNotNull(), "left")
    return joined.select("_id", "mark", "n", F.coalesce("least", "_id").alias("component"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, percent: int = PERCENT
) -> DataFrame:
    """Per row of `docs`: id, `n_shingles`, `component_id` (smallest id reachable by links) and `kept` (whether that
    is the row's own id). Two documents are linked if the Jaccard similarity of their sets of `words`-word shingles is
    at least `percent` %.

    Documents with equal sets are one class, compared once. Classes are posted under the coordinates of their MinHash
    signature (`_prefixes`), candidates need `least_matches` equal coordinates, and every link is confirmed on full sets,
    which are built for candidates only.

    Texts without words are linked with nothing. A row with a NULL id is linked with nothing, has a NULL component and
    is kept. Rows that repeat an id are decided each by its own text. Other columns are ignored; an empty table gives no
    rows.
    """
    found = _components(_marked(docs, id_col, text_col), words, percent)
    return found.select(
        F.col("_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("_id").eqNullSafe(F.col("component")).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one document of each group of near-duplicates, with all columns.

    Rows go by id and text, so of an id with several texts only those go that are near copies of an earlier document. Rows
    with a NULL id and texts without words all stay.
    """
    found = _components(_marked(docs, id_col, text_col), words, percent)
    gone = found.where("_id != component").select(F.col("_id").alias("_gone"), F.col("mark").alias("_mark")).distinct()
    gone = materialise(gone, "gone")
    same = (docs[id_col] == gone["_gone"]) & (F.xxhash64(docs[text_col]) == gone["_mark"])
    return docs.join(gone, same, "left_anti")


@query()
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
