"""Near duplicates against brute force, with many pairs around the limit."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from chargetrail.llm import exact_dedup, near_dedup
from chargetrail.llm.registry import prepared, read
from tests.llm.conftest import DOCS


def shingles(text, size):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).split()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)] if words else [])


def brute(rows, size, percent):
    """Id, set size and component of every row, by comparing all pairs that share a shingle."""
    sets = [shingles(text, size) for _, text in rows]
    posts = defaultdict(list)
    for k, own in enumerate(sets):
        if rows[k][0] is not None:
            for shingle in own:
                posts[shingle].append(k)
    top = list(range(len(rows)))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    links = 0
    for k, own in enumerate(sets):
        if rows[k][0] is None:
            continue
        common = Counter(other for shingle in own for other in posts[shingle] if other < k)
        for other, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[other]) - n):
                links += 1
                a, b = find(k), find(other)
                top[max(a, b)] = min(a, b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(least.get(find(k), doc), doc)
    return [(doc, len(sets[k]), least.get(find(k)) if sets[k] else doc) for k, (doc, _) in enumerate(rows)], links


def corpus(seed, size, percent):
    """Groups whose members differ from a base in ever more words, so that many pairs lie around the limit, in chains
    as well; and form letters that differ in contents of their own, or in contents that many have."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(50_000)}"
    texts = []
    for _ in range(12):
        base = [word() for _ in range(draw.choice([8, 30, 120]))]
        most = max(1, round(len(base) * (100 - percent) / 100 / size * 1.4))
        for _ in range(25):
            text = list(base)
            for _ in range(draw.randint(0, most)):
                text[draw.randrange(len(text))] = word()
            texts.append(text)
        chain = list(base)
        for _ in range(10):
            chain = list(chain)
            chain[draw.randrange(len(chain))] = word()
            texts.append(chain)
    letter, fillers = [word() for _ in range(60)], [[word() for _ in range(20)] for _ in range(6)]
    texts += [[*letter, *(word() for _ in range(25))] for _ in range(60)]
    texts += [[*letter, *draw.choice(fillers), *draw.choice(fillers)] for _ in range(60)]
    draw.shuffle(texts)
    rows = [(3 * k, " ".join(t)) for k, t in enumerate(texts)]
    return rows + [(3, "only here under an id that has another text"), (None, rows[5][1]), (6, rows[2][1])]


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
@pytest.mark.parametrize("block", [7, 512])
def test_all_links_are_found(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = corpus(size + block, size, percent)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    wanted, links = brute(rows, size, percent)
    assert links > 300
    got = near_dedup.near_duplicates(docs.selectExpr("*", "1 AS node", "'x' AS signature"), words=size, percent=percent)
    got = Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect())
    assert got == Counter(wanted)  # a missed pair has a chance below 1 in 100,000, and most have other ways
    left = near_dedup.drop_near_copies(docs, words=size, percent=percent)
    kept = Counter(row for row, (doc, _, component) in zip(rows, wanted) if doc is None or doc == component)
    assert Counter(tuple(r) for r in left.collect()) == kept


def test_form_letters_are_compared_with_nothing(spark):
    """Documents with a common part of 70% and contents of their own are no candidates, however many there are."""
    draw = random.Random(1)
    letter = " ".join(f"l{i}" for i in range(70))
    rows = [(k, letter + " " + " ".join(f"w{draw.randrange(10**9)}" for _ in range(30))) for k in range(400)]
    docs = prepared(spark).createDataFrame(rows, "_id long, _text string").selectExpr("*", "0L AS _mark")
    signed = near_dedup._signatures(docs, 3).withColumnsRenamed({"_id": "first"}).withColumn("node", near_dedup.F.col("first"))
    members = signed.join(near_dedup._prefixes(signed, near_dedup.least_matches(85)).select("node"), "node", "left_semi")
    assert members.count() > 100
    sets = near_dedup._sets(docs, members, 3)
    assert near_dedup._linkable(sets, 85).isEmpty()
    assert near_dedup.near_duplicates(docs, "_id", "_text").where("kept").count() == 400


def test_a_missed_candidate_is_rare():
    """Of pairs at the limit all but a few in a million have the coordinates that a candidate needs."""
    draw = np.random.default_rng(4)
    for percent in (80, 85):
        matches = near_dedup.least_matches(percent)
        sets = []
        for _ in range(1500):
            common = draw.integers(0, 1 << 63, 2 * percent, dtype=np.uint64)
            rest = draw.integers(0, 1 << 63, 2 * (100 - percent), dtype=np.uint64)
            half = len(rest) // 2
            sets += [np.unique(np.concatenate([common, rest[:half]])), np.unique(np.concatenate([common, rest[half:]]))]
        signed = near_dedup.minhash(sets)
        assert (np.count_nonzero(signed[0::2] == signed[1::2], axis=1) >= matches).mean() == 1.0


def test_stages_lose_no_text(spark):
    """An id with two texts: only the one that is a copy goes."""
    rows = [(1, "A"), (5, "A"), (5, "only here"), (5, "only here"), (None, "A"), (None, None), (7, None), (8, "")]
    docs = prepared(spark).createDataFrame([(i, t, "en", "s", 1, "x", "y", "z") for i, t in rows], DOCS)
    for drop, kept in (
        (exact_dedup.drop_exact_copies, [(1, "A"), (5, "only here"), (5, "only here"), (None, "A"), (None, None), (7, None)]),
        (near_dedup.drop_near_copies, [(1, "A"), *rows[2:]]),
    ):
        left = drop(docs)
        assert left.columns == docs.columns
        assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(kept)


def test_query_7_on_the_small_tables(spark):
    from chargetrail.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in read(spark, sf, "documents").collect()]
    got = QUERIES["op7_minhash_near_dedup"](spark, sf)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert Counter(tuple(r) for r in got.collect()) == Counter((d, n, c, d == c) for d, n, c in brute(rows, 3, 85)[0])
