import numpy as np
import pytest
from pyspark.sql import functions as F

from chargetrail.llm import forest, quality, toxicity
from tests.llm.conftest import texts


def sentences(n, toxic_words=("scum", "idiot"), seed=3):
    random = np.random.default_rng(seed)
    plain = [f"{a}{b}" for a in ("ma", "lo", "ti", "re", "su") for b in ("ne", "ra", "lum", "dor", "vis", "ka")]
    out = []
    for i in range(n):
        own = list(random.choice(plain, 30))
        label = int(i % 3 == 0)
        if label:
            own[int(random.integers(30))] = str(random.choice(toxic_words))
        if random.random() < (0.9 if label else 0.2):
            own[0] = "women"
        out.append((i, " ".join(own), label))
    return out


def test_toxicity_ignores_the_group_that_is_named():
    rows = sentences(600)
    y = np.array([label for _, _, label in rows])
    counts = {0: int((y == 0).sum()), 1: int(y.sum())}
    model = toxicity.fit([t for _, t, _ in rows], y, counts)
    scores = model.scores([t for _, t, _ in rows])
    assert ((scores >= 0.5) == (y == 1)).mean() > 0.99
    neutral = next(t for _, t, label in rows if not label and t.startswith("women "))
    a, b = model.scores([neutral, neutral.replace("women", "men")])
    assert abs(a - b) < 0.05 and a < 0.5
    assert toxicity.swapped("Women, and men.") == ["Men, and women."]
    assert toxicity.swapped("no group") == []


def test_neutral_mentions_with_and_without_the_penalty():
    """Held-out neutral sentences about a group that the training texts mostly insult."""
    rows = sentences(900, seed=7)
    train, held_out = rows[:600], rows[600:]
    y = np.array([label for _, _, label in train])
    counts = {0: int((y == 0).sum()), 1: int(y.sum())}
    plain = toxicity.fit([t for _, t, _ in train], y, counts, names=())
    fair = toxicity.fit([t for _, t, _ in train], y, counts)
    assert plain.pairs == 0 and fair.pairs >= len(train) + sum("women" in t for _, t, _ in train)
    neutral = [t for _, t, label in held_out if not label]
    about = [t for t in neutral if t.startswith("women ")]
    other = [t.replace("women ", "men ", 1) for t in about]

    def change(model):
        return np.abs(model.scores(about) - model.scores(other)).mean()

    assert change(fair) < 0.2 * change(plain) and change(fair) < 0.02
    assert fair.scores(about).mean() < plain.scores(about).mean()
    assert (fair.scores(about) >= 0.5).mean() <= (plain.scores(about) >= 0.5).mean()
    right = [((model.scores([t for _, t, _ in held_out]) >= 0.5) == [label for _, _, label in held_out]).mean() for model in (plain, fair)]
    assert right[1] >= right[0] - 0.01 > 0.95


def test_penalty_is_the_sum_of_squared_changes():
    """With a penalty the fitted weights have a smaller loss, penalty included, than any nearby ones; changes of scores are
    those of whole swapped texts."""
    rows = sentences(60, seed=2)
    texts_, y = [t for _, t, _ in rows], np.array([label for _, _, label in rows])
    names = (("women", "men", "elders"),)
    model = toxicity.fit(texts_, y, {0: int((y == 0).sum()), 1: int(y.sum())}, names)
    put = toxicity.mentions(y, names)
    assert [a for (a, _), label in zip(put, y) if label][:4] == ["women", "men", "elders", "women"]
    given = [(f"{t} {a}", f"{t} {b}") for t, (a, b) in zip(texts_, put)]
    pairs = [(t, s) for t in texts_ for s in toxicity.swapped(t, names)] + given
    assert model.pairs == len(pairs)
    vocabulary = toxicity.Vocabulary(model.keys)
    every = texts_ + [a for a, _ in given]
    rows_ = toxicity.text_features(every, vocabulary)
    sides = [toxicity.text_features(side, vocabulary) for side in zip(*pairs)]
    labels = np.concatenate([y, y])

    def loss(w, b):
        z = np.array([w[r].sum() for r in rows_]) + b
        changes = np.array([w[p].sum() - w[q].sum() for p, q in zip(*sides)])
        log_loss = np.logaddexp(0, np.where(labels == 1, -z, z)).mean()
        return log_loss + toxicity.L2 / 2 * (w**2).sum() + toxicity.SWAP_PENALTY / 2 * (changes**2).mean()

    least = loss(model.weights, model.intercept)
    draw = np.random.default_rng(1)
    for size in (1e-2, 1e-1):
        for _ in range(50):
            step = size * draw.normal(size=len(model.weights))
            assert loss(model.weights + step, model.intercept + size * draw.normal()) > least - 1e-4


@pytest.mark.parametrize("train, score, label", [
    (toxicity.train_toxicity, toxicity.score_toxicity, "toxic"),
    (quality.train_quality, quality.score_quality, "quality"),
])
def test_classifiers_take_any_rows(spark, docs, no_docs, train, score, label):
    labels = spark.createDataFrame(
        [(0, 1), (2, 0), (3, 1), (9, 0), (10, 1), (12, 0), (13, 0), (13, 1), (None, 1), (4, None), (4, 0), (77, 1)],
        f"doc_id long, {label} int",
    )
    model = train(docs, labels)
    rows = score(docs, model).collect()
    assert len(rows) == len(texts()) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 14}) == 1
    assert score(no_docs, model).isEmpty()
    bare = train(no_docs, labels.limit(0))
    assert score(docs, bare).count() == len(texts())


def test_quality_tells_junk_from_prose(spark):
    rows = [(i, t, 1) for i, t, _ in sentences(400, seed=5)]
    rows += [(1000 + i, " ".join(w.upper() + "!!" for w in t.split()), 0) for i, t, _ in sentences(400, seed=6)]
    y = np.array([label for _, _, label in rows])
    model = quality.fit([t for _, t, _ in rows], y, {0: 400, 1: 400})
    sizes = model.scorer()
    scores = model.scores(np.array([sizes.difference(t) for _, t, _ in rows]))
    assert ((scores >= 0.5) == (y == 1)).mean() > 0.98
    docs = spark.createDataFrame(rows, "doc_id long, text string, other int")
    good = quality.keep_good(docs, model)
    assert good.columns == docs.columns and good.count() == int((scores >= 0.5).sum())


def vectors():
    random = np.random.default_rng(1)
    rows = [(i, [float(x) for x in random.normal(size=8)]) for i in range(1500)]
    rows += [(2000 + i, rows[40][1]) for i in range(300)]
    rows += [(3000, None), (3001, [0.0] * 8), (3020, [float("nan")] + [1.0] * 7), (3002, [None] + [1.0] * 7)]
    return rows + [(3003, []), (3004, [1.0]), (None, rows[3][1]), rows[7]]


def test_forest_finds_the_nearest(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, class int")
    got = forest.nearest(df, F.col("vec_id") % 20 == 0, least=2500).collect()
    good = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows if i is not None and i < 3000}
    ids = np.array(sorted(good))
    data = np.stack([good[i] for i in ids])
    found = {}
    for r in got:
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hits = 0
    asked = [i for i in ids if i % 20 == 0]
    assert set(found) == set(asked)
    for i in asked:
        scores = (good[i] * data).sum(axis=1)
        scores[ids == i] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        own = [found[i][k] for k in range(1, 21)]
        hits += len(set(best) & {v for v, _ in own})
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))
        assert all(s == pytest.approx(float(good[i] @ good[v]), rel=1e-12) for v, s in own)
    assert hits / (20 * len(asked)) >= 0.9
    few = forest.nearest(df.where("vec_id < 5"), F.col("vec_id") % 20 == 0)
    assert few.count() == 4
    assert forest.nearest(df.limit(0), F.lit(True)).isEmpty()


def test_forest_ranks_all_ties(spark):
    """Binary vectors: many more than k of them tie, and the smallest ids must stay."""
    bits = np.random.default_rng(7).permutation(np.arange(1, 256))
    data = (bits[:, None] >> np.arange(8)) & 1
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "vec_id long, embedding array<float>")
    got = {}
    for r in forest.nearest(df, F.col("vec_id") % 20 == 0, k=5).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    for i in range(0, 255, 20):
        scores = data @ data[i]
        order = [int(j) for j in np.lexsort((np.arange(255), -scores)) if j != i][:5]
        assert [got[i][n] for n in range(1, 6)] == [(j, float(scores[j])) for j in order]
