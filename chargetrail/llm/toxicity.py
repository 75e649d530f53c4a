"""Toxicity classifier that does not react to which group a sentence mentions.

A logistic regression on the presence of words and word beginnings. Every training text is also read with a group's name
put into it, under the same label, and names take turns in either class alike. Names that a text has, or has been given, are
swapped for others of their kind, and score changes between the two are penalised. So a name carries no weight of its own,
also one that is only met in new texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargetrail.llm.labels import class_weights, crc_fold, sigmoid, training_sample
from chargetrail.llm.registry import query, read
from chargetrail.llm.words import Words, mix, pieces

FOLDS, HELD_OUT = 5, 0
MOST_PER_CLASS = 3000
MOST_FEATURES = 4096
LEAST_TEXTS = 4
BEGINNINGS = (4, 5, 6, 8)
L2, SWAP_PENALTY, STEPS = 1e-5, 10.0, 800

#: Names of groups; those in one tuple stand for each other in swaps.
IDENTITIES = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("americans", "mexicans", "chinese", "indians", "africans", "europeans"),
    ("disabled", "deaf", "blind", "elderly", "young"),
    ("femmes", "hommes"),
    ("chrétiens", "musulmans", "juifs"),
    ("mujeres", "hombres"),
    ("cristianos", "musulmanes", "judíos"),
    ("frauen", "männer"),
    ("christen", "muslime", "juden"),
)
_MARKS = ".,;:!?\"'()[]"
Names = tuple[tuple[str, ...], ...]


def swapped(text: str, names: Names = IDENTITIES) -> list[str]:
    """The text with its group names replaced, once by the next and once by the previous name of each kind; none if
    the text names no group."""
    words = text.split(" ")
    kinds = _kinds(names)
    found = {}
    for i, word in enumerate(words):
        bare = word.strip(_MARKS + "\n\t")
        if bare.lower() in kinds:
            found[i] = bare
    out = []
    for by in (1, -1) if found else ():
        changed = list(words)
        for i, bare in found.items():
            group, place = kinds[bare.lower()]
            other = group[(place + by) % len(group)]
            changed[i] = words[i].replace(bare, other.capitalize() if bare[0].isupper() else other)
        out.append(" ".join(changed))
    return list(dict.fromkeys(t for t in out if t != text))


@cache
def _kinds(names: Names) -> dict[str, tuple[tuple[str, ...], int]]:
    return {name: (group, i) for group in names for i, name in enumerate(group)}


def mentions(y: np.ndarray, names: Names) -> list[tuple[str, str]]:
    """For each label the name that is put into its text, and the one it is swapped for. Within each class all names take
    turns, so that none is met more often in toxic texts."""
    turns = [(name, group[(i + 1) % len(group)]) for group in names for i, name in enumerate(group)]
    nth = np.zeros(len(y), dtype=int)
    for label in np.unique(y):
        own = y == label
        nth[own] = np.arange(own.sum())
    return [turns[k % len(turns)] for k in nth.tolist()] if turns else []


def feature_keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the features of all words (the word, and its first 4, 5, 6 and 8 bytes), and each key's word."""
    keys, owners = [words.hashes()], [np.arange(len(words.starts))]
    data = np.concatenate([words.data, np.zeros(8, dtype=np.uint8)])
    lengths = words.ends - words.starts
    head = np.zeros(len(words.starts), dtype=np.uint64)
    for k in range(max(BEGINNINGS)):
        head |= data[words.starts + k].astype(np.uint64) << np.uint64(8 * k)
        if k + 1 in BEGINNINGS:
            long = np.flatnonzero(lengths > k)
            keys.append(mix(head[long] + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))))
            owners.append(long)
    return np.concatenate(keys), np.concatenate(owners)


def text_features(texts: list[str | None], only: Vocabulary | None = None) -> list[np.ndarray]:
    """Each text's distinct feature keys, or the distinct places in `only` of those that it has."""
    out: list[np.ndarray] = []
    for group in pieces(texts):
        words = Words([texts[i] for i in group], lower=True)
        keys, owners = feature_keys(words)
        if only is not None:
            keys, hit = only.places(keys)
            owners = owners[hit]
        order = np.argsort(owners, kind="stable")
        keys, cuts = keys[order], np.searchsorted(owners[order], words.first)
        out += [np.unique(keys[a:b]) for a, b in zip(cuts, cuts[1:])]
    return out


class Vocabulary:
    """Sorted feature keys; a small table of key beginnings rejects most others at once."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[keys >> np.uint64(44)] = True

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the `keys` that are in the vocabulary, and which these are."""
        hit = np.flatnonzero(self.maybe[keys >> np.uint64(44)])
        if not len(self.keys):
            return hit[:0], hit[:0]
        at = np.minimum(np.searchsorted(self.keys, keys[hit]), len(self.keys) - 1)
        real = self.keys[at] == keys[hit]
        return at[real], hit[real]


@dataclass
class ToxicityModel:
    keys: np.ndarray
    weights: np.ndarray
    intercept: float
    #: Pairs whose score changes were penalised.
    pairs: int = 0

    def scores(self, texts: list[str | None]) -> np.ndarray:
        rows = text_features(texts, Vocabulary(self.keys))
        return sigmoid(np.array([self.weights[row].sum() for row in rows], dtype=float) + self.intercept)


class _Rows:
    """Sparse rows: places and values, with products in both directions."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], width: int):
        self.at = np.concatenate([np.zeros(0, dtype=np.int64), *[a for a, _ in rows]])
        self.values = np.concatenate([np.zeros(0), *[v for _, v in rows]])
        self.row = np.repeat(np.arange(len(rows)), [len(a) for a, _ in rows])
        self.height, self.width = len(rows), width

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * w[self.at], self.height)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, self.values * r[self.row], self.width)

    def norm(self) -> float:
        """Largest singular value squared, by power steps."""
        w, size = np.ones(self.width), 0.0
        for _ in range(20 if self.height and self.width else 0):
            w = self.back(self.times(w))
            size = float(np.linalg.norm(w))
            if not size:
                break
            w /= size
        return size


def chosen_features(rows: list[np.ndarray], y: np.ndarray, most: int = MOST_FEATURES) -> np.ndarray:
    """The `most` features whose presence differs most between the classes, by chi-square."""
    keys, counts = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *rows]), return_counts=True)
    ones_keys, ones = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *[r for r, t in zip(rows, y) if t]]), return_counts=True)
    a = np.zeros(len(keys))
    a[np.searchsorted(keys, ones_keys)] = ones
    b, n1, n0 = counts - a, max(y.sum(), 1), max((y == 0).sum(), 1)
    expected = counts / (n1 + n0)
    chi = (a / n1 - b / n0) ** 2 / np.maximum(expected * (1 - expected), 1e-12)
    chi[counts < LEAST_TEXTS] = 0
    best = np.argsort(-chi, kind="stable")[:most]
    return np.sort(keys[best[chi[best] > 0]])


def fit(
    texts: list[str],
    y: np.ndarray,
    counts: dict[int, int],
    names: Names = IDENTITIES,
    penalty: float = SWAP_PENALTY,
    most_features: int = MOST_FEATURES,
) -> ToxicityModel:
    """Weights by accelerated gradient steps on: weighted log loss + L2 + `penalty` times squared score changes in swaps.

    `most_features` bounds the features that are chosen for the labels; those of the `names` come on top, and without names
    this is a plain regression. Without texts of both classes the score is the share of label 1, or 0 without any label.
    """
    if not (y == 0).any() or not (y == 1).any():
        share = min(max(counts.get(1, 0) / max(sum(counts.values()), 1), 1e-3), 1 - 1e-3)
        return ToxicityModel(np.zeros(0, dtype=np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    features = text_features(texts)
    pairs = [(i, other) for i, text in enumerate(texts) for other in swapped(text, names)]
    others = text_features([other for _, other in pairs])
    changed = [np.setxor1d(features[i], row, assume_unique=True) for (i, _), row in zip(pairs, others)]
    flat = sorted({name for group in names for name in group})
    keys = np.unique(np.concatenate([chosen_features(features, y, most_features), *changed, *text_features(flat)]))
    del features, others
    vocabulary = Vocabulary(keys)
    places = text_features(texts, vocabulary)
    swapped_places = text_features([other for _, other in pairs], vocabulary)
    compared = [(places[i], row) for (i, _), row in zip(pairs, swapped_places)]
    named = dict(zip(flat, text_features(flat, vocabulary)))
    given = [(np.union1d(row, named[a]), np.union1d(row, named[b])) for row, (a, b) in zip(places, mentions(y, names))]
    compared += given
    rows = places + [row for row, _ in given]
    x = _Rows([(p, np.ones(len(p))) for p in rows], len(keys))
    differences = []
    for one, other in compared:
        gone, new = np.setdiff1d(one, other), np.setdiff1d(other, one)
        differences.append((np.concatenate([gone, new]), np.concatenate([np.ones(len(gone)), -np.ones(len(new))])))
    d = _Rows(differences, len(keys))

    y = np.concatenate([y, y[: len(given)]])
    weights = class_weights(y, counts)
    n, m = len(y), max(d.height, 1)
    rate = 1 / (0.25 * weights.max() * (x.norm() / n + 1) + penalty * d.norm() / m + L2)
    w, b = np.zeros(len(keys)), 0.0
    at, at_b, t = w, b, 1.0
    for _ in range(STEPS):
        r = weights * (sigmoid(x.times(at) + at_b) - y) / n
        new = at - rate * (x.back(r) + L2 * at + penalty * d.back(d.times(at)) / m)
        new_b, next_t = at_b - rate * r.sum(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        at, at_b = new + (t - 1) / next_t * (new - w), new_b + (t - 1) / next_t * (new_b - b)
        w, b, t = new, new_b, next_t
    return ToxicityModel(keys, w, float(b), d.height)


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    most_per_class: int = MOST_PER_CLASS,
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
    names: Names = IDENTITIES,
    penalty: float = SWAP_PENALTY,
    most_features: int = MOST_FEATURES,
) -> ToxicityModel:
    """Fit on at most `most_per_class` labelled documents of each class (whole texts), in one task of that bounded
    size; ids whose CRC fold is `held_out` are never used.

    `names` are the groups' names of the corpus's languages, in lower case, by kind. NULL and empty texts are texts without
    words; ids with a NULL label or with both are not used.
    """
    usable = F.coalesce(crc_fold("doc_id", folds) != held_out, F.lit(False))
    sample, counts = training_sample(docs, labels, "toxic", usable, most_per_class)

    def fit_sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"text": [], "label": []}), *batches])
        rows["text"] = rows["text"].fillna("")
        rows = rows.sort_values(["text", "label"])
        model = fit(rows["text"].tolist(), rows["label"].to_numpy(dtype=int), counts, names, penalty, most_features)
        data = {"keys": model.keys.tobytes(), "weights": model.weights.tobytes()}
        yield pd.DataFrame([{**data, "intercept": model.intercept, "pairs": model.pairs}])

    schema = "keys binary, weights binary, intercept double, pairs long"
    row = sample.repartition(1).mapInPandas(fit_sample, schema).first()
    if row is None:  # no labelled text, so no task
        return fit([], np.zeros(0, dtype=int), counts)
    keys, weights = np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["weights"], float)
    return ToxicityModel(keys, weights, row["intercept"], row["pairs"])


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id and `score`, the probability of label 1 for the whole text.

    NULL and empty texts have no features and get the intercept's score. Rows are scored one by one, so repeats score
    alike; other columns are ignored, and an empty table gives an empty result.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(batch.column(1).to_pylist())
            yield pa.record_batch([batch.column(0), pa.array(scores)], names=["_id", "score"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"_id {kind}, score double").withColumnRenamed("_id", id_col)


@query()
def op2_toxicity_counterfactual(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = score_toxicity(docs, train_toxicity(docs, read(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(crc_fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
