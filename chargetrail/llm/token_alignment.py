"""Alignment of two tokenisations of the same text by skipping along diagonals."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargetrail.llm.chunked_bpe import tokenizer_spec
from chargetrail.llm.registry import query, read
from chargetrail.llm.tokens import load
from chargetrail.llm.tree_bpe import read_ranks
from chargetrail.llm.words import pieces
from chargetrail.session import materialise

_SPACE_MARK = "▁"
_BYTE = re.compile("<0x([0-9A-F]{2})>")

#: Characters that all versions of Unicode class alike, so that both libraries split such texts at the same places.
_PLAIN = re.compile("[\t-\r -~¡-¬®-ɏΑ-ΡΣ-ωА-яぁ-ゖ一-龥‐-‧、。！，？]*")


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level tokenizers: printable ones for themselves, the others from
    U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Vocabularies:
    """Both tokenizers (A byte-level, B of pieces), the bytes of their tokens, and all id pairs that can be linked.

    Linked tokens end at one byte, so the shorter one's bytes end the longer one's: there are no more pairs than tokens
    have suffixes. `pairs` holds them as sorted numbers (A's id * 2^32 + B's id).
    """

    def __init__(self, spec: str, ranks: dict[bytes, int] | None, model: bytes):
        self.tokenizer = load(spec)
        self.tokenizer.encode_special_tokens = True
        self.fast = ranks and tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        alphabet = byte_alphabet()
        special = {token.content for token in self.tokenizer.get_added_tokens_decoder().values()}
        self.a = []
        for i in range(self.tokenizer.get_vocab_size()):
            name = self.tokenizer.id_to_token(i) or ""
            self.a.append(name.encode() if name in special else bytes(alphabet[c] for c in name))
        self.b = []
        for i in range(self.pieces.get_piece_size()):
            name = self.pieces.id_to_piece(i)
            byte = _BYTE.fullmatch(name) if self.pieces.is_byte(i) else None
            self.b.append(bytes([int(byte[1], 16)]) if byte else name.replace(_SPACE_MARK, " ").encode())
        self.a_sizes = np.array([len(data) for data in self.a], dtype=np.int64)
        self.b_sizes = np.array([len(data) for data in self.b], dtype=np.int64)
        self.pairs = self._pairs()
        # A token's decimal id with what follows it: another token of its side, the other side, or the next group.
        self.texts = [f"{i}{end}" for i in range(len(self.a)) for end in ",|"]
        self.texts += [f"{i}{end}" for i in range(len(self.b)) for end in ",;"]

    def _pairs(self) -> np.ndarray:
        by_bytes: tuple[dict, dict] = ({}, {})
        for held, side in zip(by_bytes, (self.a, self.b)):
            for i, data in enumerate(side):
                held.setdefault(data, []).append(i)
        found = []
        for longer, shorter, turned in ((0, 1, False), (1, 0, True)):
            for data, ids in by_bytes[longer].items():
                for at in range(int(turned), len(data)):  # equal ones are found the first time
                    for other in by_bytes[shorter].get(data[at:], ()):
                        found += [(other << 32) | i if turned else (i << 32) | other for i in ids]
        return np.unique(np.array(found, dtype=np.int64))

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of all texts. Where both libraries surely split alike, the one that is faster with the same ranks."""
        out: list = [None] * len(texts)
        slow = []
        for i, text in enumerate(texts):
            if self.fast and _PLAIN.fullmatch(text):
                out[i] = self.fast.encode_ordinary(text)
            else:
                slow.append(i)
        for i, result in zip(slow, self.tokenizer.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False)):
            out[i] = result.ids
        return out


def aligned(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Group ends, as numbers of tokens before them on either side, from the ascending end places of two tokenisations
    that have the same last one.

    The tokens after a common end are walked to the next one; they are one group, and set the shift between the sides.
    At that shift the end arrays agree while tokens go one to one: probes of doubled length jump over them until one
    fails, halves of it follow, and the last few tokens are compared singly.
    """
    i = j = 0
    heads_a: list[int] = []
    heads_b: list[int] = []
    lengths: list[int] = []
    count = len(a)
    while i < count:
        while (x := a[i]) != (y := b[j]):
            if x < y:
                i += 1
            else:
                j += 1
        i += 1
        j += 1
        heads_a.append(i)
        heads_b.append(j)
        step, first = 4, i
        while i < count and a[i : i + step] == b[j : j + step]:  # at the end both slices are cut alike
            i += step
            j += step
            step *= 2
        if i < count:
            while step > 4:
                step //= 2
                if a[i : i + step] == b[j : j + step]:
                    i += step
                    j += step
            while i < count and a[i] == b[j]:
                i += 1
                j += 1
        else:
            i = count
        lengths.append(i - first + 1)
    within = np.arange(sum(lengths)) - np.repeat(np.cumsum([0, *lengths[:-1]]), lengths)
    return np.repeat(heads_a, lengths) + within, np.repeat(heads_b, lengths) + within


def _groups_text(v: Vocabularies, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> str:
    """`a1,a2|b1;a3|b2,b3`: a token stands behind those of its side and the other side's of earlier groups (for B: and
    of its own)."""
    group_a = np.repeat(np.arange(len(ends_a)), np.diff(ends_a, prepend=0))
    group_b = np.repeat(np.arange(len(ends_b)), np.diff(ends_b, prepend=0))
    last_a, last_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
    last_a[ends_a - 1] = 1
    last_b[ends_b - 1] = 1
    texts = np.empty(len(a) + len(b), dtype=np.int64)
    texts[np.arange(len(a)) + np.concatenate(([0], ends_b))[group_a]] = 2 * a + last_a
    texts[np.arange(len(b)) + ends_a[group_b]] = 2 * (b + len(v.a)) + last_b
    names = v.texts
    return "".join([names[i] for i in texts.tolist()])[:-1]


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(np.diff(values, prepend=0).astype("<i4").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(data), "<i4"), dtype=np.int64)


_LOADED: dict[int, Vocabularies] = {}


def shared_vocabularies(spec: str, ranks: dict[bytes, int] | None, model: bytes, key: int) -> Vocabularies:
    """One pair of tokenizers per Python worker."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabularies(spec, ranks, model)
    return _LOADED[key]


def align_tokens(
    docs: DataFrame,
    spec: str,
    model: bytes,
    ranks: dict[bytes, int] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    groups: bool = False,
) -> DataFrame:
    """Per row of `docs`: id, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum` and `groups_sha256`, or with
    `groups` the text `a1,a2|b1;a3|b2,b3` itself.

    A is the byte-level tokenizer of the JSON `spec` on a space and the text, B the SentencePiece `model` on the text.
    Places where tokens of both end cut them into groups; the last tokens of a group are linked. An id pair's count is how
    many links of all documents have it; `n_best` counts the links whose pair no other A id of their B id outnumbers.
    `ranks` may give A's vocabulary for the faster library.

    Each document is encoded and aligned once; its groups' digest and its links, as pair numbers and counts, are written.
    Every task adds up its links' counts before they are shuffled. The pairs' counts are sent to all tasks for the
    second step: no token pair is linked unless one's bytes end the other's, so their number is bounded by the
    vocabularies (some 400,000 for 50,257 and 32,000 tokens), whatever the corpus.

    Texts that are NULL or empty, or that a tokenizer changes (its bytes differ from space and text), have no tokens:
    zeros and the empty text. Rows that repeat an id each count; other columns are ignored; an empty table gives no rows.
    """
    key = hash((spec, model))
    sizes = Vocabularies(spec, None, model)
    pairs = sizes.pairs
    if min(sizes.a_sizes.min(), sizes.b_sizes.min()) < 1:
        raise ValueError("tokens without bytes have no place in an alignment")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared_vocabularies(spec, ranks, model, key)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for group in pieces(texts):
                rows = []
                own = [i for i in group if texts[i]]
                encoded = dict(zip(own, zip(v.encode_a([" " + texts[i] for i in own]), v.pieces.encode([texts[i] for i in own], num_threads=1))))
                for i in group:
                    rows.append(one(v, texts[i], *encoded.get(i, ((), ()))))
                columns = list(zip(*rows))
                yield pa.record_batch(
                    [
                        batch.column(0).slice(group[0], len(group)),
                        *[pa.array(values, pa.int64()) for values in columns[:3]],
                        pa.array(columns[3], pa.string()),
                        *[pa.array(values, pa.binary()) for values in columns[4:]],
                    ],
                    names=["_id", "n_a", "n_b", "n_groups", result, "pairs", "counts"],
                )

    def one(v: Vocabularies, text: str | None, a: list[int], b: list[int]) -> tuple:
        whole = b" " + (text or "").encode()
        token_a, token_b = v.a, v.b
        if not a or b"".join([token_b[i] for i in b]) != whole or b"".join([token_a[i] for i in a]) != whole:
            return 0, 0, 0, "", _packed(np.zeros(0, np.int64)), _packed(np.zeros(0, np.int64))
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        ends_a, ends_b = aligned(np.cumsum(v.a_sizes[a]).tolist(), np.cumsum(v.b_sizes[b]).tolist())
        found, counts = np.unique((a[ends_a - 1] << 32) | b[ends_b - 1], return_counts=True)
        text = _groups_text(v, a, b, ends_a, ends_b)
        if not groups:
            text = hashlib.sha256(text.encode()).hexdigest()
        return len(a), len(b), len(ends_a), text, _packed(np.searchsorted(v.pairs, found)), _packed(counts)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(pairs), dtype=np.int64)
        for batch in batches:
            for found, counts in zip(*(column.to_pylist() for column in batch.columns)):
                total[_unpacked(found)] += _unpacked(counts)  # a row has each pair once
        present = np.flatnonzero(total)
        yield pa.record_batch([pa.array(present), pa.array(total[present])], names=["pair", "links"])

    result = "groups" if groups else "groups_sha256"
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, n_a long, n_b long, n_groups long, {result} string, pairs binary, counts binary"
    linked = materialise(rows.mapInArrow(align, schema), "aligned")
    counted = linked.select("pairs", "counts").mapInArrow(add_up, "pair long, links long")
    counted = counted.groupBy("pair").agg(F.sum("links").alias("links")).toArrow()  # no more rows than `pairs`
    totals = np.zeros(len(pairs), dtype=np.int64)
    totals[counted.column("pair").to_numpy()] = counted.column("links").to_numpy()
    b_ids = pairs & 0xFFFFFFFF
    most = np.zeros(len(sizes.b), dtype=np.int64)
    np.maximum.at(most, b_ids, totals)
    # Two arrays of one number and one flag per possible pair.
    sent = docs.sparkSession.sparkContext.broadcast((totals, totals == most[b_ids]))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, best = sent.value
        for batch in batches:
            n_best, count_sum = [], []
            for found, counts in zip(batch.column("pairs").to_pylist(), batch.column("counts").to_pylist()):
                found, counts = _unpacked(found), _unpacked(counts)
                n_best.append(int(counts[best[found]].sum()))
                count_sum.append(int((counts * totals[found]).sum()))
            columns = [batch.column(c) for c in ("_id", "n_a", "n_b", "n_groups", "n_groups")]
            yield pa.record_batch(
                [*columns, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), batch.column(result)],
                names=["_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", result],
            )

    schema = f"_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, {result} string"
    return linked.mapInArrow(look_up, schema).withColumnRenamed("_id", id_col)


@query()
def op13_diagonal_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return align_tokens(read(spark, sf_dir, "documents"), tokenizer_spec("byte_bpe_50k.json"), model, ranks)
