"""Byte-level BPE of long texts by a tree: halves are encoded apart and joined by re-encoding what the cut may change."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargetrail.llm.registry import query, read

#: Texts of at most this many characters are encoded at once; the first window reaches so far to either side.
LEAF, WINDOW = 4096, 32

#: Characters whose class (letter, digit, other mark, white space) is the same in all versions of Unicode.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ωА-яぁ-ゖ一-龥"
_DIGIT = "0-9"
_MARK = r"!-&(-/:-@\[-`{-~、。！，？"  # all but the apostrophe
_SPACE = r"\t-\r 　"

#: Places where every text that holds them is cut. The pattern's matches are a contraction ('ll), or an optional space
#: with a run of letters, of digits or of marks, or a run of white space. So no match holds one of these pairs of
#: neighbours, and whether one ends there doesn't depend on anything else. Nor do the matches before the place depend on
#: what follows: the only look ahead is that of white space, and none stands before it.
CUT = re.compile(
    f"(?<=[{_LETTER}])(?=[{_DIGIT}{_MARK}'{_SPACE}])"
    f"|(?<=[{_DIGIT}])(?=[{_LETTER}{_MARK}'{_SPACE}])"
    f"|(?<=[{_MARK}])(?=[{_LETTER}{_DIGIT}{_SPACE}])"
    f"|(?<=')(?=[{_DIGIT}{_SPACE}])"
)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a tiktoken file."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class TreeEncoder:
    """Encodes with the given ranks, each match of `public_tokenizers.PATTERN` separately."""

    def __init__(self, ranks: dict[bytes, int]):
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.token = [b""] * (max(ranks.values(), default=-1) + 1)
        for data, rank in ranks.items():
            self.token[rank] = data

    def encode(self, text: str, leaf: int = LEAF) -> tuple[list[int], bytes]:
        """Ids of a text, and the bytes they decode to."""
        return self._node(text, 0, len(text), leaf)

    def _leaf(self, text: str) -> tuple[list[int], bytes]:
        ids = self.encoding.encode_ordinary(text)
        return ids, self.encoding.decode_bytes(ids)

    def _node(self, text: str, start: int, end: int, leaf: int) -> tuple[list[int], bytes]:
        if end - start <= max(leaf, 1):
            return self._leaf(text[start:end])
        middle = (start + end) // 2
        left, right = self._node(text, start, middle, leaf), self._node(text, middle, end, leaf)
        return self.join(text, start, middle, end, left, right)

    def join(
        self, text: str, start: int, middle: int, end: int, left: tuple[list[int], bytes], right: tuple[list[int], bytes]
    ) -> tuple[list[int], bytes]:
        """The node of `text[start:end]` from those of its two parts.

        The window around `middle` grows on either side until it ends at a `CUT`, or takes in that part as a whole. Tokens
        outside such a window are those of the whole text. It is encoded anew and replaces the parts' tokens there.
        """
        first, reach = None, WINDOW
        while first is None:
            low = max(start, middle - reach)
            # The character before `low` is looked at as well.
            found = [match.start() for match in CUT.finditer(text, max(low - 1, start), middle) if match.start() > start]
            first = found[-1] if found else start if low == start else None
            reach *= 2
        last, reach = None, WINDOW
        while last is None:
            high = min(end, middle + reach)
            match = CUT.search(text, middle + 1, high)
            last = match.start() if match else end if high == end else None
            reach *= 2
        before, after = len(text[first:middle].encode()), len(text[middle:last].encode())
        ids, data = self._leaf(text[first:last])
        kept, dropped = len(left[0]) - self._count(reversed(left[0]), before), self._count(right[0], after)
        return (
            left[0][:kept] + ids + right[0][dropped:],
            left[1][: len(left[1]) - before] + data + right[1][after:],
        )

    def _count(self, ids, size: int) -> int:
        """How many of the `ids` hold the first `size` bytes; they end a token, as the window ends at a cut."""
        count = 0
        for token in ids:
            if size <= 0:
                break
            size -= len(self.token[token])
            count += 1
        if size:
            raise AssertionError("the window ends within a token")
        return count


_ENCODERS: dict[int, TreeEncoder] = {}


def shared_encoder(ranks: dict[bytes, int], key: int) -> TreeEncoder:
    """One encoder per Python worker; `key` tells vocabularies apart."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = TreeEncoder(ranks)
    return _ENCODERS[key]


def tree_encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    id_col: str = "doc_id",
    text_col: str = "text",
    digests: bool = False,
    leaf: int = LEAF,
) -> DataFrame:
    """Per row of `docs`: id, `n_tokens`, and `ids` (array) with `decoded` (binary), or with `digests` the SHA-256 of the
    decimal ids joined by commas as `ids_sha256` and of the decoded bytes as `decoded_sha256`.

    A text longer than `leaf` characters is halved until its parts are not. Neighbours are joined by encoding anew the
    text from the last certain cut of the left one to the first of the right one; tokens outside can't change. Ids are
    decoded in the leaves and the windows, and the bytes put together up the tree. Nothing is shuffled.

    NULL and empty texts have no tokens. A text without certain cuts, such as one very long word, is encoded as a whole in
    the end. Repeated rows give equal results; other columns are ignored; an empty table gives no rows.
    """
    key = hash(frozenset(ranks.items()))
    names = [str(i) for i in range(max(ranks.values(), default=-1) + 1)]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(ranks, key)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch.column(1):
                own, data = encoder.encode(text.as_py() or "", leaf)
                counts.append(len(own))
                if digests:
                    ids.append(hashlib.sha256(",".join([names[i] for i in own]).encode()).hexdigest())
                    decoded.append(hashlib.sha256(data).hexdigest())
                else:
                    ids.append(own)
                    decoded.append(data)
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, kinds[0]), pa.array(decoded, kinds[1])],
                names=["_id", "n_tokens", *columns],
            )

    columns = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
    kinds = (pa.string(), pa.string()) if digests else (pa.list_(pa.int32()), pa.binary())
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    types = ("string", "string") if digests else ("array<int>", "binary")
    schema = f"_id {kind}, n_tokens long, {columns[0]} {types[0]}, {columns[1]} {types[1]}"
    return rows.mapInArrow(encode, schema).withColumnRenamed("_id", id_col)


@query()
def op12_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tree_encode(read(spark, sf_dir, "documents"), ranks, digests=True)
