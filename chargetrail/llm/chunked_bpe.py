"""BPE encoding and decoding that encodes content-defined chunks once and repairs the joins between them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargetrail.llm.registry import query, read
from chargetrail.llm.tokens import Pieces, shared_pieces
from chargetrail.llm.words import numbers, pieces

#: A chunk ends where the hash of the last `REACH` bytes has these bits 0: on average after 256 bytes.
REACH = 12
MASK = np.uint32(255)
_BYTES = numbers(256, 3).astype(np.uint32)

#: Bounds of what a Python worker remembers: words of each of two generations, some 140 bytes each, and bytes that
#: chunks take. Larger ones save no time on the corpora measured. Characters that are encoded at once come on top.
MOST_WORDS = 100_000
MOST_HELD = 16 << 20
AT_ONCE = 1 << 18

_MARK_AFTER_LETTER = re.compile(rb"(?<=[a-z])(?=[,.](?: |$))")


def plain_form(data: bytes) -> bytes:
    """A text with the same tokens and fewer different words: A-Z in lower case, line ends as spaces, and a space
    between a letter and the comma or full stop that ends a word. The tokenizer does or ignores all of that.

    A text that may name special tokens, which are matched before that, is left as it is.
    """
    if b"<|" in data:
        return data
    return _MARK_AFTER_LETTER.sub(b" ", data.lower().replace(b"\n", b" "))


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Places after which a chunk ends. They depend on the `REACH` bytes before them alone, so a passage is cut alike
    in every document, whatever precedes it; a UTF-8 character is never cut."""
    values = _BYTES[data]
    rolling = values.copy()
    for back in range(1, REACH):
        rolling[back:] = rolling[back:] + values[:-back] * np.uint32(2 * back + 1)
    following = np.append(data[1:], 0)
    return np.flatnonzero(((rolling & MASK) == 0) & ((following & 0xC0) != 0x80)) + 1


class Chunk:
    """A chunk's parts: the words cut off by its edges, and the ids of the words between them.

    A chunk without a space is all `head`, as both joins touch it.
    """

    __slots__ = ("head", "middle", "tail", "ids")

    def __init__(self, data: bytes):
        head, *rest = data.split(b" ")
        self.head = head
        self.tail = rest.pop() if rest else None
        self.middle = rest
        self.ids = b""


class ChunkEncoder:
    """Encodes texts by chunks; a chunk that documents share is encoded once while it is remembered."""

    def __init__(self, words: Pieces):
        self.words = words
        self.chunks: dict[bytes, Chunk] = {}
        self.held = 0

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """Ids (little-endian unsigned 32-bit) and decoded text of each text."""
        encoded = [plain_form((text or "").encode()) for text in texts]
        if self.held > MOST_HELD:
            self.chunks, self.held = {}, 0
        cut, fresh = [], []
        for data in encoded:
            ends = [0, *chunk_ends(np.frombuffer(data, np.uint8)).tolist()] if data else [0]
            if ends[-1] != len(data):
                ends.append(len(data))
            row = []
            for a, b in zip(ends, ends[1:]):
                part = data[a:b]
                chunk = self.chunks.get(part)
                if chunk is None:
                    chunk = self.chunks[part] = Chunk(part)
                    fresh.append(chunk)
                    self.held += 400 + 4 * len(part)
                row.append(chunk)
            cut.append(row)
        # The joins: the word that ends one chunk and begins the next is encoded anew. It reaches from space to space,
        # over several chunks if need be, where the ids on both sides agree with those of the whole text: the
        # pre-tokenizer never lets a token hold or cross a space.
        joins = [_joins(row) for row in cut]
        self.words.learn(set().union(*[chunk.middle for chunk in fresh], *joins))
        ids, decoded = self.words.ids, self.words.decoded
        for chunk in fresh:
            chunk.ids = b"".join([ids[word] for word in chunk.middle])
            chunk.middle = ()
        coded = [
            b"".join(_woven([ids[word] for word in words], [c.ids for c in row if c.tail is not None]))
            for row, words in zip(cut, joins)
        ]
        return [(row, decoded(row)) for row in coded]


def _joins(row: list[Chunk]) -> list[bytes]:
    """The words at the joins of a text's chunks, its first and last word included."""
    out, pending = [], b""
    for chunk in row:
        pending += chunk.head
        if chunk.tail is not None:
            out.append(pending)
            pending = chunk.tail
    out.append(pending)
    return out


def _woven(joins: list[bytes], middles: list[bytes]) -> list[bytes]:
    out = [b""] * (len(joins) + len(middles))
    out[0::2], out[1::2] = joins, middles
    return out


_ENCODERS: dict[str, ChunkEncoder] = {}


def shared_encoder(spec: str) -> ChunkEncoder:
    """One encoder per Python worker, so its tasks share chunks."""
    if spec not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[spec] = ChunkEncoder(shared_pieces(spec, " ", MOST_WORDS))
    return _ENCODERS[spec]


def encode_and_decode(
    docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False
) -> DataFrame:
    """Per row of `docs`: id, `n_tokens`, and `ids` (binary, little-endian unsigned 32-bit) with `decoded`, or with
    `digests` their SHA-256 as `ids_sha256` and `decoded_sha256`.

    `spec` is the JSON of a lower-casing tokenizer that cuts at white space and around punctuation, drops the spaces,
    and has no added tokens but such as begin with `<|`. NULL and empty texts have no tokens. Nothing is shuffled:
    chunks are shared among the documents that a Python worker sees. Repeated rows give equal results; other columns
    are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(spec)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts, ids, decoded = [], [], []
            for group in pieces(texts, AT_ONCE):
                for a, b in encoder.encode([texts[i] for i in group]):
                    counts.append(len(a) // 4)
                    ids.append(hashlib.sha256(a).hexdigest() if digests else a)
                    decoded.append(hashlib.sha256(b).hexdigest() if digests else b.decode())
            kinds = (pa.string(), pa.string()) if digests else (pa.binary(), pa.string())
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, kinds[0]), pa.array(decoded, kinds[1])],
                names=["_id", "n_tokens", *names],
            )

    names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, n_tokens long, {names[0]} {'string' if digests else 'binary'}, {names[1]} string"
    return rows.mapInArrow(encode, schema).withColumnRenamed("_id", id_col)


def tokenizer_spec(name: str) -> str:
    """The JSON of a public tokenizer, read once on the driver and sent with the tasks."""
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


@query()
def op6_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(read(spark, sf_dir, "documents"), tokenizer_spec("word_bpe_49k.json"), digests=True)
