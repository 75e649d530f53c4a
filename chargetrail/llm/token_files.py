"""Token ids in ORC files that are sorted by document and read stripe by stripe."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chargetrail.llm.chunked_bpe import tokenizer_spec
from chargetrail.llm.registry import query, read
from chargetrail.llm.tokens import UNSAFE_SPACE, Pieces, before_spaces
from chargetrail.llm.words import pieces
from chargetrail.session import materialise, work_path

#: ORC encodes integers by runs; a stripe is what one task reads, a row group what its index can skip.
STRIPE_BYTES = 16 << 20
ROWS_PER_INDEX = 1000
END_ID = 0


#: White space and whatever some library may take for it.
_BLANK = "\\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff"
#: A line end that stands beside other white space or ends the text.
_UNSAFE_LINE = re.compile(f"\n(?:(?<=[{_BLANK}]\n)|(?=[{_BLANK}])|$)")
#: Letters that all libraries take for such, and marks that never are part of a contraction.
_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def cut_text(text: str) -> list[str]:
    """Cut a text where byte-level tokenizers surely cut it: before single spaces and around single line ends. The ids of the
    parts, put together, are those of the text."""
    if "\0" in text or UNSAFE_SPACE.search(text):
        return before_spaces(text)
    marked = text.replace(" ", "\0 ")
    if "\n" in text and not _UNSAFE_LINE.search(text):
        marked = marked.replace("\n", "\0\n\0")
    return marked.split("\0")


class WordPieces(Pieces):
    """A memo that gives single words, and the marks that end them, to the tokenizer's model as they are: its pattern
    cuts between a word and a mark, and a run of either is one match."""

    def __init__(self, spec: str):
        super().__init__(spec)
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = (b for b in range(256) if b not in plain)
        #: Byte-level tokenizers write other bytes as characters from U+0100 on.
        self.alphabet = {b: 256 + i for i, b in enumerate(rest)}

    def _encode(self, missing: dict[str, str | bytes]) -> None:
        rest, held, older = {}, self.ids, self.older
        tokenize = self.tokenizer.model.tokenize

        def one(match: str) -> bytes:
            ids = held.get(match) or older.get(match)
            if ids is None:
                if match.isascii():
                    match_name = "\u0120" + match[1:] if match[0] == " " else match
                else:
                    match_name = match.encode().decode("latin-1").translate(self.alphabet)
                ids = held[match] = array("I", [token.id for token in tokenize(match_name)]).tobytes()
                self.held += len(ids) + len(match)
            return ids

        for piece, key in missing.items():
            word = piece if piece[-1:].isalnum() else piece.rstrip(_MARKS)
            body = word[1:] if word[:1] == " " else word
            if body.isalpha() and (body.isascii() or _WORD.fullmatch(body)):
                held[key] = one(word) + one(piece[len(word) :]) if len(word) < len(piece) else one(word)
                self.held += len(piece)
            else:
                rest[piece] = key
        super()._encode(rest)


_LOADED: dict[str, WordPieces] = {}


def shared_words(spec: str) -> WordPieces:
    """One memo per Python worker, so tasks that follow each other share it."""
    if spec not in _LOADED:
        _LOADED.clear()
        _LOADED[spec] = WordPieces(spec)
    return _LOADED[spec]


def encode_documents(
    docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> DataFrame:
    """`(doc_id, ids)` in ascending order of ids, by ranges: each text's token ids and then `end_id`.

    Texts are cut where byte-level tokenizers surely cut as well (`cut_text`), and each distinct piece is encoded once per
    Python worker while it is remembered. The texts are shuffled once, before they are encoded.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = shared_words(spec)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for group in pieces(texts):
                cut = [cut_text(texts[i] or "") for i in group]
                memo.learn({piece for row in cut for piece in row})
                ids = memo.ids
                encoded = [b"".join([ids[piece] for piece in row]) + end for row in cut]
                ends = np.cumsum([0, *[len(row) // 4 for row in encoded]])
                values = pa.array(np.frombuffer(b"".join(encoded), dtype="<i4"))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                own = batch.column(0).slice(group[0], len(group))
                yield pa.record_batch([own, lists], names=["_id", "ids"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    ranged = rows.repartitionByRange("_id").sortWithinPartitions("_id")
    return ranged.mapInArrow(encode, f"_id {kind}, ids array<int>").withColumnRenamed("_id", id_col)


def write_token_files(encoded: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """ORC with run-length encoded ids, a row index and a Bloom filter on the document id. Files are in id order."""
    (
        encoded.write.option("compression", "zstd")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.create.index", True)
        .option("orc.row.index.stride", ROWS_PER_INDEX)
        .option("orc.bloom.filter.columns", id_col)
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str, schema: str = "doc_id long, ids array<int>") -> DataFrame:
    """Scan of the files. Filters on the document id reach the stripes' statistics, row index and Bloom filters."""
    return spark.read.schema(schema).orc(path)


def token_digests(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document of a scan of token files: id, `start` (ids of all documents before it), `n_tokens` and `ids_crc32` of the
    ids as little-endian unsigned 32-bit integers.

    Each part of a file that is read by one task (some stripes) adds up its own documents; parts follow each other in the
    order of the ids, as the files are sorted. One sum per part is sent to all tasks.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = None, 0
        for batch in batches:
            lists, parts = batch.column(1), list(zip(*(batch.column(c).to_pylist() for c in (2, 3))))
            values = lists.values.to_numpy().astype("<u4", copy=False)
            ends = lists.offsets.to_numpy()
            sizes, within = np.diff(ends).astype(np.int64), []
            crcs = [zlib.crc32(values[a:b]) for a, b in zip(ends, ends[1:])]
            for own, size in zip(parts, sizes.tolist()):
                if own != part:
                    part, before = own, 0
                within.append(before)
                before += size
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes), pa.array(crcs, pa.int64()), pa.array(within, pa.int64()), *batch.columns[2:]],
                names=["_id", "n_tokens", "ids_crc32", "within", "file", "block"],
            )

    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    rows = files.select(F.col(id_col).alias("_id"), "ids", *where)
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, n_tokens long, ids_crc32 long, within long, file string, block long"
    counted = materialise(rows.mapInArrow(digest, schema), "counted")
    order = Window.orderBy(F.col("first").asc_nulls_first(), "last", "file", "block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    # A row per part: a few thousand for every TB of tokens. A part with NULL ids, which come first, has them at its head.
    some_null = F.max(F.col("_id").isNull())
    parts = counted.groupBy("file", "block").agg(
        F.sum("n_tokens").alias("tokens"), F.when(~some_null, F.min("_id")).alias("first"), F.max("_id").alias("last")
    )
    parts = parts.select("file", "block", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"))
    return counted.join(F.broadcast(parts), ["file", "block"]).select(
        F.col("_id").alias(id_col), (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokenise_to_orc(docs: DataFrame, spec: str, path: str) -> DataFrame:
    """Encode `docs`, write the files below `path`, and return per document what they hold: `doc_id`, `start`,
    `n_tokens` and `ids_crc32`.

    NULL and empty texts hold the end id alone. A NULL id comes first; rows that repeat an id are each written and
    returned. Other columns are ignored, and an empty table gives no rows.
    """
    write_token_files(encode_documents(docs, spec), path)
    return token_digests(read_token_files(docs.sparkSession, path))


@query()
def op5_orc_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "tokens")
    return tokenise_to_orc(read(spark, sf_dir, "documents"), tokenizer_spec("byte_bpe_50k.json"), path)
