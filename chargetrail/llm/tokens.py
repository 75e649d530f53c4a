"""Token ids of space-free pieces, encoded by the `tokenizers` library once and then looked up."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from itertools import chain

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for every core

from tokenizers import Tokenizer  # noqa: E402

#: Bounds of a worker's memo: entries of each of its two generations, and of what one step may add.
MOST_PIECES = 500_000
MOST_BYTES = 48 << 20
#: Pieces that the library encodes as one line, and lines that it gets at once: a line's result has all its offsets.
LINE, LINES = 64, 128

#: A space that is followed by another space or by anything that some library takes for one, or ends the text.
UNSAFE_SPACE = re.compile("[ ](?:$|[\\s\x00-\x20\x7f-\xa0 ᠎ -‏ -  -⁤　﻿])")


def load(spec: str) -> Tokenizer:
    """The tokenizer of a JSON specification, with truncation and padding off."""
    tokenizer = Tokenizer.from_str(spec)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def id_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.asarray(ids, dtype="<u4").tobytes()


def before_spaces(text: str) -> list[str]:
    """Cut a text before single spaces that a word follows.

    Tokenizers that give a word its leading space always cut there, so the ids of the parts, put together, are those
    of the text. Other spaces stay inside a part.
    """
    if "\0" not in text and not UNSAFE_SPACE.search(text):
        return text.replace(" ", "\0 ").split("\0")
    out = [""]
    for place, part in enumerate(text.split(" ")):
        if place == 0:
            out[0] = part
        elif UNSAFE_SPACE.match(" " + part[:1]):
            out[-1] += " " + part
        else:
            out.append(" " + part)
    return out


class Pieces:
    """Ids of pieces of text, encoded once while they are remembered.

    The memo has two generations of `most` entries: when the newer is full it becomes the older one, and what is used
    again moves back. Results don't depend on it. `joiner` may stand between pieces: the tokenizer cuts before each
    piece then.
    """

    def __init__(self, spec: str, joiner: str = "", most: int = MOST_PIECES):
        self.tokenizer, self.joiner, self.most = load(spec), joiner, most
        self.ids: dict[str | bytes, bytes] = {}
        self.older: dict[str | bytes, bytes] = {}
        self.held = 0
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        #: Which ids begin with a space, in the byte alphabet of byte-level tokenizers.
        self.spaced = np.array([name.startswith("\u0120") for name in names])
        self.names = [name.encode() for name in names]

    def learn(self, pieces: Iterable[str | bytes]) -> None:
        """Afterwards `ids` has all of `pieces`, which are all text or all UTF-8."""
        if len(self.ids) > self.most or self.held > MOST_BYTES:
            self.older, self.ids, self.held = self.ids, {}, 0
        missing = []
        for piece in set(pieces).difference(self.ids):
            if piece in self.older:
                self.ids[piece] = self.older[piece]
            else:
                missing.append(piece)
        self._encode({p.decode() if isinstance(p, bytes) else p: p for p in missing})

    def decoded(self, ids: bytes) -> bytes:
        """What a tokenizer without a decoder of its own makes of ids: their tokens, joined by spaces."""
        return b" ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _encode(self, missing: dict[str, str | bytes]) -> None:
        """Encode pieces in lines of several, and cut the ids where a piece ends; the values are the memo's keys."""
        alone = [[p] for p in missing if not (self.joiner or p.startswith(" ") and " " not in p[1:])]
        rest = [p for p in missing if self.joiner or p.startswith(" ") and " " not in p[1:]]
        lines = alone + [rest[i : i + LINE] for i in range(0, len(rest), LINE)]
        # Offsets are costly; pieces with their only space in front can be told by it.
        encode = self.tokenizer.encode_batch if self.joiner else self.tokenizer.encode_batch_fast
        parts = (lines[i : i + LINES] for i in range(0, len(lines), LINES))
        results = (encode([self.joiner.join(line) for line in part], add_special_tokens=False) for part in parts)
        for line, result in zip(lines, chain.from_iterable(results)):
            ids = np.asarray(result.ids, dtype="<u4")
            if len(line) == 1:
                cuts = [0, len(ids)]
            elif self.joiner:
                piece_ends = np.cumsum([len(piece) + len(self.joiner) for piece in line]) - len(self.joiner)
                token_ends = np.fromiter((end for _, end in result.offsets), np.int64, len(ids))
                cuts = [0, *np.searchsorted(token_ends, piece_ends, side="right").tolist()]
            else:
                cuts = [*np.flatnonzero(self.spaced[ids]).tolist(), len(ids)]
            data = ids.tobytes()
            for piece, a, b in zip(line, cuts, cuts[1:]):
                self.ids[missing[piece]] = data[4 * a : 4 * b]
            self.held += 8 * len(ids) + sum(map(len, line))


_LOADED: dict[tuple[str, str, int], Pieces] = {}


def shared_pieces(spec: str, joiner: str = "", most: int = MOST_PIECES) -> Pieces:
    """One memo per Python worker, so tasks that follow each other share it."""
    key = (spec, joiner, most)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Pieces(spec, joiner, most)
    return _LOADED[key]
