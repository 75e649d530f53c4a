"""Words of texts as arrays: spans and 64-bit hashes of many texts at once.

A word is a run of bytes other than space and \\t-\\r, which no multi-byte UTF-8 character contains. A word's hash is
the sum of one pseudo-random number per (byte, place in the word), mixed; equal words have equal hashes and different
ones differ but for chance (2^-64).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

WORD = r"[^\x20\x09-\x0D]+"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_PLACES = 64


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers so that every bit depends on all bits (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(count: int, seed: int) -> np.ndarray:
    """`count` fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTES = numbers(256 * _PLACES, 1)


class Words:
    """The words of a list of texts: `starts`, `ends` (byte places in `data`) and `first`, the number of the first
    word of each text, with the total as last item."""

    def __init__(self, texts: list[str | None], lower: bool = False):
        encoded = [b"" if text is None else text.encode("utf-8", "surrogatepass") for text in texts]
        self.data = np.frombuffer(b" ".join(encoded) + b" ", dtype=np.uint8)
        if lower:
            self.data = LOWER[self.data]
        inside = ~IS_SPACE[self.data]
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.inside = inside
        begins = np.cumsum([0, *[len(item) + 1 for item in encoded]])
        self.first = np.searchsorted(self.starts, begins)

    def __len__(self) -> int:
        return len(self.first) - 1

    def span(self, i: int) -> slice:
        return slice(self.first[i], self.first[i + 1])

    def hashes(self) -> np.ndarray:
        """One hash per word."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        lengths = self.ends - self.starts
        heads = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        places = np.arange(lengths.sum(), dtype=np.int32) - np.repeat(heads.astype(np.int32), lengths)
        values = _BYTES[((places & (_PLACES - 1)) << 8) | self.data[self.inside]]
        if lengths.max() > _PLACES:
            rounds = places >> 6
            far = rounds > 0
            values[far] *= mix(rounds[far].astype(np.uint64)) | np.uint64(1)
        return mix(np.add.reduceat(values, heads))

    def text(self, i: int, j: int) -> bytes:
        """Words i to j-1 joined by one space."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.starts[i:j], self.ends[i:j]))


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every `n` neighbouring words, by the place of the first (ends of texts are not heeded)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for k, factor in enumerate(numbers(n, 2) | np.uint64(1)):
        total += hashes[k : k + count] * factor
    return mix(total)


def pieces(texts: Iterable[str | None], most: int = 1 << 20) -> Iterator[list[int]]:
    """Places of `texts`, in groups of about `most` characters, so that arrays stay small. A text is never cut."""
    group, size = [], 0
    for place, text in enumerate(texts):
        group.append(place)
        size += len(text or "") + 1
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group
