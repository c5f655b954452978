"""Words of a batch of texts as whole-array operations.

A word is a maximal run of bytes other than space and 0x09-0x0D in the UTF-8 form of a
text; null counts as an empty text. Words are never cut and texts are read to their end.
A batch is worked on in slices of whole texts, so that memory stays bounded by SLICE_BYTES
or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
#: Texts in a slice at most; a hash that is kept beside its text's place loses so many bits.
TEXT_BITS = 10

_BYTES = np.arange(256, dtype=np.uint8)
#: A-Z to a-z, every other byte as it is.
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_BASE = 0x9E3779B97F4A7C15 | 1
_M64 = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers over the whole range (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(max(n, 1), U64)
    out[0] = 1
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * U64(pow(base, done, 1 << 64))
        done += more
    return out


class _Powers:
    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > SLICE_BYTES + 1:
            return _powers(_BASE, n), _powers(_INVERSE, n)
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, SLICE_BYTES + 1), _powers(_INVERSE, SLICE_BYTES + 1)
        return self.up, self.down


_CACHE = _Powers()


class Texts(NamedTuple):
    """UTF-8 bytes of some texts: text i is data[offsets[i]:offsets[i + 1]]; first: its row in the batch."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    @property
    def count(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    """Start and end (exclusive) of every word in data, and the text it belongs to."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of an Arrow column in order, in slices of at most that many bytes (or one text) and 2**TEXT_BITS texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        to = min(to, at + (1 << TEXT_BITS), len(column))
        low, high = int(offsets[at]), int(offsets[to])
        yield Texts(data[low:high], (offsets[at:to + 1] - low), at)
        at = to


def find_words(texts: Texts) -> Words:
    inside = ~SPACE[texts.data]
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none)
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    start = np.flatnonzero(first)
    return Words(start, np.flatnonzero(last) + 1, np.searchsorted(texts.offsets, start, "right") - 1)


def hash_words(data: np.ndarray, words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes; the same everywhere for the same word."""
    up, down = _CACHE.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:len(data)], out=total[1:])
    own = (total[words.end] - total[words.start]) * down[words.start]
    return mix(own ^ mix((words.end - words.start).astype(U64)))


def windows(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of that many words within one text, and the window's text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    out = np.zeros(n, U64)
    for k in range(size):
        out += hashes[k:k + n] * U64(((2 * k + 3) * 0xD6E8FEB86659FD93 | 1) & _M64)
    whole = text[:n] == text[size - 1:]
    return mix(out[whole]), text[:n][whole]


def distinct_per_text(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text, ordered by text; the upper 64 - TEXT_BITS bits of a hash are kept."""
    keys = np.sort((text.astype(U64) << U64(64 - TEXT_BITS)) | (hashes >> U64(TEXT_BITS)))
    if len(keys):
        keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
    return keys & U64((1 << (64 - TEXT_BITS)) - 1), (keys >> U64(64 - TEXT_BITS)).astype(np.int64)
