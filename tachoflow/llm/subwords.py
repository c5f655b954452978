"""Hashed subwords of a batch of texts as whole-array operations.

A word is a run of letters, digits and bytes above 127, in lower case (A-Z and the accented
capitals of Latin-1). Its subwords are the word itself, its runs of SIZES code points, and its
first and last EDGES code points marked as such. Each is hashed to one of 2 ** BITS buckets. A
run of more than LONGEST bytes counts as several words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tachoflow.llm.words import LOWER, U64, Texts, Words, find_words, hash_words, mix

BITS = 17
SIZES = (3, 4, 5)
EDGES = (2, 3, 4)
LONGEST = 1 << 16
#: Bytes of words whose subwords are made at a time.
BLOCK_BYTES = 1 << 18

_BYTES = np.arange(256)
_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_MASKED = np.where(_WORD, LOWER[_BYTES], 32).astype(np.uint8)
_FIRST, _LAST, _WHOLE = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)


def lowered(data: np.ndarray) -> np.ndarray:
    """Words in lower case, every other byte a space."""
    out = _MASKED[data]
    capital = np.zeros(len(out), bool)
    if len(out) > 1:
        # Latin-1 capitals are 0xC3 and 0x80-0x9E without the multiplication sign.
        capital[1:] = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
    out[capital] += 32
    return out


def _weights(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Weight of every word: all occurrences of a word in a text together weigh the root of their number."""
    order = np.lexsort((hashes, words.text))
    text, ranked = words.text[order], hashes[order]
    new = np.concatenate(([True], (text[1:] != text[:-1]) | (ranked[1:] != ranked[:-1])))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(order)))
    out = np.empty(len(order))
    out[order] = np.repeat(1 / np.sqrt(count), count)
    return out


def _cut(words: Words) -> Words:
    """Words of at most LONGEST bytes; a longer one counts as several."""
    size = words.end - words.start
    if not len(size) or size.max() <= LONGEST:
        return words
    pieces = (size + LONGEST - 1) // LONGEST
    place = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = np.repeat(words.start, pieces) + place * LONGEST
    return Words(start, np.minimum(start + LONGEST, np.repeat(words.end, pieces)), np.repeat(words.text, pieces))


def _block(data: np.ndarray, words: Words, whole: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every subword of some words, and the word it is from."""
    at = np.flatnonzero((data != 32) & ((data & 0xC0) != 0x80))
    word = np.searchsorted(words.start, at, "right") - 1
    # A word that begins inside a code point (a broken text) counts from its first lead byte.
    keep = word >= 0
    at, word = at[keep], word[keep]
    last = np.ones(len(at), bool)
    last[:-1] = word[1:] != word[:-1]
    end = words.end[word].copy()
    end[:-1][~last[:-1]] = at[1:][~last[:-1]]
    first = np.ones(len(at), bool)
    first[1:] = last[:-1]
    hashes, owners = [mix(whole ^ _WHOLE)], [np.arange(len(whole))]
    for size in sorted({*SIZES, *EDGES}):
        n = len(at) - size + 1
        if n <= 0:
            continue
        inside = word[:n] == word[size - 1:]
        own = word[:n][inside]
        gram = hash_words(data, Words(at[:n][inside], end[size - 1:][inside], own))
        if size in SIZES:
            hashes.append(gram)
            owners.append(own)
        if size in EDGES:
            for edge, mark in ((first[:n][inside], _FIRST), (last[size - 1:][inside], _LAST)):
                hashes.append(mix(gram[edge] ^ mark))
                owners.append(own[edge])
    return (np.concatenate(hashes) >> U64(64 - bits)).astype(np.int64), np.concatenate(owners)


def subword_blocks(texts: Texts, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bucket of every subword, its weight (that of its word), and the text it is from, some words at a time."""
    data = lowered(texts.data)
    words = _cut(find_words(texts._replace(data=data)))
    if not len(words.start):
        return
    whole = hash_words(data, words)
    weight = _weights(words, whole)
    # Blocks end with the word that fills them, so that their arrays stay bounded whatever a text holds.
    filled = np.cumsum(words.end - words.start) // BLOCK_BYTES
    borders = np.concatenate(([0], np.flatnonzero(np.diff(filled)) + 1, [len(whole)]))
    for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
        low, high = words.start[a], words.end[b - 1]
        part = Words(words.start[a:b] - low, words.end[a:b] - low, words.text[a:b])
        bucket, owner = _block(data[low:high], part, whole[a:b], bits)
        yield bucket, weight[a:b][owner], part.text[owner]


def subwords(texts: Texts, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All blocks of ``subword_blocks`` in one."""
    none = np.zeros(0, np.int64)
    blocks = [*subword_blocks(texts, bits), (none, np.zeros(0), none)]
    return tuple(np.concatenate(x) for x in zip(*blocks, strict=True))


def _added(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key, place = np.unique(key, return_inverse=True)
    return key, np.bincount(place, weight, len(key))


def bags(texts: Texts, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct buckets of each text and their summed weight: (text, bucket, weight), by text."""
    key, weight = np.zeros(0, np.int64), np.zeros(0)
    for bucket, own, owner in subword_blocks(texts, bits):
        more, extra = _added((owner << bits) | bucket, own)
        key, weight = _added(np.concatenate((key, more)), np.concatenate((weight, extra)))
    return key >> bits, key & ((1 << bits) - 1), weight
