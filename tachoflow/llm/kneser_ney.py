"""Modified Kneser-Ney trigram model over code points.

A code point below OWN is a symbol of its own, the others share OWN more by hash, so that a
trigram packs into 36 bits. Trigrams begin with two line ends before each text. The counts come
from Spark; a model is one array of its trigrams in ascending order with their log
probabilities, and the same for pairs and single symbols, which answer for trigrams that never
occurred.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from tachoflow.llm.words import U64, mix

OWN = 2048
BITS = 12
ORDER = 3
LINE_END = 10
_M = (1 << BITS) - 1
#: A trace of the next lower law stays, so that nothing is impossible where no discount is.
TRACE = 0.001


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbol of every code point of some UTF-8 texts, and where each text begins (one more at the end)."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int64)
    extra = (lead >= 0xC0).astype(np.int8) + (lead >= 0xE0) + (lead >= 0xF0)
    point = np.where(extra == 0, lead, lead & (0x3F >> extra))
    for k in (1, 2, 3):
        follow = np.flatnonzero(extra >= k)
        if len(follow):
            after = data[np.minimum(at[follow] + k, len(data) - 1)].astype(np.int64)
            point[follow] = point[follow] << 6 | after & 0x3F
    high = point >= OWN
    if high.any():
        point[high] = OWN + (mix(point[high].astype(U64)) & U64(OWN - 1)).astype(np.int64)
    return point, np.searchsorted(at, offsets)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of the trigram that ends at each code point of some texts, and where each text begins."""
    symbol, first = symbols(data, offsets)
    if not len(symbol):
        return symbol, first
    starts = first[:-1][first[:-1] < len(symbol)]
    before = np.concatenate(([LINE_END], symbol[:-1]))
    before[starts] = LINE_END
    earlier = np.concatenate(([LINE_END], before[:-1]))
    earlier[starts] = LINE_END
    return (earlier << 2 * BITS) | (before << BITS) | symbol, first


def discounts(counts: np.ndarray) -> np.ndarray:
    """Discounts for counts of 0, 1, 2 and 3 or more, from the counts of counts."""
    n = np.array([np.count_nonzero(counts == k) for k in range(5)], float)
    out = np.zeros(4)
    if n[1]:
        y = n[1] / (n[1] + 2 * n[2])
        for k in (1, 2, 3):
            out[k] = min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.0), k) if n[k] else out[k - 1]
    return out


class Level(NamedTuple):
    """Grams of one length in ascending order with their probability; contexts with what they leave to the next lower law."""

    grams: np.ndarray
    probability: np.ndarray
    contexts: np.ndarray
    left: np.ndarray


class Model(NamedTuple):
    """Levels of 1, 2 and 3 symbols."""

    levels: tuple[Level, ...]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted key in an ascending array, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _lower(levels: list[Level], gram: np.ndarray, length: int) -> np.ndarray:
    """Probability of grams of this length under the levels up to it."""
    if not length:
        return np.full(len(gram), 1.0 / (2 * OWN))
    level = levels[length - 1]
    at, there = _find(level.grams, gram)
    out = np.zeros(len(gram))
    out[there] = level.probability[at[there]]
    missing = np.flatnonzero(~there)
    if len(missing):
        shorter = _lower(levels, gram[missing] & ((1 << BITS * (length - 1)) - 1), length - 1)
        place, known = _find(level.contexts, gram[missing] >> BITS)
        weight = np.ones(len(missing))
        weight[known] = level.left[place[known]]
        out[missing] = weight * shorter
    return out


def fit(grams: np.ndarray, counts: np.ndarray) -> Model:
    """Model from distinct trigrams in ascending order and how often each occurred."""
    by_length = [(grams, counts.astype(float))]
    for length in (2, 1):
        # How many different symbols come before a shorter gram.
        shorter, n = np.unique(by_length[0][0] & ((1 << BITS * length) - 1), return_counts=True)
        by_length.insert(0, (shorter, n.astype(float)))
    levels: list[Level] = []
    for length, (gram, count) in enumerate(by_length, 1):
        if not len(gram):
            none = np.zeros(0)
            levels.append(Level(gram, none, gram, none))
            continue
        taken = discounts(count)[np.minimum(count, 3).astype(np.int64)]
        contexts, first = np.unique(gram >> BITS, return_index=True)
        own = np.repeat(np.arange(len(contexts)), np.diff(np.append(first, len(gram))))
        total = np.add.reduceat(count, first)
        left = TRACE + (1 - TRACE) * np.add.reduceat(taken, first) / total
        lower = _lower(levels, gram & ((1 << BITS * (length - 1)) - 1), length - 1)
        levels.append(Level(gram, (1 - TRACE) * (count - taken) / total[own] + left[own] * lower, contexts, left))
    return Model(tuple(levels))


#: The model of no text: every symbol is equally likely.
UNIFORM = fit(np.zeros(0, np.int64), np.zeros(0, np.int64))


def log_probabilities(model: Model, codes: np.ndarray) -> np.ndarray:
    """Natural log of p(last | first two) for every trigram."""
    return np.log(_lower(list(model.levels), codes, ORDER))


# Classes of bytes for hashed features; they aren't part of the model above.
SYMBOLS = 64
SPACE_SYMBOL, LINE_SYMBOL = 0, 1


def _classes() -> np.ndarray:
    out = np.full(256, 40, np.uint8)
    out[[9, 11, 12, 13, 32]] = SPACE_SYMBOL
    out[10] = LINE_SYMBOL
    for k in range(26):
        out[65 + k] = out[97 + k] = 2 + k
    out[48:58] = 28
    for symbol, characters in enumerate(".,!?", 29):
        out[ord(characters)] = symbol
    for symbol, characters in enumerate(("\"'`", "-_", "#*$%&|<>", "@", "/\\", "()[]{}", ":;"), 33):
        out[[ord(c) for c in characters]] = symbol
    out[0xC2:0xC4], out[0xC4:0xE0], out[0xE0:0xF0], out[0xF0:] = 41, 42, 43, 44
    out[0x80:0xC0] = 45 + (np.arange(64) & 15)
    return out


CLASSES = _classes()


def gram_codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code of the trigram of byte classes that ends at each byte; two line ends stand before each text."""
    symbol = CLASSES[data].astype(np.int64)
    if not len(symbol):
        return symbol
    starts = offsets[:-1][offsets[:-1] < len(symbol)]
    before = np.concatenate(([LINE_SYMBOL], symbol[:-1]))
    before[starts] = LINE_SYMBOL
    earlier = np.concatenate(([LINE_SYMBOL], before[:-1]))
    earlier[starts] = LINE_SYMBOL
    return (earlier << 12) | (before << 6) | symbol
