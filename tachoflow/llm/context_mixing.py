"""Bits, hashed contexts and the logistic mixer of the language model.

A text is its lower-cased words and one end. Every token is written as bits: the VOCABULARY
commonest words and the end have Huffman codes by their counts, any other word is an escape
and its bytes, each by a Huffman code over bytes, up to a closing space. So the bits of a text
can be read back, and the sum of their log probabilities is the log probability of the text.

INPUTS predictors guess each bit, each from the counts of zeros and ones in a hashed slot of
(code node, context): for words no context, the last word, and the last word among the COMMON
commonest; for bytes that word with two bytes before, four bytes before, and the word so far.
Counting spreads words after one word, words by topic and letters by the bytes before them to
bits once for all that are alike, with their number (Tally).
Their log odds are combined by weights that a gate picks (kind of bit, its place, longest
context that was met). The weights start from those most likely for the bits of all training
texts, which are counted by gate and rounded inputs, and are refined on every text as it is
read, CHUNK tokens at a time: a chunk is guessed with what was learned before it, then learned
from.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property
from typing import NamedTuple

import numpy as np

from tachoflow.llm.words import LOWER, U64, Texts, find_words, hash_words, mix

INPUTS = 3
SLOT_BITS = 21
SLOTS = 1 << SLOT_BITS
COMMON = 64
CHUNK = 64
GATES = 16
BIAS = np.float32(0.3)
END, ESCAPE, FIRST_WORD = 0, 1, 2
CLOSE = 32
PRIOR = 0.4
RATE = 0.002
#: Steps of log odds in one unit, for scoring.
FINE = 1000
#: Log odds are rounded to multiples of STEP, at most STEPS of them, to count bits by their inputs.
STEP = 0.5
STEPS = 14
WIDTH = 2 * STEPS + 1
FLAG = 32
CELLS = 2 * GATES * WIDTH ** INPUTS
#: Weight of the law around the plain weights, in bits of curvature one.
PULL = 1.0
#: Gate of a word's bit by its place in the code, and of a letter's bits by its place in the word.
_WORD_GATE = np.searchsorted([1, 4, 8], np.arange(64), "right").astype(np.int8)
_LETTER_GATE = (4 + np.searchsorted([1, 3, 6], np.arange(8), "right")).astype(np.int8)
#: First bits of a word's hash by which it is looked up.
RANGE_BITS = 18
#: Words or letters that are held before those alike are counted.
HELD = 1 << 21
#: Symbols that are spread to bits at once while counting.
PIECE = 1 << 16
_START, _END_VALUE = U64(0x243F6A8885A308D3), U64(0x13198A2E03707344)


class Code(NamedTuple):
    """Huffman codes: symbol s has the bits and tree nodes [offset[s], offset[s + 1]).

    spread: each node as it enters the hash of a slot; step: its place in the code, 63 at most.
    """

    offset: np.ndarray
    bit: np.ndarray
    node: np.ndarray
    spread: np.ndarray
    step: np.ndarray


def huffman(counts: list[int]) -> Code:
    """Codes for symbols with these counts (0 counts as 1); ties go by symbol."""
    n = len(counts)
    heap = [(max(c, 1), k) for k, c in enumerate(counts)]
    heapq.heapify(heap)
    parent, side = [0] * (2 * n), [0] * (2 * n)
    made = n
    while len(heap) > 1:
        one, two = heapq.heappop(heap), heapq.heappop(heap)
        parent[one[1]], parent[two[1]] = made, made
        side[two[1]] = 1
        heapq.heappush(heap, (one[0] + two[0], made))
        made += 1
    offset, bits, nodes = [0], [], []
    for symbol in range(n):
        path = []
        at = symbol
        while at != made - 1:
            path.append((side[at], parent[at] - n))
            at = parent[at]
        bits += [b for b, _ in reversed(path)]
        nodes += [x for _, x in reversed(path)]
        offset.append(len(bits))
    begin, node = np.array(offset), np.array(nodes, np.int32)
    step = np.arange(len(node)) - np.repeat(begin[:-1], np.diff(begin))
    return Code(begin, np.array(bits, np.int8), node, node.astype(U64) * U64(0x9E3779B97F4A7C15), np.minimum(step, 63).astype(np.int8))


class _Lexicon(NamedTuple):
    hashes: np.ndarray
    rank: np.ndarray
    counts: np.ndarray
    words: Code
    bytes: Code


class Lexicon(_Lexicon):
    """Hashes of the commonest words, ascending, their rank (0: commonest) and count, and both codes."""

    @cached_property
    def _ranges(self) -> tuple[np.ndarray, int]:
        """Where the hashes with each first RANGE_BITS bits begin, and the most that share them."""
        size = np.bincount((self.hashes >> U64(64 - RANGE_BITS)).view(np.int64), minlength=1 << RANGE_BITS)
        return np.concatenate(([0], np.cumsum(size)[:-1])), int(size.max())

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word among the commonest ones, -1 if it isn't one."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        begin, most = self._ranges
        at = np.take(begin, (hashes >> U64(64 - RANGE_BITS)).view(np.int64), mode="clip")
        for _ in range(most):
            at += np.take(self.hashes, at, mode="clip") < hashes
        at[np.take(self.hashes, at, mode="clip") != hashes] = -1
        return at

    @cached_property
    def values(self) -> np.ndarray:
        """The hash of each symbol as the word before another; END stands for the start of a text."""
        out = np.full(len(self.hashes) + FIRST_WORD, _START)
        out[self.rank + FIRST_WORD] = self.hashes
        return out

    @cached_property
    def plain(self) -> np.ndarray:
        """Slot of each node of the word code without a context."""
        return _place(self.words.spread, None, None, 0)

    @cached_property
    def marks(self) -> np.ndarray:
        """Gate and bit of each node of the word code."""
        return (_WORD_GATE[self.words.step] * 2 + self.words.bit).astype(np.int8)


def lexicon(hashes: np.ndarray, counts: np.ndarray, texts: int, others: int, byte_counts: list[int]) -> Lexicon:
    """From the commonest words in falling order, the numbers of training texts and of other words."""
    order = np.argsort(hashes)
    words = huffman([texts, others, *counts.tolist()])
    return Lexicon(hashes[order], order, counts[order], words, huffman(byte_counts))


class Tokens(NamedTuple):
    symbol: np.ndarray
    value: np.ndarray
    text: np.ndarray
    place: np.ndarray
    start: np.ndarray
    end: np.ndarray


def tokenise(texts: Texts, lexicon_: Lexicon | None) -> tuple[Texts, Tokens]:
    """Lower-cased texts and their tokens: words in order, then an end, for each text."""
    texts = texts._replace(data=LOWER[texts.data])
    words = find_words(texts)
    hashes = hash_words(texts.data, words)
    count = texts.count
    per_text = np.bincount(words.text, minlength=count)
    total = len(hashes) + count
    at_word = np.arange(len(hashes)) + words.text
    at_end = np.cumsum(per_text + 1) - 1
    symbol, text = np.full(total, END), np.zeros(total, np.int64)
    value, start, end = np.full(total, _END_VALUE), np.zeros(total, np.int64), np.zeros(total, np.int64)
    text[at_word], text[at_end] = words.text, np.arange(count)
    value[at_word], start[at_word], end[at_word] = hashes, words.start, words.end
    if lexicon_ is not None:
        place = lexicon_.place(hashes)
        symbol[at_word] = np.where(place >= 0, lexicon_.rank[place] + FIRST_WORD, ESCAPE)
    first = np.concatenate(([0], at_end[:-1] + 1))
    return texts, Tokens(symbol, value, text, np.arange(total) - first[text], start, end)


class Group(NamedTuple):
    """Bits of some symbols of one code; slot has an array per input, each within its own table.

    owner: the token of each symbol; size: how many bits it has. Where the first input has no
    context, its slots are ``plain`` at the places in the first array of slot.
    """

    bit: np.ndarray
    gate: np.ndarray
    slot: list[np.ndarray]
    owner: np.ndarray
    size: np.ndarray
    plain: np.ndarray | None = None

    def taken(self, table: np.ndarray, first: Callable[[np.ndarray], np.ndarray]) -> list[np.ndarray]:
        """What a table of all slots holds for each bit, an array per input; first: the same for all of ``plain``."""
        found = [np.take(table[k * SLOTS:(k + 1) * SLOTS], slot, mode="clip") for k, slot in enumerate(self.slot) if k or self.plain is None]
        return found if self.plain is None else [np.take(first(self.plain), self.slot[0], mode="clip"), *found]


class Bits(NamedTuple):
    """Bits of some texts: those of words and those of spelled bytes, and the text and place of each token."""

    words: Group
    letters: Group
    text: np.ndarray
    place: np.ndarray

    @property
    def bit(self) -> np.ndarray:
        return np.concatenate([self.words.bit, self.letters.bit])


def _spread(offset: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code size of each symbol, and for each code bit its place in the code table."""
    begin = offset[symbol]
    size = offset[symbol + 1] - begin
    entry = np.repeat(begin - (np.cumsum(size) - size), size)
    entry += np.arange(len(entry))
    return size, entry


def _place(spread: np.ndarray, context: np.ndarray | None, size: np.ndarray | None, salt: int) -> np.ndarray:
    """Place in its table of each (node, context of its owner); contexts are spread first, so one product spreads the sum."""
    if context is None:
        sum_ = spread + mix(np.array([salt << 32], U64))
    else:
        sum_ = np.repeat(mix(context + U64(salt << 32)), size)
        sum_ += spread
    sum_ *= U64(0xD6E8FEB86659FD93)
    sum_ >>= U64(64 - SLOT_BITS)
    return sum_.view(np.int64)


def _slot(spread: np.ndarray, context: np.ndarray | None, size: np.ndarray, salt: int) -> np.ndarray:
    """Slot of each (node, context of its owner) in the tables of all inputs."""
    return _place(spread, context, size, salt) + (salt & 7) * SLOTS


def _before(value: np.ndarray, place: np.ndarray, steps: int, start=_START) -> np.ndarray:
    out = np.full(len(value), start)
    out[steps:] = value[:-steps] if steps else value
    out[place < steps] = start
    return out


def _topic(tokens: Tokens) -> np.ndarray:
    """The symbol of the latest of the commonest words before each token, within the text; 0 if there is none."""
    n = len(tokens.symbol)
    at = np.flatnonzero((tokens.symbol >= FIRST_WORD) & (tokens.symbol < FIRST_WORD + COMMON))
    latest = np.full(n, -1)
    latest[at[at < n - 1] + 1] = at[at < n - 1]
    latest = np.maximum.accumulate(latest)
    known = (latest >= 0) & (latest >= np.arange(n) - tokens.place)
    topic = tokens.symbol[latest]
    topic[~known] = 0
    return topic


class Letters(NamedTuple):
    """Bytes of the spelled words and a closing space each.

    which: its word among the spelled ones; place: its place in the word; two, four: the bytes
    before it as one number; prefix: a hash of all bytes before it.
    """

    symbol: np.ndarray
    which: np.ndarray
    place: np.ndarray
    two: np.ndarray
    four: np.ndarray
    prefix: np.ndarray


def _letters(texts: Texts, tokens: Tokens, spelled: np.ndarray) -> Letters:
    size = tokens.end[spelled] - tokens.start[spelled] + 1
    begin = np.cumsum(size) - size
    which = np.repeat(np.arange(len(spelled)), size)
    place = np.arange(len(which))
    at = place + np.repeat(tokens.start[spelled] - begin, size)
    place -= np.repeat(begin, size)
    symbol = (np.take(texts.data, at, mode="clip") if len(texts.data) else np.zeros(len(at), np.uint8)).astype(np.int64)
    symbol[begin + size - 1] = CLOSE
    value = symbol.view(U64) + U64(1)
    one = np.zeros(len(value), U64)
    one[1:] = value[:-1]
    one[begin] = 0
    # Each number of bytes before a letter follows from that of the letter before it.
    two, three, four = one * U64(257), one * U64(257 ** 2), one * U64(257 ** 3)
    two[1:] += one[:-1]
    two[begin] = 0
    three[1:] += two[:-1]
    three[begin] = 0
    four[1:] += three[:-1]
    four[begin] = 0
    # All letters of the word so far: a running sum of their mixed values and places.
    running = np.zeros(len(value) + 1, U64)
    np.cumsum(mix(value * U64(1000) + place.view(U64)), out=running[1:])
    prefix = running[:-1] - np.repeat(running[begin], size)
    return Letters(symbol, which, place, two, four, prefix)


def bits_of(texts: Texts, tokens: Tokens, lexicon_: Lexicon) -> Bits:
    topic = _topic(tokens).view(U64)
    sizes, entry = _spread(lexicon_.words.offset, tokens.symbol)
    node = np.take(lexicon_.words.spread, entry, mode="clip")
    slots = [entry, _place(node, _before(tokens.value, tokens.place, 1), sizes, 1), _place(node, topic, sizes, 2)]
    marks = np.take(lexicon_.marks, entry, mode="clip")
    words = Group(marks & np.int8(1), marks >> 1, slots, np.arange(len(tokens.symbol)), sizes, lexicon_.plain)

    spelled = np.flatnonzero(tokens.symbol == ESCAPE)
    letters = _letters(texts, tokens, spelled)
    near = letters.two + np.take(mix(topic[spelled]), letters.which)
    sizes, entry = _spread(lexicon_.bytes.offset, letters.symbol)
    node = np.take(lexicon_.bytes.spread, entry, mode="clip")
    slots = [_place(node, c, sizes, 8 + k) for k, c in enumerate((near, letters.four, letters.prefix))]
    gate = np.repeat(_LETTER_GATE[np.minimum(letters.place, len(_LETTER_GATE) - 1)], sizes)
    spell = Group(np.take(lexicon_.bytes.bit, entry, mode="clip"), gate, slots, spelled[letters.which], sizes)
    return Bits(words, spell, tokens.text, tokens.place)


class Tally:
    """How often each slot was met by a zero and by a one, over the bits of texts that come in parts.

    Words after one word, words by topic and letters by the bytes before them are held as
    numbers, HELD of a kind at most, and those alike are spread to bits once, with their number.
    """

    def __init__(self, lexicon_: Lexicon) -> None:
        self.lexicon = lexicon_
        self.counts = np.zeros((2, INPUTS * SLOTS), np.int32)
        self.symbols = len(lexicon_.words.offset) - 1
        self.held: list[list[np.ndarray]] = [[], [], [], []]
        self.size = 0

    def add(self, texts: Texts, tokens: Tokens) -> None:
        topic = _topic(tokens)
        before = _before(tokens.symbol, tokens.place, 1, END)
        whole = before != ESCAPE
        spelled = np.flatnonzero(tokens.symbol == ESCAPE)
        letters = _letters(texts, tokens, spelled)
        for held, keys in zip(self.held, (
            before[whole] * self.symbols + tokens.symbol[whole], topic * self.symbols + tokens.symbol,
            (topic[spelled][letters.which] * 257 ** 2 + letters.two.view(np.int64)) * 256 + letters.symbol, letters.four.view(np.int64) * 256 + letters.symbol,
        ), strict=True):
            held.append(keys)
        self.size += max(len(tokens.symbol), len(letters.symbol))
        self._spread(self.lexicon.words, tokens.symbol[~whole], _before(tokens.value, tokens.place, 1)[~whole], 1)
        self._spread(self.lexicon.bytes, letters.symbol, letters.prefix, 10)
        if self.size > HELD:
            self.close()

    def _spread(self, code: Code, symbol: np.ndarray, context: np.ndarray | None, salt: int, n: np.ndarray | None = None) -> None:
        counts = self.counts.ravel()[(salt & 7) * SLOTS:]
        for low in range(0, len(symbol), PIECE):
            piece = slice(low, low + PIECE)
            sizes, entry = _spread(code.offset, symbol[piece])
            at = _place(np.take(code.spread, entry, mode="clip"), None if context is None else context[piece], sizes, salt)
            at += np.take(code.bit, entry, mode="clip") * np.intp(INPUTS * SLOTS)
            np.add.at(counts, at, np.int32(1) if n is None else np.repeat(n[piece].astype(np.int32), sizes))

    def close(self) -> np.ndarray:
        """Count what is held; the counts so far."""
        words, letters = self.lexicon.words, self.lexicon.bytes
        if self.size:
            (pair, n1), (by_topic, n2), (near, n3), (far, n4) = (_numbered(x) for x in self.held)
            self._spread(words, pair % self.symbols, self.lexicon.values[pair // self.symbols], 1, n1)
            symbol = by_topic % self.symbols
            self._spread(words, symbol, (by_topic // self.symbols).view(U64), 2, n2)
            plain = np.bincount(symbol, n2, self.symbols).astype(np.int64)
            symbol = np.flatnonzero(plain)
            self._spread(words, symbol, None, 0, plain[symbol])
            topic, two = np.divmod(near >> 8, 257 ** 2)
            self._spread(letters, near & 255, two.view(U64) + mix(topic.view(U64)), 8, n3)
            self._spread(letters, far & 255, (far >> 8).view(U64), 9, n4)
        self.held, self.size = [[], [], [], []], 0
        return self.counts


def _numbered(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each occurs."""
    all_ = np.concatenate(keys)
    all_.sort()
    first = np.flatnonzero(np.concatenate(([True], all_[1:] != all_[:-1]))[:len(all_)])
    return all_[first], np.diff(np.append(first, len(all_)))


def taken_once(table: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """What the table holds at given slots, kept for the next time that these are asked for."""
    kept: list[np.ndarray] = []

    def take(slots: np.ndarray) -> np.ndarray:
        if not kept or kept[0] is not slots:
            kept[:] = [slots, np.take(table, slots)]
        return kept[1]

    return take


@dataclass(frozen=True)
class Counts:
    """Log odds of a one in each slot, and how often the slot was met (255: as often or more)."""

    odds: np.ndarray
    met: np.ndarray

    @cached_property
    def codes(self) -> np.ndarray:
        """Log odds in steps of 1 / FINE and, in the lowest bit, whether the slot was met more than once."""
        odds = np.clip(np.rint(self.odds.astype(np.float32) * FINE), -(1 << 14), (1 << 14) - 1).astype(np.int16)
        odds <<= 1
        odds |= self.met > 1
        return odds

    @cached_property
    def first(self) -> Callable[[np.ndarray], np.ndarray]:
        return taken_once(self.codes)


def log_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + PRIOR) / (zeros + PRIOR))


def inputs_of(group: Group, counts: Counts) -> tuple[list[np.ndarray], np.ndarray]:
    """Inputs of the mixer (an array each, in steps of 1 / FINE, the bias is left out) and the gate of each bit."""
    inputs = group.taken(counts.codes, counts.first)
    return [x >> 1 for x in inputs], group.gate * np.int8(2) + (_longest(group, inputs) & np.int16(1)).astype(np.int8)


def _longest(group: Group, inputs: list[np.ndarray]) -> np.ndarray:
    """The input whose slot tells whether the longest context was met."""
    return inputs[1] if len(group.gate) and group.gate[0] < 4 else inputs[2]


def rounded_inputs(counts: Counts) -> np.ndarray:
    """For each slot a byte for a bit of 0 and one for a bit of 1 that were counted there.

    The bit's own occurrence is taken out of the counts, for learning from texts that were
    counted. The lower bits of a byte hold the log odds in steps of STEP, the next whether
    the slot was met more than once besides.
    """
    few = (counts.met > 0) & (counts.met < 255)
    odds, n = counts.odds.astype(np.float32), counts.met.astype(np.float32)
    # odds = log((n1 + PRIOR) / (n0 + PRIOR)) with n0 + n1 = met gives both counts back.
    ones = np.rint((n + 2 * PRIOR) / (1 + np.exp(-odds)) - PRIOR)
    out = np.empty((len(odds), 2), np.uint8)
    for bit in (0, 1):
        left = np.where(few, log_odds(np.maximum(n - ones - (1 - bit), 0), np.maximum(ones - bit, 0)), odds)
        out[:, bit] = np.clip(np.rint(left / STEP), -STEPS, STEPS) + STEPS + FLAG * (counts.met - few > 1)
    return out.ravel()


def both_rounded(rounded: np.ndarray) -> np.ndarray:
    """Both bytes of each slot as one number, that of a bit of 1 above the other."""
    return rounded.view("<u2")


def cells_of(bits: Bits, rounded: np.ndarray, first: Callable[[np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """Cell of each bit: its gate, its rounded inputs and the bit itself; first: ``taken_once`` of ``both_rounded``."""
    both = both_rounded(rounded)
    first = first or taken_once(both)
    out = np.empty(len(bits.words.bit) + len(bits.letters.bit), np.intp)
    at = 0
    for group in (bits.words, bits.letters):
        upper = group.bit.astype(np.uint16) << np.uint16(3)
        found = group.taken(both, first)
        for x in found:
            x >>= upper
            x &= np.uint16(255)
        cell = group.gate.astype(np.uint16) * np.uint16(2) + (_longest(group, found) >= FLAG)
        for x in found[:2]:
            cell *= np.uint16(WIDTH)
            cell += x & np.uint16(FLAG - 1)
        cell = cell.astype(np.int32)
        cell *= np.int32(WIDTH)
        cell += found[2] & np.uint16(FLAG - 1)
        cell *= np.int32(2)
        cell += group.bit
        out[at:at + len(cell)] = cell
        at += len(cell)
    return out


def fitted_weights(cells: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The most likely weights of every gate for so many bits in each of these cells.

    Newton's method; a normal law around the plain weights keeps gates with few bits near these.
    """
    weights = first_weights().astype(float)
    plain = weights.copy()
    sign, rest, x = 2.0 * (cells % 2) - 1, cells // 2, []
    for _ in range(INPUTS):
        x.insert(0, (rest % WIDTH - STEPS) * STEP)
        rest = rest // WIDTH
    x = np.stack([*x, np.full(len(cells), float(BIAS))], axis=1)
    for gate in range(GATES):
        at = np.flatnonzero(rest == gate)
        y, s, count = x[at], sign[at], n[at].astype(float)

        def loss(w: np.ndarray) -> float:
            return count @ np.logaddexp(0, -s * (y @ w)) + 0.5 * PULL * ((w - plain[gate]) ** 2).sum()

        now = loss(weights[gate])
        for _ in range(50):
            right = 1 / (1 + np.exp(np.clip(-s * (y @ weights[gate]), -60, 60)))
            slope = -(count * s * (1 - right)) @ y + PULL * (weights[gate] - plain[gate])
            bend = (y * (count * right * (1 - right))[:, None]).T @ y + PULL * np.eye(INPUTS + 1)
            move = np.linalg.solve(bend, slope)
            while (then := loss(weights[gate] - move)) > now and np.abs(move).max() > 1e-9:
                move = move / 2
            if then >= now:
                break
            weights[gate] -= move
            if now - then <= 1e-9 * now:
                break
            now = then
    return weights.astype(np.float32)


def first_weights() -> np.ndarray:
    out = np.full((GATES, INPUTS + 1), 0.3, np.float32)
    out[:, INPUTS] = 0
    return out


def mixed(bits: Bits, count: int, counts: Counts, weights: np.ndarray, rate: float = RATE) -> tuple[np.ndarray, np.ndarray]:
    """Natural log probability of each text, and the weights that each text ends with.

    Every text starts from ``weights`` and refines its own copy, chunk by chunk. The bits of a
    chunk are ordered by text and gate, so that those of one set of weights lie together.
    """
    own = [np.tile(weights[:, k].astype(np.float32), count) for k in range(INPUTS + 1)]
    total = len(bits.words.bit) + len(bits.letters.bit)
    if not total:
        return np.zeros(count), np.stack(own, axis=1).reshape(count, GATES, INPUTS + 1)
    # Chunks of texts in the order of chunks, numbered without gaps so that most keys take 16 bits.
    piece = bits.place // CHUNK * np.int64(count) + bits.text
    there = np.zeros(int(piece.max()) + 1, bool)
    there[piece] = True
    number = np.cumsum(there, dtype=np.int32) - np.int32(1)
    pieces = np.flatnonzero(there)
    small = np.uint16 if len(pieces) * GATES <= 1 << 16 else np.int32
    first_gate = (number[piece] * np.int32(GATES)).astype(small)
    # The inputs and the bit lie side by side while they are put in order.
    key, beside, at = np.empty(total, small), np.empty((total, INPUTS + 1), np.int16), 0
    for group in (bits.words, bits.letters):
        x, gate = inputs_of(group, counts)
        here = slice(at, at + len(gate))
        np.add(np.repeat(first_gate[group.owner], group.size), gate.astype(small), out=key[here])
        for k, v in enumerate([*x, group.bit]):
            beside[here, k] = v
        at += len(gate)
    order = np.argsort(key, kind="stable")
    key = np.take(key, order, mode="clip").astype(np.int32)
    beside = np.take(beside.view(np.int64).ravel(), order, mode="clip").view(np.int16).reshape(-1, INPUTS + 1)
    x = [beside[:, k].astype(np.float32) * np.float32(1 / FINE) for k in range(INPUTS)]
    sign = 2 * beside[:, INPUTS].astype(np.float32) - np.float32(1)
    # Runs of bits with one set of weights, and the runs of each chunk.
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(begin, len(key)))
    chunk, text = np.divmod(pieces[key[begin] // GATES], count)
    row = text * GATES + key[begin] % GATES
    pull = (rate / np.sqrt(1 + size / 64)).astype(np.float32)
    borders = np.searchsorted(chunk, np.arange(chunk[-1] + 2))
    begin = np.append(begin, len(key))
    loss = np.empty(len(key), np.float32)
    for low, high in zip(borders, borders[1:]):
        if low == high:
            continue
        at, here, n = slice(begin[low], begin[high]), row[low:high], size[low:high]
        s = sign[at]
        score = np.repeat(own[INPUTS][here] * BIAS, n)
        for k in range(INPUTS):
            part = np.repeat(own[k][here], n)
            part *= x[k][at]
            score += part
        score *= s
        np.maximum(score, np.float32(-60), out=score)
        np.minimum(score, np.float32(60), out=score)
        np.negative(score, out=score)
        odd = np.exp(score)
        # The error of each bit, with its sign.
        s *= odd
        odd += np.float32(1)
        s /= odd
        np.log(odd, out=loss[at])
        first = begin[low:high] - begin[low]
        # A gate's many bits of one chunk move its weights by their mean direction, damped.
        own[INPUTS][here] += pull[low:high] * BIAS * np.add.reduceat(s, first)
        for k in range(INPUTS):
            np.multiply(s, x[k][at], out=score)
            own[k][here] += pull[low:high] * np.add.reduceat(score, first)
    lost = np.add.reduceat(loss, begin[:-1], dtype=np.float64)
    return -np.bincount(text, lost, count), np.stack(own, axis=1).reshape(count, GATES, INPUTS + 1)
