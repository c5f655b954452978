"""Encoding of texts with a SentencePiece BPE vocabulary by suffix-array matching.

The new segments of a batch (a run of space marks with the characters up to the next mark;
no piece reaches over that border) are laid end to end and indexed by a suffix array as deep
as the longest piece. Every piece is found by binary search as a range of suffixes, the
ranges become edges (start, length, piece), and these are sorted by position. The edges are
then relaxed into the segmentation: among neighbouring symbols that an edge joins, the one
of highest score, leftmost first, becomes one symbol until no edge joins any. (The
vocabulary is of the BPE kind; a best path over edge scores would give other pieces.)
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import sentencepiece

MARK = "▁"
#: Segments up to this many characters are relaxed together, longer ones one by one.
SHORT = 128
#: Segments whose pieces a task keeps.
KEPT = 400_000
#: Characters of segments that are indexed together, or one longer segment.
INDEXED = 1 << 18
_LENGTHS = 64


class Vocabulary:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        pieces = [model.id_to_piece(k) for k in range(size)]
        special = [model.is_control(k) or model.is_unknown(k) or model.is_unused(k) for k in range(size)]
        byte = [model.is_byte(k) for k in range(size)]
        self.unknown = model.unk_id()
        self.byte_ids = {int(pieces[k][3:5], 16): k for k in range(size) if byte[k]}
        normal = [k for k in range(size) if not special[k] and not byte[k]]
        if any(MARK in p.lstrip(MARK) for p in (pieces[k] for k in normal)):
            raise ValueError("a piece reaches over a space mark")
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte pieces")
        self.ids = np.array(normal, np.int64)
        codes = [np.frombuffer(pieces[k].encode("utf-32-le"), np.uint32) for k in normal]
        self.lengths = np.array([len(c) for c in codes])
        self.depth = int(self.lengths.max())
        if self.depth >= _LENGTHS:
            raise ValueError("a piece is too long")
        self.codes = np.zeros((len(normal), self.depth), np.int64)
        for k, c in enumerate(codes):
            self.codes[k, :len(c)] = c
        # 0 for the best score; equal scores stay equal.
        scores = np.array([model.get_score(k) for k in normal])
        rank = np.zeros(size, np.int64)
        rank[self.ids] = np.unique(-scores, return_inverse=True)[1]
        self.rank = rank
        self.bytes = [bytes([int(p[3:5], 16)]) if b else b"" if s else p.replace(MARK, " ").encode() for p, b, s in zip(pieces, byte, special, strict=True)]


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes by their first ``depth`` codes (at least), by prefix doubling.

    The first round takes as many codes as fit in 63 bits.
    """
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1
    bits = int(rank.max()).bit_length()
    length = max(1, min(depth, 63 // bits))
    key = np.zeros(len(rank), np.int64)
    for k in range(length):
        key <<= bits
        key[:max(0, len(rank) - k)] |= rank[k:]
    while True:
        order = np.argsort(key)
        if length >= depth:
            return order
        ordered = key[order]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(np.concatenate(([1], ordered[1:] != ordered[:-1])))
        key = rank << 32
        key[:max(0, len(key) - length)] |= rank[length:]
        length *= 2


def _bound(codes: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, wanted: np.ndarray, after: bool) -> np.ndarray:
    """First place in [low, high) whose suffix has a code >= wanted (after: > wanted) at ``depth``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) >> 1
        at = order[middle] + depth
        code = np.where(at < len(codes), codes[np.minimum(at, len(codes) - 1)], -1)
        right = code <= wanted[open_] if after else code < wanted[open_]
        low[open_[right]] = middle[right] + 1
        high[open_[~right]] = middle[~right]


def find_edges(codes: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences of pieces within segments as keys start * 64 + length, ascending, with piece ids.

    ends[i] is the end of the segment that position i belongs to.
    """
    order = suffix_array(codes, vocabulary.depth)
    count = len(vocabulary.ids)
    alive = np.arange(count)
    low, high = np.zeros(count, np.int64), np.full(count, len(codes))
    for depth in range(vocabulary.depth):
        wanted = vocabulary.codes[alive, depth]
        a = _bound(codes, order, low[alive], high[alive], depth, wanted, False)
        b = _bound(codes, order, a, high[alive], depth, wanted, True)
        low[alive], high[alive] = a, b
        alive = alive[(b > a) & (vocabulary.lengths[alive] > depth + 1)]
    # Pieces that weren't followed to their end have an empty range.
    span = high - low
    piece = np.repeat(np.arange(count), span)
    start = order[np.repeat(low - (np.cumsum(span) - span), span) + np.arange(span.sum())]
    length = vocabulary.lengths[piece]
    inside = start + length <= ends[start]
    key = start[inside] * _LENGTHS + length[inside]
    by_place = np.argsort(key)
    return key[by_place], vocabulary.ids[piece[inside]][by_place]


def _at(keys: np.ndarray, ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Piece ids of edges, -1 where there is none."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, ids[at], -1)


def _relax_together(begin: np.ndarray, size: np.ndarray, keys: np.ndarray, ids: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols (segment, start, end) after all joins, for many short segments at once."""
    segment = np.repeat(np.arange(len(begin)), size)
    start = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    end = start + 1
    worst = np.int64(1) << 60
    done = []
    while len(segment):
        joined = np.full(len(segment), worst)
        near = np.flatnonzero(segment[1:] == segment[:-1])
        length = end[near + 1] - start[near]
        near, length = near[length < _LENGTHS], length[length < _LENGTHS]
        piece = _at(keys, ids, start[near] * _LENGTHS + length)
        joined[near] = np.where(piece >= 0, (rank[piece] << 32) | near, worst)
        first = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
        best = np.minimum.reduceat(joined, first)
        open_ = best < worst
        left = best[open_] & 0xFFFFFFFF
        end[left] = end[left + 1]
        keep = np.ones(len(segment), bool)
        keep[left + 1] = False
        more = np.repeat(open_, np.diff(np.concatenate((first, [len(segment)]))))
        if not more.all():
            done.append((segment[~more], start[~more], end[~more]))
        keep &= more
        segment, start, end = segment[keep], start[keep], end[keep]
    if not done:
        none = np.zeros(0, np.int64)
        return none, none, none
    out = [np.concatenate(x) for x in zip(*done, strict=True)]
    by_place = np.argsort(out[1], kind="stable")
    return out[0][by_place], out[1][by_place], out[2][by_place]


def _relax_alone(begin: int, stop: int, keys: np.ndarray, ids: np.ndarray, rank: np.ndarray) -> list[tuple[int, int]]:
    """Symbols (start, end) of one long segment, with an agenda of the edges that join neighbours."""
    low, high = np.searchsorted(keys, [begin * _LENGTHS, stop * _LENGTHS])
    edges = dict(zip(keys[low:high].tolist(), rank[ids[low:high]].tolist(), strict=True))
    n = stop - begin
    end = list(range(begin + 1, stop + 1))
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    live = [True] * n
    agenda: list[tuple[int, int, int]] = []

    def offer(left: int) -> None:
        right = after[left] if left >= 0 else n
        if left >= 0 and right < n and end[right] - left - begin < _LENGTHS:
            found = edges.get((begin + left) * _LENGTHS + end[right] - left - begin)
            if found is not None:
                heapq.heappush(agenda, (found, left, end[right]))

    for k in range(n - 1):
        offer(k)
    while agenda:
        _, left, to = heapq.heappop(agenda)
        right = after[left]
        if not live[left] or right >= n or end[right] != to:
            continue
        live[right] = False
        end[left], after[left] = to, after[right]
        if after[left] < n:
            before[after[left]] = left
        offer(before[left])
        offer(left)
    out, k = [], 0
    while k < n:
        out.append((begin + k, end[k]))
        k = after[k]
    return out


def encode_segments(segments: list[str], vocabulary: Vocabulary) -> list[bytes]:
    """Piece ids (int32) of each segment; a segment holds the marks before it."""
    if not segments:
        return []
    text = "".join(segments)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    size = np.array([len(s) for s in segments])
    stop = np.cumsum(size)
    begin = stop - size
    keys, ids = find_edges(codes, np.repeat(stop, size), vocabulary)
    short = np.flatnonzero(size <= SHORT)
    owner, start, end = _relax_together(begin[short], size[short], keys, ids, vocabulary.rank)
    parts = [(short[owner], start, end)]
    for k in np.flatnonzero(size > SHORT).tolist():
        found = np.array(_relax_alone(int(begin[k]), int(stop[k]), keys, ids, vocabulary.rank))
        parts.append((np.full(len(found), k), found[:, 0], found[:, 1]))
    owner, start, end = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(start, kind="stable")
    owner, start, end = owner[order], start[order], end[order]
    piece = _at(keys, ids, start * _LENGTHS + (end - start))
    # Characters without a piece become the pieces of their bytes.
    lost = np.flatnonzero(piece < 0)
    counts = np.bincount(owner, minlength=len(segments))
    if len(lost):
        raw = [[vocabulary.byte_ids[b] for b in text[s].encode()] for s in start[lost].tolist()]
        width = np.ones(len(piece), np.int64)
        width[lost] = [len(r) for r in raw]
        place = np.cumsum(width) - width
        wide = np.repeat(piece, width)
        for at, r in zip(place[lost].tolist(), raw, strict=True):
            wide[at:at + len(r)] = r
        counts = np.bincount(np.repeat(owner, width), minlength=len(segments))
        piece = wide
    data = piece.astype(np.int32).tobytes()
    borders = [0, *(4 * np.cumsum(counts)).tolist()]
    return [data[a:b] for a, b in zip(borders, borders[1:])]


def segments_of(text: str) -> list[str]:
    """The text without its marks as parts: each stands for one mark, or more, and what follows.

    A part is the characters after one mark; marks beyond the first stand before it as spaces.
    """
    parts = text.replace(MARK, " ").split(" ")
    if "" not in parts:
        return parts
    out, marks = [], 0
    for k, part in enumerate(parts):
        if part or k == len(parts) - 1:
            # A trailing run of marks is a segment of its own.
            out.append(" " * marks + part)
            marks = 0
        else:
            marks += 1
    return out


class Encoder:
    """Encodes batches of texts; keeps the pieces of about KEPT segments between batches."""

    def __init__(self, vocabulary: Vocabulary, kept: int = KEPT) -> None:
        self.vocabulary, self.kept = vocabulary, kept
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, segments: set[str]) -> None:
        """Make the pieces of these segments known; those not met for long are forgotten."""
        if len(self.known) > self.kept // 2:
            self.known, self.older = {}, self.known
        new = segments.difference(self.known)
        again = new.intersection(self.older)
        self.known.update((s, self.older[s]) for s in again)
        wanted = list(new - again)
        marked = []
        for s in wanted:
            body = s.lstrip(" ")
            marked.append(MARK * (len(s) - len(body) + 1) + body)
        ends = np.cumsum([len(s) for s in marked])
        at = 0
        while at < len(marked):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + INDEXED, "right")))
            self.known.update(zip(wanted[at:to], encode_segments(marked[at:to], self.vocabulary), strict=True))
            at = to

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Piece ids (int32) of every text; an empty text has none."""
        # Cut twice: the segments of a whole batch as strings take ten times the bytes of its texts.
        met: set[str] = set()
        for t in texts:
            if t:
                met.update(segments_of(t))
        self._learn(met)
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, segments_of(t) if t else ())), np.int32) for t in texts]

    def decode(self, ids: np.ndarray) -> str:
        """The text of piece ids; invalid byte sequences become U+FFFD."""
        raw = b"".join(map(self.vocabulary.bytes.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "replace").removeprefix(" ")
