"""Benchmark decontamination by size-partitioned MinHash containment search.

Which documents hold a benchmark item? A short item inside a long document has a tiny
Jaccard similarity, so it is the item that is sketched: of its q distinct shingles the
smallest hashes are kept, and a document is a candidate if it holds enough of them. With
containment of ``percent`` at least, no more than m = floor(q (100 - percent) / 100) shingles
are missing, so of a sketch of m + r hashes at least r are found; no such pair is missed.
Documents are partitioned by size: the longer one is, the more hashes meet by chance and the
larger is r (``needed``). Candidates are verified by exact shingle containment.

Benchmark items are taken in blocks whose sketches and words stay below BLOCK_ITEMS items and
BLOCK_BYTES of text each; every block goes to all tasks, documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tachoflow.llm.tables import giving_back
from tachoflow.llm.words import U64, distinct_per_text, find_words, hash_words, mix, slices, windows

#: Bytes of text worked on at a time.
SLICE = 1 << 19
BLOCK_ITEMS = 50_000
BLOCK_BYTES = 16 << 20
#: Document sizes (distinct shingles) from which one more sketch hash is asked for.
SIZE_STEPS = (0, 256, 1024, 4096, 16384, 65536)

#: ASCII punctuation parts words like white space.
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_BLANK = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))


def folded(text: str | None) -> bytes:
    """Lower case with ASCII punctuation turned to spaces: the form in which texts are compared."""
    return (text or "").lower().encode().translate(_BLANK)


def exact_shingles(text: bytes, size: int) -> set[bytes]:
    words = text.split()
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[k:k + size]) for k in range(len(words) - size + 1)}


def needed(sizes: np.ndarray) -> np.ndarray:
    """How many sketch hashes a document of each size must hold."""
    return np.searchsorted(np.array(SIZE_STEPS), sizes, "right")


def _hashed_windows(column: pa.Array, size: int):
    for texts in slices(column, SLICE):
        words = find_words(texts)
        hashes = hash_words(texts.data, words)
        value, owner = windows(hashes, words.text, size)
        lengths = np.bincount(words.text, minlength=texts.count)
        yield texts, lengths, hashes, words, *distinct_per_text(value, owner)


class Sketches:
    """Sketch hashes of a block of items, ascending, with the item and the hash's rank in it."""

    def __init__(self, items: list[tuple[int, str]], size: int, percent: int) -> None:
        self.size, self.percent = size, percent
        self.ids = [i for i, _ in items]
        self.words = [folded(t) for _, t in items]
        self.short: dict[int, dict[bytes, list[int]]] = {}
        keys, owners, ranks = [], [], []
        # Distinct shingles and those that may be missing, per item.
        self.count = np.zeros(len(items), np.int64)
        for k, text in enumerate(self.words):
            words = text.split()
            if not words:
                continue
            if len(words) < size:
                self.short.setdefault(len(words), {}).setdefault(b" ".join(words), []).append(k)
                continue
            *_, value, _ = next(_hashed_windows(pa.array([text.decode()]), size))
            self.count[k] = len(value)
            missing = len(value) * (100 - percent) // 100
            rank = np.sort(mix(value))[:missing + len(SIZE_STEPS)]
            keys.append(rank)
            owners.append(np.full(len(rank), k))
            ranks.append(np.arange(len(rank)) - missing)
        none = np.zeros(0, np.int64)
        key = np.concatenate(keys) if keys else np.zeros(0, U64)
        order = np.argsort(key)
        self.key = key[order]
        self.owner = np.concatenate(owners)[order] if owners else none
        self.rank = np.concatenate(ranks)[order] if ranks else none
        self.shingles: dict[int, set[bytes]] = {}

    def exact(self, item: int) -> set[bytes]:
        if item not in self.shingles:
            self.shingles[item] = exact_shingles(self.words[item], self.size)
        return self.shingles[item]

    def candidates(self, value: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
        """Pairs (text, item) of which the text holds enough sketch hashes."""
        if not len(self.key) or not len(value):
            return np.zeros((0, 2), np.int64)
        hashed = mix(value)
        low = np.searchsorted(self.key, hashed, "left")
        hit = np.flatnonzero(self.key[np.minimum(low, len(self.key) - 1)] == hashed)
        if not len(hit):
            return np.zeros((0, 2), np.int64)
        span = np.searchsorted(self.key, hashed[hit], "right") - low[hit]
        text = np.repeat(owner[hit], span)
        place = np.repeat(low[hit] - (np.cumsum(span) - span), span) + np.arange(span.sum())
        item, rank = self.owner[place], self.rank[place]
        least = np.minimum(needed(np.bincount(owner, minlength=count)), len(SIZE_STEPS))
        # An item with few shingles may have no more than count - missing hashes to ask for.
        missing = self.count * (100 - self.percent) // 100
        asked = np.minimum(least[text], (self.count - missing)[item])
        inside = rank < asked
        pairs, found = np.unique(np.stack([text[inside], item[inside]], axis=1), axis=0, return_counts=True)
        return pairs[found >= np.minimum(least[pairs[:, 0]], (self.count - missing)[pairs[:, 1]])] if len(pairs) else pairs


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for row in items.toLocalIterator():
        block.append((row.item_id, row.text))
        size += len(row.text)
        if len(block) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Pairs of a document and a benchmark item of whose shingles it holds ``percent`` or more.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are ignored.
    Words are split at white space and ASCII punctuation after lower-casing, a shingle is
    ``size`` words. An item of fewer words is one shingle, which a document holds if the
    words follow one another in it. Returns doc_id, item_id, n_shingles (distinct ones of the
    item) and n_found.

    Null and empty texts and items match nothing. Repeated rows of a document give repeated
    pairs; repeated equal items count once, items with the same id but other text on their
    own. No documents or no items give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    context = docs.sparkSession.sparkContext
    schema = "doc_id long, item_id long, n_shingles long, n_found long"
    found = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(items):
        shared = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            sketches = Sketches(shared.value, size, percent)
            for batch in batches:
                for texts in slices(batch["text"], SLICE):
                    part = batch.slice(texts.first, texts.count)
                    plain = [folded(t) for t in part["text"].to_pylist()]
                    yield from _matches(part["doc_id"], plain, sketches, size, percent)

        found = found.union(docs.mapInArrow(giving_back(run), schema))
    return found


def _matches(ids: pa.Array, plain: list[bytes], sketches: Sketches, size: int, percent: int) -> Iterator[pa.RecordBatch]:
    rows: list[tuple[int, int, int, int]] = []
    column = pa.array(plain, pa.large_binary())
    for texts, _, hashes, words, value, owner in _hashed_windows(column, size):
        held: tuple[int, set[bytes]] = (-1, set())
        for text, item in sketches.candidates(value, owner, texts.count).tolist():
            if held[0] != text:
                held = (text, exact_shingles(plain[texts.first + text], size))
            wanted = sketches.exact(item)
            met = len(wanted & held[1])
            if 100 * met >= percent * len(wanted):
                rows.append((texts.first + text, item, len(wanted), met))
        for n, known in sketches.short.items():
            wanted = hash_words_of(list(known), n)
            run, who = windows(hashes, words.text, n)
            at = np.isin(run, wanted)
            for text in np.unique(who[at]).tolist():
                every = plain[texts.first + text].split()
                held_runs = {b" ".join(every[k:k + n]) for k in range(len(every) - n + 1)}
                rows += [(texts.first + text, item, 1, 1) for key in known if key in held_runs for item in known[key]]
    if rows:
        at, item, n, met = (list(x) for x in zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(at)), pa.array([sketches.ids[k] for k in item], pa.int64()), pa.array(n, pa.int64()), pa.array(met, pa.int64())],
            ["doc_id", "item_id", "n_shingles", "n_found"])


def hash_words_of(runs: list[bytes], n: int) -> np.ndarray:
    """Window hashes of runs of n words each."""
    found = []
    for texts in slices(pa.array(runs, pa.large_binary())):
        words = find_words(texts)
        found.append(windows(hash_words(texts.data, words), words.text, n)[0])
    return np.concatenate(found)
