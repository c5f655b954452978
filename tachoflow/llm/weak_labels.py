"""Quality classifier from weak labels.

Heuristic labellers vote good (1), bad (0) or not at all (2) on every text. An EM algorithm
over the counts of vote patterns (at most 3 ** labellers, whatever the corpus holds)
estimates how often each labeller gives each vote to good and to bad texts; the posterior of
a pattern is the label. A hashed linear scorer is fitted on the posteriors of a sample of
SAMPLE_DOCS texts, chosen by a hash of their id, and then scores every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tachoflow.llm.kneser_ney import gram_codes
from tachoflow.llm.quality_rules import base_counts
from tachoflow.llm.tables import written
from tachoflow.llm.words import LOWER, U64, Texts, find_words, hash_words, mix, slices

GOOD, BAD, NONE = 1, 0, 2
#: Bound of the rows the scorer is fitted on (documented parameter; the labels use all rows).
SAMPLE_DOCS = 8_000
#: Features of each sort (character trigrams, words).
BINS = 1 << 16
KEEP = 0.5

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 0xC2)
_PUNCTUATION = (_BYTES > 32) & (_BYTES < 127) & ~_LETTER & ~_DIGIT
_STOP = np.isin(_BYTES, np.frombuffer(b".!?", np.uint8))
_ODD_END = _PUNCTUATION & ~np.isin(_BYTES, np.frombuffer(b".,;:?!)\"'", np.uint8))


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _vote(bad: np.ndarray, good: np.ndarray | bool = False) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, NONE))


def votes(texts: Texts) -> np.ndarray:
    """One row per text, one column per labeller. Most only speak up against a text."""
    data = texts.data
    counts = base_counts(texts)
    words = np.maximum(counts["n_words"], 1)
    lines = np.maximum(_sums(data == 10, texts.offsets) + 1, 1)
    found = find_words(texts)
    last = data[found.end - 1] if len(found.end) else np.zeros(0, np.uint8)
    ending = lambda kind: np.bincount(found.text[kind[last]], minlength=texts.count) / words
    letters = np.maximum(_sums(_LETTER[data], texts.offsets), 1)
    stops = ending(_STOP)
    return np.stack([
        _vote(counts["n_words"] < 20, counts["n_words"] >= 80),
        _vote(counts["n_symbols"] / words > 0.08),
        _vote(ending(_ODD_END) > 0.1),
        _vote(_sums(_PUNCTUATION[data], texts.offsets) / letters > 0.1, _sums(_PUNCTUATION[data], texts.offsets) / letters < 0.05),
        _vote(counts["n_repeat_words"] / words > 0.5),
        _vote(counts["n_dup_lines"] / lines > 0.3),
        _vote(_sums(_UPPER[data], texts.offsets) / letters > 0.4),
        _vote(stops > 0.4, (stops > 0.03) & (stops < 0.3)),
    ], axis=1)


LABELLERS = 8


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float, np.ndarray]:
    """Posterior of each pattern being good, the share of good texts, and p(vote | class) of each labeller.

    Starts from the number of votes against a text, which fixes which class is which.
    """
    against = (patterns == BAD).sum(axis=1)
    posterior = np.select([against == 0, against == 1], [0.9, 0.2], 0.05)
    total = max(float(counts.sum()), 1.0)
    share, given = 0.5, np.full((patterns.shape[1], 2, 3), 1 / 3)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - posterior), counts * posterior])
        share = float((weight[1].sum() + 1) / (total + 2))
        for j in range(patterns.shape[1]):
            for v in range(3):
                given[j, :, v] = weight[:, patterns[:, j] == v].sum(axis=1)
        smooth = given + 0.5
        given = smooth / smooth.sum(axis=2, keepdims=True)
        log = np.log([1 - share, share])[:, None] + sum(np.log(given[j][:, patterns[:, j]]) for j in range(patterns.shape[1]))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        if np.abs(new - posterior).max(initial=0) < 1e-9:
            posterior = new
            break
        posterior = new
    return posterior, share, given


def bins(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed character trigrams and words of all texts: (gram bin, its text, word bin, its text)."""
    gram = (mix(gram_codes(texts.data, texts.offsets).astype(U64)) % U64(BINS)).astype(np.int64)
    gram_text = np.repeat(np.arange(texts.count), np.diff(texts.offsets))
    low = texts._replace(data=LOWER[texts.data])
    found = find_words(low)
    word = (hash_words(low.data, found) % U64(BINS)).astype(np.int64)
    return gram, gram_text, word + BINS, found.text


def linear(texts: Texts, weights: np.ndarray) -> np.ndarray:
    """Bias plus the mean weight of a text's trigrams and the mean weight of its words."""
    gram, gram_text, word, word_text = bins(texts)
    out = np.full(texts.count, weights[-1])
    for bin_, text in ((gram, gram_text), (word, word_text)):
        size = np.bincount(text, minlength=texts.count)
        out += np.bincount(text, weights[bin_], texts.count) / np.maximum(size, 1)
    return out


def fit_linear(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, target: np.ndarray, steps: int = 150, rate: float = 2.0, ridge: float = 1e-6) -> np.ndarray:
    """Logistic regression on a sparse matrix by AdaGrad; the last weight is the bias."""
    weights, square = np.zeros(2 * BINS + 1), np.full(2 * BINS + 1, 1e-8)
    if not len(target):
        return weights
    for _ in range(steps):
        margin = np.bincount(rows, values * weights[columns], len(target)) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - target) / len(target)
        slope = np.append(np.bincount(columns, values * error[rows], 2 * BINS), error.sum()) + ridge * weights
        square += slope * slope
        weights -= rate * slope / np.sqrt(square)
    return weights


def quality_scores(docs: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """Votes, posterior and score of every document.

    ``docs`` has doc_id and text; other columns are ignored. Returns one row per row: doc_id,
    pattern (a digit per labeller: 1 good, 0 bad, 2 no vote), posterior (from the votes
    alone), score (of the scorer, 0..1) and keep (score of KEEP at least).

    A null text counts as empty; an empty text gets the votes of a text without words and the
    scorer's bias. Repeated rows count and score alike. Without rows the result is empty.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch["text"]):
                digits = (votes(texts) + 48).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(texts.first, texts.count), pa.array([r.tobytes().decode() for r in digits])], ["doc_id", "pattern"])

    # At most 3 ** LABELLERS rows.
    cast = docs.mapInArrow(vote, "doc_id long, pattern string")
    table = cast.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()
    patterns = np.array([[int(c) for c in r.pattern] for r in table], int).reshape(-1, LABELLERS)
    total = sum(r.n for r in table)
    posterior, _, _ = expectation_maximisation(patterns, np.array([r.n for r in table], float))
    label = {r.pattern: float(p) for r, p in zip(table, posterior, strict=True)}

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch["text"]):
                digits = (votes(texts) + 48).astype(np.uint8)
                gram, gram_text, word, word_text = bins(texts)
                both = np.concatenate([gram_text, word_text]) * (2 * BINS) + np.concatenate([gram, word])
                key, n = np.unique(both, return_counts=True)
                text, column = key // (2 * BINS), key % (2 * BINS)
                size = np.where(column < BINS, np.bincount(gram_text, minlength=texts.count)[text], np.bincount(word_text, minlength=texts.count)[text])
                value = (n / size).astype(np.float32)
                border = np.searchsorted(text, np.arange(texts.count + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([label.get(r.tobytes().decode(), 0.5) for r in digits]),
                        pa.ListArray.from_arrays(pa.array(border), pa.array(column.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(border), pa.array(value)),
                    ],
                    ["target", "columns", "values"],
                )

    chosen = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < F.lit(int(1_000_000 * min(1.0, sample / max(total, 1)))))
    rows = written(chosen.mapInArrow(examples, "target double, columns array<int>, values array<float>"), "examples").limit(2 * sample).toArrow()
    if rows.num_rows:
        rows = rows.combine_chunks()
        columns = [rows[c].combine_chunks() for c in ("columns", "values")]
        lengths = np.asarray(columns[0].value_lengths())
        weights = fit_linear(np.repeat(np.arange(rows.num_rows), lengths), columns[0].flatten().to_numpy().astype(np.int64),
                             columns[1].flatten().to_numpy().astype(float), rows["target"].to_numpy())
    else:
        weights = np.zeros(2 * BINS + 1)
    shared = docs.sparkSession.sparkContext.broadcast((weights, label))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, labels = shared.value
        for batch in batches:
            for texts in slices(batch["text"]):
                pattern = [r.tobytes().decode() for r in (votes(texts) + 48).astype(np.uint8)]
                value = 1 / (1 + np.exp(-np.clip(linear(texts, known), -40, 40)))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(texts.first, texts.count), pa.array(pattern), pa.array([labels.get(p, 0.5) for p in pattern]), pa.array(value), pa.array(value >= KEEP)],
                    ["doc_id", "pattern", "posterior", "score", "keep"])

    return docs.mapInArrow(score, "doc_id long, pattern string, posterior double, score double, keep boolean")
