"""Toxicity from subword bags: averaged embeddings and a linear softmax, trained together.

Every subword (``subwords``) has a bucket with an embedding. A text is the weighted average of
its subwords' embeddings, where occurrences of one word in a text together weigh the root of
their number, and PAUSE empty subwords are averaged in, so that few words do not make a strong
case. A linear softmax over two classes reads the average. Embeddings and softmax are trained
together by stochastic gradient descent in numpy, with a step that falls to zero, on a bounded
sample of labelled texts; a misspelling that never occurred shares most of its subwords with
the words it comes from. Averaging is linear, so scoring needs one number per bucket: the
difference of the two class scores of its embedding.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tachoflow.llm.subwords import BITS, bags, subword_blocks
from tachoflow.llm.tables import written
from tachoflow.llm.words import Texts, slices

#: Bounds of the sample the model is trained on: labelled texts, and their distinct subwords in
#: total. Texts are taken in the order of a hash of their id.
SAMPLE_DOCS = 6_000
SAMPLE_ENTRIES = 8_000_000
DIMENSIONS = 16
PAUSE = 300.0
#: Passes over the sample; a small sample is passed over until STEPS texts were seen, MOST_ROUNDS times at most.
ROUNDS, STEPS, MOST_ROUNDS = 12, 40_000, 60
RATE, SOFTMAX_RATE = 100.0, 0.1
#: Labels of ids with this remainder are not learned from.
HELD_OUT = 5
SEED = 11

EXAMPLE_DDL = "place long, toxic int, n long, buckets array<int>, weights array<float>"
RESULT_DDL = "doc_id long, score double"


class Model(NamedTuple):
    """Embedding of every bucket, softmax weights (dimension, class) and biases."""

    embeddings: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray

    def differences(self) -> tuple[np.ndarray, float]:
        """What a bucket, and no bucket, adds to the toxic class above the other."""
        return (self.embeddings @ (self.softmax[:, 1] - self.softmax[:, 0])).astype(float), float(self.bias[1] - self.bias[0])


def averaged(weights: np.ndarray) -> np.ndarray:
    return (weights / (weights.sum() + PAUSE)).astype(np.float32)


def train(bag: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, bits: int = BITS) -> Model:
    """Fit on bags of (distinct buckets, averaged weights). Without examples texts count as rather clean."""
    rng = np.random.default_rng(SEED)
    embeddings = (rng.normal(0, 0.01, (1 << bits, DIMENSIONS))).astype(np.float32)
    softmax = (rng.normal(0, 1, (DIMENSIONS, 2)) / np.sqrt(DIMENSIONS)).astype(np.float32)
    n, positive = len(bag), float(toxic.sum())
    bias = np.log([(n - positive + 2) / (n + 3), (positive + 1) / (n + 3)]).astype(np.float32)
    rounds = int(np.clip(STEPS // max(n, 1), ROUNDS, MOST_ROUNDS))
    # The rarer class weighs more, by the root of how much rarer it is.
    weight = np.sqrt((n + 2) / 2 / np.array([n - positive + 1, positive + 1])).astype(np.float32)
    for turn in range(rounds if n else 0):
        slow = 1 - turn / rounds
        for i in rng.permutation(n):
            buckets, weights = bag[i]
            text = weights @ embeddings[buckets]
            logit = text @ softmax + bias
            error = np.exp(logit - logit.max())
            error /= error.sum()
            error[int(toxic[i])] -= 1
            error *= weight[int(toxic[i])]
            back = softmax @ error
            softmax -= SOFTMAX_RATE * slow * np.outer(text, error)
            bias -= SOFTMAX_RATE * slow * error
            embeddings[buckets] -= (RATE * slow * weights)[:, None] * back
    return Model(embeddings, softmax, bias)


def held_out(key: str = "doc_id") -> Column:
    """Whether the labels of an id are never learned from; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % HELD_OUT == 0


def _examples(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """Bags of a sample of labelled texts, written. A text that repeats under one id counts once."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out())
    per_id = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    place = F.xxhash64("doc_id", F.lit(SEED))
    # No more rows than the sample's bound.
    chosen = F.broadcast(per_id.withColumn("place", place).orderBy("place", "doc_id").limit(sample))
    texts = docs.join(chosen, "doc_id").dropDuplicates(["doc_id", "text"]).select("place", "toxic", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch["text"]):
                owner, bucket, weight = bags(part)
                border = np.searchsorted(owner, np.arange(part.count + 1)).astype(np.int32)
                own = batch.slice(part.first, part.count)
                yield pa.RecordBatch.from_arrays(
                    [own["place"], own["toxic"], pa.array(np.diff(border).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(border), pa.array(bucket.astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(border), pa.array(weight.astype(np.float32)))],
                    ["place", "toxic", "n", "buckets", "weights"])

    return written(texts.mapInArrow(run, EXAMPLE_DDL), "toxic-examples")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS, entries: int = SAMPLE_ENTRIES) -> Model:
    """Train on at most so many labelled texts and, in total, distinct subwords of texts."""
    rows = _examples(docs, labels, sample)
    # Sizes first: what is then fetched is bounded in bytes as well as in rows.
    sizes = rows.select("place", "n").orderBy("place", "n").limit(sample).toArrow()
    total = np.cumsum(sizes["n"].to_numpy())
    fitting = int(np.searchsorted(total, entries, "right"))
    if not fitting:
        return train([], np.zeros(0))
    last = sizes["place"][fitting - 1].as_py()
    got = rows.where(F.col("place") <= last).orderBy("place", "n", F.xxhash64("buckets")).limit(fitting).toArrow()
    got = got.combine_chunks()
    border = np.concatenate(([0], np.cumsum(got["n"].to_numpy())))
    buckets, weights = (got[c].combine_chunks().flatten().to_numpy() for c in ("buckets", "weights"))
    bag = [(buckets[a:b], averaged(weights[a:b])) for a, b in zip(border[:-1], border[1:], strict=True)]
    return train(bag, got["toxic"].to_numpy())


def margins(texts: Texts, table: np.ndarray, bias: float) -> np.ndarray:
    """Log odds of being toxic of every text."""
    total, value = np.full(texts.count, PAUSE), np.zeros(texts.count)
    for bucket, weight, owner in subword_blocks(texts):
        total += np.bincount(owner, weight, texts.count)
        value += np.bincount(owner, weight * table[bucket], texts.count)
    return value / total + bias


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document: doc_id, held_out, score (0 to 1), predicted (score of 0.5 at least).

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic (0 or 1; rows with anything else or
    without an id are not used; an id with several labels counts as toxic if one says so).
    Other columns of either are ignored. Only the text decides a score: a null or empty text and
    one without words get the score of no words, repeated rows and copies score alike, a text of
    any length is read to its end, some words at a time. Labels
    of held-out ids are never learned from. Without labels all texts get the same low score;
    without documents the result is empty.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = fit(docs, labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")))
    shared = docs.sparkSession.sparkContext.broadcast(model.differences())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value
        for batch in batches:
            for texts in slices(batch["text"]):
                value = 1 / (1 + np.exp(-np.clip(margins(texts, table, bias), -40, 40)))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(texts.first, texts.count), pa.array(value)], ["doc_id", "score"])

    scored = docs.mapInArrow(score, RESULT_DDL)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
