"""Language-model scoring of documents by logistic context mixing (``context_mixing``).

Spark counts the words of all training texts and, for every hashed context, its zeros and
ones. A task adds up its own slots and passes them on in blocks, each of which is then summed
by one task; the table has a fixed number of slots. The commonest words (VOCABULARY, each LEAST_COUNT times) and the
table go to all tasks; both are bounded by these parameters. Counts of all other words are
joined by word hash, never broadcast. The first weights are fitted to the bits of all training
texts, which Spark counts by gate and rounded inputs (CELLS cells at most).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tachoflow.llm import context_mixing as cm
from tachoflow.llm.tables import written
from tachoflow.llm.words import U64, mix, slices

VOCABULARY = 1 << 16
#: Rarer words are spelled, so that spelling is learned from such words.
LEAST_COUNT = 4
SLICE = 256 << 10
BLOCK = 1 << 13
#: Distinct words a task holds before it passes their counts on.
HELD = 1 << 20
_TABLE = cm.INPUTS * cm.SLOTS


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning; one without id isn't."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


def _word_counts(training: DataFrame) -> DataFrame:
    """Rows (kind, key, n): 0 a word's hash, 1 a byte within words, 2 the number of texts."""

    def rows(kind: int, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind)), pa.array(key.astype(U64).view(np.int64)), pa.array(n.astype(np.int64))], ["kind", "key", "n"])

    def merged(keys: list, numbers: list) -> tuple[np.ndarray, np.ndarray]:
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        return key, np.bincount(back, np.concatenate(numbers), len(key)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, numbers, size, letters, texts_seen = [], [], 0, np.zeros(256, np.int64), 0
        for batch in batches:
            for part in slices(batch["text"]):
                texts, tokens = cm.tokenise(part, None)
                word = tokens.end > tokens.start
                key, n = np.unique(tokens.value[word], return_counts=True)
                keys.append(key)
                numbers.append(n)
                size += len(key)
                letters += np.bincount(texts.data, minlength=256)
                texts_seen += texts.count
                if size > HELD:
                    key, n = merged(keys, numbers)
                    keys, numbers, size = [key], [n], len(key)
                    if size > HELD // 2:
                        yield rows(0, key, n)
                        keys, numbers, size = [], [], 0
        if keys:
            yield rows(0, *merged(keys, numbers))
        yield rows(1, np.arange(256), letters)
        yield rows(2, np.zeros(1), np.array([texts_seen]))

    return training.select("text").mapInArrow(run, "kind long, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _context_counts(training: DataFrame, shared) -> cm.Counts:
    """The table of all slots, summed block by block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = cm.Lexicon(*shared.value)
        tally = cm.Tally(lexicon)
        for batch in batches:
            for part in slices(batch["text"], SLICE):
                tally.add(*cm.tokenise(part, lexicon))
        table = tally.close()
        for block in range(_TABLE // BLOCK):
            part_ = table[:, block * BLOCK:(block + 1) * BLOCK]
            if part_.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([part_.tobytes()], pa.binary())], ["block", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(block: int, sums: np.ndarray) -> pa.RecordBatch:
            odds = cm.log_odds(sums[0].astype(float), sums[1].astype(float)).astype(np.float16)
            met = np.minimum(sums.sum(axis=0), 255).astype(np.uint8)
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([odds.tobytes()], pa.binary()), pa.array([met.tobytes()], pa.binary())], ["block", "odds", "met"])

        now, sums = None, None
        for batch in batches:
            for block, counts in zip(batch["block"].to_pylist(), batch["counts"], strict=True):
                if block != now:
                    if now is not None:
                        yield closed(now, sums)
                    now, sums = block, np.zeros((2, BLOCK), np.int64)
                sums += np.frombuffer(counts.as_buffer(), np.int32).reshape(2, BLOCK)
        if now is not None:
            yield closed(now, sums)

    counted = training.select("text").mapInArrow(count, "block long, counts binary").repartition("block").sortWithinPartitions("block")
    odds, met = np.zeros(_TABLE, np.float16), np.zeros(_TABLE, np.uint8)
    # 3 bytes a slot: bounded by the size of the table.
    for row in counted.mapInArrow(total, "block long, odds binary, met binary").toLocalIterator():
        odds[row.block * BLOCK:(row.block + 1) * BLOCK] = np.frombuffer(row.odds, np.float16)
        met[row.block * BLOCK:(row.block + 1) * BLOCK] = np.frombuffer(row.met, np.uint8)
    return cm.Counts(odds, met)


def _cell_counts(training: DataFrame, shared, rounded) -> DataFrame:
    """Rows (cell, n): the bits of all training texts by gate and rounded inputs, each one's own occurrence taken out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, sums = cm.Lexicon(*shared.value), np.zeros(cm.CELLS, np.int64)
        first = cm.taken_once(cm.both_rounded(rounded.value))
        for batch in batches:
            for part in slices(batch["text"], SLICE):
                texts, tokens = cm.tokenise(part, lexicon)
                sums += np.bincount(cm.cells_of(cm.bits_of(texts, tokens, lexicon), rounded.value, first), minlength=cm.CELLS)
        met = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(sums[met])], ["cell", "n"])

    return training.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def _first_weights(training: DataFrame, shared, table: cm.Counts) -> np.ndarray:
    """The most likely weights for the bits of all training texts."""
    rounded = training.sparkSession.sparkContext.broadcast(cm.rounded_inputs(table))
    # At most CELLS rows, in order, so that sums do not depend on how rows were dealt.
    cells = _cell_counts(training, shared, rounded).orderBy("cell").toArrow()
    rounded.unpersist()
    return cm.fitted_weights(cells["cell"].to_numpy(), cells["n"].to_numpy())


def _base_scores(docs: DataFrame, words: DataFrame, total: int, distinct: int, shared) -> DataFrame:
    """Rows (text_key, n_known, base_score), one for each distinct token sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = cm.Lexicon(*shared.value)
        gains = np.zeros(len(lexicon.counts) + cm.FIRST_WORD)
        gains[lexicon.rank + cm.FIRST_WORD] = np.log10(lexicon.counts + 1.0)
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in slices(batch["text"]):
                texts, tokens = cm.tokenise(part, lexicon)
                key = _text_keys(tokens, texts.count)
                row = number + np.arange(texts.count)
                number += texts.count
                word = tokens.end > tokens.start
                rare = tokens.symbol == cm.ESCAPE
                frequent = word & ~rare
                owner = tokens.text[frequent]
                known = np.bincount(owner, minlength=texts.count) + 0
                gain = np.bincount(owner, gains[tokens.symbol[frequent]], texts.count) if len(owner) else np.zeros(texts.count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(row), pa.nulls(texts.count, pa.int64()), pa.array(known), pa.array(gain)], ["text_key", "row", "word", "n", "gain"])
                order = np.lexsort((tokens.value[rare], tokens.text[rare]))
                value, text = tokens.value[rare][order], tokens.text[rare][order]
                if len(value):
                    first = np.concatenate(([True], (value[1:] != value[:-1]) | (text[1:] != text[:-1])))
                    n = np.diff(np.append(np.flatnonzero(first), len(value)))
                    value, text = value[first], text[first]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[text]), pa.array(row[text]), pa.array(value.view(np.int64)), pa.array(n), pa.array(np.zeros(len(n)))], ["text_key", "row", "word", "n", "gain"])

    parts = docs.select("text").mapInArrow(run, "text_key long, row long, word long, n long, gain double")
    rare = parts.where("word is not null").join(words.select(F.col("key").alias("word"), F.col("n").alias("c")), "word", "left")
    rare = rare.groupBy("text_key", "row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"), F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("gain"))
    frequent = parts.where("word is null").select("text_key", "row", F.col("n").alias("known"), "gain")
    return frequent.union(rare.select("text_key", "row", "known", "gain")).groupBy("text_key", "row").agg(F.sum("known").alias("n_known"), F.sum("gain").alias("gain")).groupBy("text_key").agg(F.max("n_known").alias("n_known"), F.max("gain").alias("gain"))


def _text_keys(tokens: cm.Tokens, count: int) -> np.ndarray:
    """A 64-bit hash of each token sequence."""
    each = mix(tokens.value + mix(tokens.place.astype(U64)))
    begin = np.searchsorted(tokens.text, np.arange(count))
    return mix(np.add.reduceat(each, begin)).view(np.int64) if count else np.zeros(0, np.int64)


def scored(docs: DataFrame, vocabulary: int = VOCABULARY) -> DataFrame:
    """Base and model log10 probability of every document.

    ``docs`` has doc_id and text; other columns are ignored. Learns from the documents that
    are not held out (crc32 of the id's text modulo 7 is 2). Returns one row per row: doc_id,
    held_out, n_tokens (words and one end), n_known (tokens met in training), train_tokens,
    base_score, score, n_bytes (of the lower-cased words with one space after each) and
    bits_per_byte (of the model; null without words).

    A null text counts as empty: its only token is the end. A row without id is learned from.
    Repeated rows are learned from as often as they occur and score alike. Without training
    texts every word is spelled with even odds. No rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    training = docs.where(~held_out())
    context = docs.sparkSession.sparkContext
    counts = written(_word_counts(training), "words")
    words = counts.where("kind = 0")
    sums = {r.kind: (r.rows, r.n) for r in counts.groupBy("kind").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()}
    texts = sums.get(2, (0, 0))[1]
    # Every training text has one end, which is one more distinct token.
    distinct, total = sums.get(0, (0, 0))[0] + (texts > 0), sums.get(0, (0, 0))[1] + texts
    top = words.where(F.col("n") >= LEAST_COUNT).orderBy(F.desc("n"), "key").limit(vocabulary).select("key", "n").toArrow()
    letters = {r.key: r.n for r in counts.where("kind = 1").collect()}
    number = top["n"].to_numpy()
    lexicon = cm.lexicon(top["key"].to_numpy().view(U64), number, texts, int(total - texts - number.sum()), [
        texts if b == cm.CLOSE else letters.get(b, 0) for b in range(256)])
    shared = context.broadcast(tuple(lexicon))
    counted = _context_counts(training, shared)
    table = context.broadcast((counted.odds, counted.met))
    weights = _first_weights(training, shared, counted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, slots = cm.Lexicon(*shared.value), cm.Counts(*table.value)
        for batch in batches:
            for part in slices(batch["text"], SLICE):
                found, tokens = cm.tokenise(part, known)
                score, _ = cm.mixed(cm.bits_of(found, tokens, known), found.count, slots, weights)
                size = np.bincount(tokens.text, np.where(tokens.end > tokens.start, tokens.end - tokens.start + 1, 0), found.count)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(part.first, part.count), pa.array(np.bincount(tokens.text, minlength=found.count)),
                        pa.array(_text_keys(tokens, found.count)), pa.array(score / np.log(10)), pa.array(size.astype(np.int64)),
                        pa.array(-score / np.log(2) / np.maximum(size, 1), mask=size == 0),
                    ],
                    ["doc_id", "n_tokens", "text_key", "score", "n_bytes", "bits_per_byte"],
                )

    rows = docs.mapInArrow(run, "doc_id long, n_tokens long, text_key long, score double, n_bytes long, bits_per_byte double")
    base = _base_scores(docs, words, total, distinct, shared)
    end = (1 if texts else 0, float(np.log10(texts + 1)))
    each = float(np.log10(total + distinct + 1))
    return rows.join(base, "text_key", "left").select(
        "doc_id", held_out().alias("held_out"), "n_tokens", (F.coalesce("n_known", F.lit(0)) + end[0]).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.coalesce("gain", F.lit(0.0)) + end[1] - F.col("n_tokens") * each).alias("base_score"), "score", "n_bytes", "bits_per_byte")
