import re
import tracemalloc
from collections import Counter
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from tachoflow.llm.decontamination import Sketches, _matches
from tachoflow.llm.pieces import Encoder, Vocabulary
from tachoflow.llm.sentencepiece_codec import MODEL
from tachoflow.llm.tables import BATCH_BYTES, giving_back, release, small_batches
from tests.llm.conftest import DOCS, words
from tests.llm.test_jaccard_join import brute


def _rows(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def _frame(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    return docs.selectExpr("*", "1 as kept", "'x' as component_id", "2 as n", "3 as n_shingles", "4 as item_id", "5 as first", "6 as stays", "7 as rows")


def test_near_duplicates_lose_no_text(spark):
    a, b, c, d, e = (words(700 + k, 60) for k in range(5))
    near = " ".join([*c.split()[:58], "other", "end"])
    rows = [(1, a), (1, b), (2, b), (None, a), (None, a), (3, c), (3, c), (4, near), (None, d), (None, e), (None, e), (5, None), (None, ""), (6, ""), (6, "")]
    got = corpus_pipeline.near_duplicates(spark, _frame(spark, rows), "")
    assert got.columns == list(corpus_pipeline.COLUMNS)
    assert _rows(got) == Counter([(1, a), (1, b), (3, c), (None, d), (None, e), (5, None), (None, ""), (6, ""), (6, "")])


def test_near_duplicates_keep_one_row_a_group(spark):
    """Against groups of all rows, told apart by their place."""
    rows = []
    for g in range(8):
        text = words(800 + g, 80).split()
        for c in range(5):
            own = list(text)
            for k in range(c if g % 2 else 0):
                own[7 * k] = f"changed{c}"
            rows.append((None if (g + c) % 4 == 0 else (g * c) % 9, " ".join(own)))
    groups = brute([(k, t) for k, (_, t) in enumerate(rows)], 5, 80)
    parts = {}
    for place, _, name in groups:
        parts.setdefault(name, []).append(rows[place])
    got = _rows(corpus_pipeline.near_duplicates(spark, _frame(spark, rows), ""))
    assert sum(got.values()) == len(parts) < len(rows)
    for part in parts.values():
        ids = [i for i, _ in part if i is not None]
        kept = [r for r in got if r in part and (r[0] == min(ids) if ids else r[0] is None)]
        assert kept


def test_decisions_are_made_by_row(spark, tmp_path):
    good, other, junk = words(900, 120), words(901, 120), "too short"
    passage = words(902, 40)
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, good), (None, junk), (None, None), (7, other), (7, junk), (8, good), (8, good)]
    kept = _rows(corpus_pipeline.quality_rules(spark, _frame(spark, rows), ""))
    assert kept == Counter([(None, good), (7, other), (8, good), (8, good)])
    leaked = f"{other} {passage}"
    rows = [(None, good), (None, leaked), (7, other), (7, leaked), (9, None), (9, ""), (10, good), (10, good)]
    kept = _rows(corpus_pipeline.decontamination(spark, _frame(spark, rows), str(tmp_path)))
    assert kept == Counter([(None, good), (7, other), (9, None), (9, ""), (10, good), (10, good)])


def test_small_batches_bound_what_a_worker_holds(spark):
    """40 MB of texts reach a step in batches of a few MB, and the session is as before afterwards."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    docs = spark.range(0, 8000, numPartitions=2).select(F.repeat(F.lit("words "), 900).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    with small_batches(spark):
        found = [r.n for r in docs.mapInArrow(giving_back(sizes), "n long").collect()]
    assert sum(found) > 40e6 and max(found) < 1.5 * BATCH_BYTES
    assert spark.conf.get(key, None) == before


def test_worker_gives_memory_back(spark):
    """What a step has freed is no longer held by the worker that the next step gets."""
    def run(batches):
        for batch in batches:
            kept = [bytearray(50_000) for _ in range(4000)]
            last = kept[-1]
            del kept
            yield batch.slice(0, len(last) and 1)

    def held(batches):
        for batch in batches:
            kb = int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1])
            yield pa.RecordBatch.from_arrays([pa.array([kb])], ["n"])

    one = spark.range(0, 1, numPartitions=1)
    one.mapInArrow(giving_back(run), "id long").collect()
    assert one.mapInArrow(held, "n long").first().n < 150_000


def test_encoding_holds_no_batch_of_segments():
    text = " ".join(words(k % 40, 5000) for k in range(40))
    encoder = Encoder(Vocabulary(MODEL))
    encoder.encode([text])
    tracemalloc.start()
    try:
        got = encoder.encode([text] * 8)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # The segments of one text, not of all, beside the ids.
    assert peak < 30e6 + sum(x.nbytes for x in got) * 2


def test_release_reaches_every_core(spark):
    """Executors give their heap back too: one task for each core asks for it."""
    context = spark.sparkContext
    context.setJobGroup("given back", "release")
    try:
        release(spark)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("given back") for s in tracker.getJobInfo(j).stageIds]
    assert [tracker.getStageInfo(s).numTasks for s in stages] == [context.defaultParallelism]


def test_decontamination_works_on_small_slices():
    """Memory beside the texts does not grow with a batch of them."""
    text = words(50, 20_000).encode()
    sketches = Sketches([(1, words(51, 40))], 5, 80)
    peak = []
    for n in (5, 20):
        ids, plain = pa.array(range(n)), [text] * n
        list(_matches(ids, plain[:1], sketches, 5, 80))
        tracemalloc.start()
        try:
            list(_matches(ids, plain, sketches, 5, 80))
            peak.append(tracemalloc.get_traced_memory()[1])
        finally:
            tracemalloc.stop()
    assert peak[1] < 2 * peak[0]
