import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tachoflow.llm import subwords as module, toxicity
from tachoflow.llm.subwords import EDGES, SIZES, bags, lowered, subwords
from tachoflow.llm.toxicity import averaged, margins, toxicity_scores, train
from tachoflow.llm.words import slices

DOCS, LABELS = "doc_id long, text string, score int, toxic string", "doc_id long, toxic int, text string"
CLEAN = "the river runs past old mills and quiet fields where people walk in summer evening light".split()
BAD = "wretched vermin gutless rotten".split()


def _plain_subwords(text):
    """(kind, subword) of every word, with the word itself."""
    out = []
    for word in re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", text):
        word = "".join(c.lower() if c.isascii() or "À" <= c <= "Þ" and c != "×" else c for c in word)
        grams = [("whole", word)]
        for n in SIZES:
            grams += [("in", word[i:i + n]) for i in range(len(word) - n + 1)]
        for n in EDGES:
            if len(word) >= n:
                grams += [("first", word[:n]), ("last", word[-n:])]
        out.append((word, grams))
    return out


TEXTS = ["", "  \n.!", "a", "Idiot, idiot! IDIOTS", "Éa ÜBER×x naïve 🎉ok9", "ab" * 40, "x y x y x", "日本語 テスト"]


@pytest.mark.parametrize("text", TEXTS)
def test_subwords_equal_those_of_strings(text):
    texts = next(slices(pa.array(["zz", text, "yy"])))
    bucket, weight, owner = subwords(texts, bits=40)
    got = Counter(bucket[owner == 1].tolist())
    words = _plain_subwords(text)
    names = Counter(g for _, grams in words for g in grams)
    # One bucket per subword: as many, equally often.
    assert sorted(got.values()) == sorted(names.values())
    times = Counter(w for w, _ in words)
    expected = sum(len(grams) / math.sqrt(times[w]) for w, grams in words)
    assert weight[owner == 1].sum() == pytest.approx(expected)
    text_, _, summed = bags(texts)
    assert summed[text_ == 1].sum() == pytest.approx(expected)


def test_blocks_make_the_same_subwords(monkeypatch):
    texts = next(slices(pa.array([*TEXTS, " ".join(CLEAN * 30), "x" * 300])))
    whole = [sorted(zip(*(c.tolist() for c in subwords(texts)), strict=True)), [c.tolist() for c in bags(texts)]]
    monkeypatch.setattr(module, "BLOCK_BYTES", 40)
    got = [sorted(zip(*(c.tolist() for c in subwords(texts)), strict=True)), [c.tolist() for c in bags(texts)]]
    assert got[0] == whole[0] and got[1][:2] == whole[1][:2] and got[1][2] == pytest.approx(whole[1][2])
    monkeypatch.setattr(module, "LONGEST", 100)
    assert len(subwords(next(slices(pa.array(["x" * 300]))))[0]) == 3 * len(subwords(next(slices(pa.array(["x" * 100]))))[0])


def test_same_subword_same_bucket():
    texts = next(slices(pa.array(["idiot", "IDIOT", "idiotic", "midi"])))
    bucket, _, owner = subwords(texts, bits=40)
    of = [set(bucket[owner == k].tolist()) for k in range(4)]
    assert of[0] == of[1]
    plain = [{g for _, grams in _plain_subwords(t) for g in grams} for t in ("idiot", "idiotic", "midi")]
    assert len(of[0] & of[2]) == len(plain[0] & plain[1]) and len(of[0] & of[3]) == len(plain[0] & plain[2])
    assert bytes(lowered(np.frombuffer("ÀÞ×ß.Z".encode(), np.uint8))) == "àþ×ß z".encode()


def _corpus(n, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = [rng.choice(CLEAN) for _ in range(rng.randint(20, 80))]
        if toxic:
            for _ in range(len(words) // 8 + 2):
                words[rng.randrange(len(words))] = rng.choice(BAD)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = _corpus(600)
    extra = [(9001, "a quiet wrettched vermiin walked gutles past rottenn mills"), (9002, "a quiet evening walk past old mills and rotating vermilion"),
             (9003, None), (9004, ""), (9005, "!!"), (9006, docs[0][1]), (9006, docs[0][1]), (None, docs[1][1]), (9007, "wretched " * 200_000)]
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in docs + extra], DOCS)
    rows = [(i, y, "vermin") for i, y in labels] + [(9002, 7, ""), (9001, None, ""), (None, 1, ""), (1, 0, ""), (70000, 1, "")]
    return docs, dict(labels), toxicity_scores(df, spark.createDataFrame(rows, LABELS)).collect()


def test_held_out_accuracy(scored):
    docs, labels, rows = scored
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None and r.doc_id < 9000}
    assert len(by_id) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in by_id.items())
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    held = [(r.predicted, labels[i]) for i, r in by_id.items() if r.held_out]
    assert len(held) > 80 and sum(p == y for p, y in held) / len(held) > 0.97


def test_misspellings_and_edge_cases(scored):
    docs, _, rows = scored
    of = defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
    assert of[9001][0].score > 0.5 > of[9002][0].score
    empty = of[9003][0].score
    assert empty < 0.5 and of[9004][0].score == empty == of[9005][0].score
    assert len(of[9006]) == 2 and {r.score for r in of[9006]} == {of[0][0].score}
    assert of[None][0].score == of[1][0].score and of[None][0].held_out
    # Occurrences of one word weigh the root of their number.
    assert of[9007][0].score > 0.5


def test_labels_of_held_out_ids_are_not_learned_from(spark):
    docs, labels = _corpus(300)
    df = spark.createDataFrame([(i, t, 0, "") for i, t in docs], DOCS)

    def score(flip):
        turned = [(i, 1 - y if flip and zlib.crc32(str(i).encode()) % 5 == 0 else y, "") for i, y in labels]
        return sorted((r.doc_id, r.score) for r in toxicity_scores(df, spark.createDataFrame(turned, LABELS)).collect())

    assert score(False) == score(True)


def test_empty_tables(spark):
    no_docs, no_labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    some = spark.createDataFrame([(1, "wretched vermin", 0, "")], DOCS)
    assert toxicity_scores(no_docs, no_labels).collect() == []
    row = toxicity_scores(some, no_labels).first()
    assert row.score < 0.5 and row.predicted == 0


def test_sample_is_bounded_in_rows_and_bytes(spark, monkeypatch):
    docs, labels = _corpus(200)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda bag, toxic: seen.append((len(bag), sum(len(b) for b, _ in bag))) or train([], np.zeros(0)))
    toxicity.fit(df, known)
    toxicity.fit(df, known, sample=30)
    toxicity.fit(df, known, entries=2000)
    learnable = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, _ in docs)
    assert seen[0][0] == learnable and seen[1][0] == 30 and seen[2][1] <= 2000 < seen[0][1]


def test_scores_equal_the_softmax_of_the_average():
    docs, labels = _corpus(80)
    texts = next(slices(pa.array([t for _, t in docs])))
    owner, bucket, weight = bags(texts)
    bag = [(bucket[owner == i], averaged(weight[owner == i])) for i in range(texts.count)]
    model = train(bag, np.array([y for _, y in labels]))
    table, bias = model.differences()
    for i, value in enumerate(margins(texts, table, bias)):
        logit = bag[i][1] @ model.embeddings[bag[i][0]] @ model.softmax + model.bias
        assert value == pytest.approx(float(logit[1] - logit[0]), rel=1e-3, abs=1e-3)
