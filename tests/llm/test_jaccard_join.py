import random

import numpy as np
import pytest

from tachoflow.llm import jaccard_join
from tachoflow.llm.graph import components
from tachoflow.llm.jaccard_join import jaccard_components, word_shingles
from tachoflow.llm.partenum import Bands, signatures
from tachoflow.llm.words import mix


def brute(rows, size, percent):
    sets = [word_shingles(t, size) for _, t in rows]
    name = list(range(len(rows)))

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            met = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * met >= percent * (len(sets[i]) + len(sets[j]) - met):
                name[find(i)] = find(j)
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(i)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [x for x in groups[find(k)] if x is not None]
        out.append((i, len(sets[k]), min(ids) if ids else None))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def near_copies(seed, groups=12, copies=14, length=60):
    """Groups of texts with growing edits, so that similarities lie on both sides of the bound."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        origin = [f"w{rng.randint(0, 4000)}" for _ in range(length + 10 * g)]
        for c in range(copies):
            text = list(origin)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = f"x{rng.randint(0, 9)}"
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_equals_brute_force(spark, size, percent):
    rows = near_copies(size)
    assert result(jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), size, percent)) == brute(rows, size, percent)


def test_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FEW", 1)
    rows = near_copies(9, groups=3, copies=40, length=40)
    assert result(jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85)) == brute(rows, 4, 85)


def test_edges(edge_docs, edge_rows, no_docs):
    rows = [(r[0], r[1]) for r in edge_rows]
    assert result(jaccard_components(edge_docs, 4, 85)) == brute(rows, 4, 85)
    assert result(jaccard_components(no_docs)) == []


def test_every_similar_pair_shares_a_signature():
    rng = np.random.default_rng(3)
    bands = Bands(85)
    for size in (1, 2, 6, 7, 13, 40, 200, 900):
        for _ in range(40):
            a = np.unique(mix(rng.integers(0, 1 << 60, size).astype(np.uint64)) >> np.uint64(10))
            apart = int(bands.most_apart[bands.of(np.array([len(a)]))[0]])
            b = np.unique(np.concatenate([a[rng.integers(0, apart // 2 + 1):], mix(rng.integers(0, 1 << 60, rng.integers(0, apart // 2 + 1)).astype(np.uint64)) >> np.uint64(10)]))
            met = len(np.intersect1d(a, b))
            if 100 * met < 85 * (len(a) + len(b) - met):
                continue
            one, _ = signatures(a, np.zeros(len(a), np.int64), 1, bands)
            two, _ = signatures(b, np.zeros(len(b), np.int64), 1, bands)
            assert len(np.intersect1d(one, two))


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (3, 1), (3, 3), (7, None), (8, 9), (9, 10), (10, 11), (11, 12)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in rows} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (8, 8), (9, 8), (10, 8), (11, 8), (12, 8)}
