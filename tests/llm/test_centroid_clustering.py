import hashlib
import math
import random

import numpy as np
import pytest

from tachoflow.llm.centroid_clustering import candidates, cells_of, centroid_clusters, lookup, pack, unpack

SCHEMA = "vec_id long, embedding array<float>, cluster string, key int, distance double"


def _plain(rows, k=40, rounds=5):
    """The same by exhaustive search in Python's whole numbers."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in e]) for i, e in rows
            if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    ranked = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    points = [v for _, v in ranked[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        points = [[sum(x) // len(groups[c]) for x in zip(*groups[c])] if c in groups else p for c, p in enumerate(points)]
    final = [(i, *near(v)[::-1]) for i, v in kept]
    per = {c: sum(d for _, x, d in final if x == c) for _, c, _ in final}
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted(((i, c, d, per[c], sum(per.values()), digest[c]) for i, c, d in final), key=repr)


def _frame(spark, rows):
    return spark.createDataFrame([(i, e, "x", 1, 0.5) for i, e in rows], SCHEMA)


def _got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def _vectors(seed, n, groups, spread):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(groups)]
    return [(i, [m + rng.gauss(0, spread) for m in middles[i % groups]]) for i in range(n)]


@pytest.mark.parametrize("groups, spread", [(5, 0.05), (1, 0.4)])
def test_equals_exhaustive_search(spark, groups, spread):
    rows = _vectors(groups, 300, groups, spread)
    hot = rows[7][1]
    rows += [(1000 + i, hot) for i in range(150)] + [(None, rows[3][1]), (5, rows[5][1]), (5, rows[5][1])]
    rows += [(2000, None), (2001, []), (2002, hot[:63]), (2003, [*hot[:63], None]), (2004, [*hot[:63], float("nan")]), (2005, [*hot[:63], float("inf")])]
    assert _got(centroid_clusters(_frame(spark, rows).repartition(3))) == _plain(rows)


def test_ties_and_empty_clusters(spark):
    """Copies of few vectors: many centroids are the same point, and the smaller number takes all."""
    rows = [(i, [float(i % 3)] * 64) for i in range(90)]
    got = _got(centroid_clusters(_frame(spark, rows)))
    assert got == _plain(rows) and len({r[1] for r in got}) == 3


def test_few_and_far_vectors(spark):
    rows = [(1, [0.0] * 64), (2, [1e5, *[-1e5] * 63]), (3, [200.0] * 64)]
    assert _got(centroid_clusters(_frame(spark, rows))) == _plain(rows)
    huge = [(1, [3e38] * 64), (2, [-3e38] * 64), (3, [0.0] * 64)]
    got = {r.vec_id: r for r in centroid_clusters(_frame(spark, huge)).collect()}
    assert {i: r.distance for i, r in got.items()} == {1: 0, 2: 0, 3: 0}


def test_empty_table(spark):
    df = centroid_clusters(_frame(spark, []))
    assert df.collect() == [] and dict(df.dtypes)["cluster"] == "int"
    assert centroid_clusters(_frame(spark, [(1, None)])).collect() == []


def test_intervals_hold_the_nearest_centroid():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-300, 300, (2000, 64))
    points = rng.integers(-300, 300, (40, 64))
    cells = cells_of(vectors[:200], vectors.min(axis=0), vectors.max(axis=0))
    numbers = cells.number(vectors)
    assert (unpack(pack(numbers)) == numbers).all() and pack(numbers).shape == (2000, 48)
    d = np.arange(64)
    assert (cells.low[d, numbers] <= vectors).all() and (vectors <= cells.high[d, numbers]).all()
    open_ = candidates(numbers, lookup(cells, points))
    distance = ((vectors[:, None, :] - points) ** 2).sum(axis=2)
    assert open_[distance == distance.min(axis=1)[:, None]].all()
    # The approximation decides or narrows: far fewer centroids are left than there are.
    assert open_.sum(axis=1).mean() < 10
