"""Centroid clustering over a vector-approximation file.

Every vector is turned into whole numbers and written once, beside an approximation of BITS
bits per component: the number of the cell it lies in. Cell borders are quantiles of a
bounded sample, which decides how often full vectors are read, never the result.

A round needs the assignment under the last and under the new centroids. For each set of
centroids a lookup table (component, cell, centroid) holds the least and the greatest
contribution to a distance; summed over the components of an approximation they enclose the
distance to every centroid. Distances are taken less the distance to the middle of all
centroids, which is the same for each of them: what all share then cancels out and the
intervals are narrow. Where only one centroid's interval reaches below all upper ends, it is
the nearest one. Full vectors are fetched, by a join on their key, only where several
intervals overlap under either set or where the nearest centroid changed, since only those
move the sums that the new centroids are made from. All sums are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tachoflow.llm.tables import broadcast_if_small, written

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SEED = "2:"
#: Bits of a cell number. Four numbers are packed into three bytes.
BITS = 6
#: Vectors that the cell borders are taken from, those of the smallest hash (bound of the sample).
SAMPLE_VECTORS = 4096
#: Components are held to this size, so that a distance of 64 of them fits a long.
LARGEST = 1 << 27
#: Rows worked on at a time.
ROWS = 4096

RESULT_DDL = "vec_id long, cluster int, distance long"


class Cells(NamedTuple):
    """Least and greatest value of every cell: arrays (component, cell)."""

    low: np.ndarray
    high: np.ndarray

    def number(self, vectors: np.ndarray) -> np.ndarray:
        """Cell of every component."""
        out = np.empty(vectors.shape, np.uint8)
        for d in range(vectors.shape[1]):
            out[:, d] = np.searchsorted(self.low[d], vectors[:, d], "right") - 1
        return out


def cells_of(sample: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> Cells:
    """Cells whose borders part the sample evenly; the outer ones reach to the given ends."""
    n, last = 1 << BITS, np.iinfo(np.int64).max
    low = np.full((len(least), n), last, np.int64)
    high = np.full((len(least), n), last, np.int64)
    ranked = np.sort(sample, axis=0)
    at = (np.arange(1, n) * len(sample)) // n
    for d in range(len(least)):
        borders = np.unique(np.concatenate(([least[d]], ranked[at, d])))
        low[d, :len(borders)] = borders
        high[d, :len(borders)] = np.concatenate((borders[1:] - 1, [greatest[d]]))
    return Cells(low, high)


def pack(cells: np.ndarray) -> np.ndarray:
    """Six bits of every cell number, four numbers in three bytes."""
    a, b, c, d = (cells[:, k::4] for k in range(4))
    return np.stack([a << 2 | b >> 4, b << 4 | c >> 2, c << 6 | d], axis=2).astype(np.uint8).reshape(len(cells), -1)


def unpack(packed: np.ndarray) -> np.ndarray:
    x, y, z = (packed[:, k::3] for k in range(3))
    return np.stack([x >> 2, (x & 3) << 4 | y >> 4, (y & 15) << 2 | z >> 6, z & 63], axis=2).reshape(len(packed), -1)


def lookup(cells: Cells, centroids: np.ndarray) -> np.ndarray:
    """Array (component, cell, 2 * centroids): least, then greatest contribution to each distance.

    A contribution is (x - c)² - (x - m)² with m the middle of the centroids: linear in x, so
    its extremes lie at the ends of the cell.
    """
    middle = centroids.sum(axis=0) // len(centroids)
    used = cells.low < np.iinfo(np.int64).max

    def contribution(x: np.ndarray) -> np.ndarray:
        x = np.where(used, x, 0)[:, :, None]
        c, m = centroids.T[:, None, :], middle[:, None, None]
        return (x - c) ** 2 - (x - m) ** 2

    one, other = contribution(cells.low), contribution(cells.high)
    table = np.concatenate([np.minimum(one, other), np.maximum(one, other)], axis=2)
    most = np.abs(table).max(axis=(1, 2)).sum()
    return table.astype(np.int32) if most < 1 << 31 else table


def candidates(numbers: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which centroids may be the nearest to each approximated vector."""
    total = table[0][numbers[:, 0]]
    for d in range(1, len(table)):
        total += table[d][numbers[:, d]]
    k = total.shape[1] // 2
    return total[:, :k] <= total[:, k:].min(axis=1)[:, None]


def nearest(vectors: np.ndarray, open_: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest open centroid; the smaller number on a tie."""
    row, c = np.nonzero(open_)
    gap = vectors[row] - centroids[c]
    distance = np.full(open_.shape, np.iinfo(np.int64).max)
    distance[row, c] = np.einsum("ij,ij->i", gap, gap)
    best = distance.argmin(axis=1)
    return best, distance[np.arange(len(best)), best]


def _bytes_of(column: pa.Array, dtype: type) -> np.ndarray:
    """Rows of a binary column whose values are all of one length."""
    if not len(column):
        return np.zeros((0, 0), dtype)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    body = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return body.view(dtype).reshape(len(column), -1)


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def kept_vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id and v, the whole-number components of the vectors that have all of them, finite."""
    vector = F.col(vector_column).cast("array<double>")
    sound = (F.size(vector) == DIMENSIONS) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.greatest(F.least(F.floor(x * SCALE), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))
    return df.where(sound).select(F.col(id_column).cast("long").alias("vec_id"), whole.alias("v"))


class Approximation:
    """The written vectors and their approximations, with the passes over them."""

    def __init__(self, spark: SparkSession, vectors: DataFrame, least: np.ndarray, greatest: np.ndarray, sample: np.ndarray) -> None:
        self.spark = spark
        self.cells = cells_of(sample, least, greatest)
        small = max(int(np.abs(least).max()), int(np.abs(greatest).max())) < 1 << 15
        self.dtype = dtype = np.int16 if small else np.int32
        shared = spark.sparkContext.broadcast(self.cells)

        def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = shared.value
            for batch in _pieces(batches):
                v = batch["v"].flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [batch["key"], batch["vec_id"], _binary(pack(cells.number(v))), _binary(v.astype(dtype))], ["key", "vec_id", "cells", "vector"])

        # The key is made in the job that writes it and then read only.
        keyed = vectors.withColumn("key", F.monotonically_increasing_id())
        self.table = written(keyed.mapInArrow(approximate, "key long, vec_id long, cells binary, vector binary"), "vector-file")

    def _sums(self, rows: DataFrame, moves) -> dict[int, list[int]]:
        """Sums by cluster of what each task's ``moves`` add: components, then the number of vectors."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in _pieces(batches):
                part = moves(batch)
                total = part if total is None else total + part
            if total is not None:
                k, width = total.shape
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(k), width)), pa.array(np.tile(np.arange(width), k)), pa.array(total.ravel())], ["cluster", "place", "value"])

        found: dict[int, list[int]] = {}
        # At most centroids * (components + 1) rows.
        for r in rows.mapInArrow(run, "cluster long, place long, value long").groupBy("cluster", "place").agg(F.sum("value").alias("value")).collect():
            found.setdefault(r.cluster, [0] * (DIMENSIONS + 1))[r.place] = r.value
        return found

    def first_sums(self, centroids: np.ndarray) -> dict[int, list[int]]:
        """Sums of all vectors under the first centroids."""
        shared, dtype = self.spark.sparkContext.broadcast((lookup(self.cells, centroids), centroids)), self.dtype

        def moves(batch: pa.RecordBatch) -> np.ndarray:
            table, points = shared.value
            vectors = _bytes_of(batch["vector"], dtype).astype(np.int64)
            best, _ = nearest(vectors, candidates(unpack(_bytes_of(batch["cells"], np.uint8)), table), points)
            return _moved(vectors, best, len(points))

        return self._sums(self.table.select("cells", "vector"), moves)

    def moved_sums(self, last: np.ndarray, new: np.ndarray) -> dict[int, list[int]]:
        """What the sums gain and lose from the last to the new centroids."""
        shared, dtype = self.spark.sparkContext.broadcast((lookup(self.cells, last), lookup(self.cells, new), last, new)), self.dtype

        def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            before, after, _, _ = shared.value
            for batch in _pieces(batches):
                numbers = unpack(_bytes_of(batch["cells"], np.uint8))
                one, two = candidates(numbers, before), candidates(numbers, after)
                fetch = (one.sum(axis=1) > 1) | (two.sum(axis=1) > 1) | (one.argmax(axis=1) != two.argmax(axis=1))
                yield pa.RecordBatch.from_arrays([batch["key"].filter(pa.array(fetch))], ["key"])

        def moves(batch: pa.RecordBatch) -> np.ndarray:
            before, after, old, points = shared.value
            vectors = _bytes_of(batch["vector"], dtype).astype(np.int64)
            numbers = unpack(_bytes_of(batch["cells"], np.uint8))
            was, _ = nearest(vectors, candidates(numbers, before), old)
            now, _ = nearest(vectors, candidates(numbers, after), points)
            changed = was != now
            return _moved(vectors[changed], now[changed], len(points)) - _moved(vectors[changed], was[changed], len(points))

        keys = broadcast_if_small(written(self.table.select("key", "cells").mapInArrow(wanted, "key long"), "fetch"), 16)
        return self._sums(self.table.select("key", "cells", "vector").join(keys, "key", "left_semi").select("cells", "vector"), moves)

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """Nearest centroid and its distance for every vector."""
        shared, dtype = self.spark.sparkContext.broadcast((lookup(self.cells, centroids), centroids)), self.dtype

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, points = shared.value
            for batch in _pieces(batches):
                open_ = candidates(unpack(_bytes_of(batch["cells"], np.uint8)), table)
                best, distance = nearest(_bytes_of(batch["vector"], dtype).astype(np.int64), open_, points)
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], pa.array(best.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

        return self.table.select("vec_id", "cells", "vector").mapInArrow(run, RESULT_DDL)


def _moved(vectors: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Sums of the components and the number of vectors of each cluster."""
    out = np.zeros((k, vectors.shape[1] + 1), np.int64)
    order = np.argsort(cluster, kind="stable")
    ranked = cluster[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(ranked) else np.zeros(0, np.int64)
    if len(first):
        out[ranked[first], :-1] = np.add.reduceat(vectors[order], first, axis=0)
        out[:, -1] = np.bincount(cluster, minlength=k)
    return out


def centroid_clusters(
    df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
) -> DataFrame:
    """Cluster, squared distance, inertia and final centroid of every vector.

    Kept are vectors of exactly DIMENSIONS components, none null or not finite; a component x
    becomes floor(SCALE * x), held to ±LARGEST. The first centroids are the k vectors of
    smallest hash of their id (a null id counts as an empty one; equal hashes: smaller
    components first; fewer vectors make fewer centroids). Each round assigns every vector to
    the nearest centroid (ties: smaller number) and moves each centroid that has vectors to
    the floor of their mean. Returns one row per kept vector: vec_id, cluster, distance,
    cluster_inertia, inertia (null past a long), centroid_sha256. Repeated rows and ids count
    and come out each. Other columns are ignored; without kept vectors the result is empty.
    """
    spark = df.sparkSession
    vectors = kept_vectors(df, id_column, vector_column)
    digest = F.sha2(F.concat(F.lit(SEED), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = vectors.select(digest.alias("digest"), "v").orderBy("digest", "v").limit(max(SAMPLE_VECTORS, k)).collect()
    shape = RESULT_DDL + ", cluster_inertia long, inertia long, centroid_sha256 string"
    if not chosen:
        return spark.createDataFrame([], shape)
    sample = np.array([r.v for r in chosen], np.int64)
    centroids = sample[:k].copy()
    # One row per component.
    ends = vectors.select(F.posexplode("v").alias("place", "x")).groupBy("place").agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("place").collect()
    file = Approximation(spark, vectors, np.array([r.low for r in ends], np.int64), np.array([r.high for r in ends], np.int64), sample)
    sums = [[0] * (DIMENSIONS + 1) for _ in centroids]
    last = None
    for _ in range(rounds):
        gained = file.first_sums(centroids) if last is None else file.moved_sums(last, centroids)
        for c, values in gained.items():
            sums[c] = [a + b for a, b in zip(sums[c], values, strict=True)]
        last = centroids
        centroids = np.array([_mean(total, point) for total, point in zip(sums, centroids.tolist(), strict=True)], np.int64)
    rows = written(file.assigned(centroids), "assigned")
    # At most k rows.
    inertia = rows.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia")).collect()
    parts = [r.cluster_inertia for r in inertia]
    whole = None if None in parts or sum(parts) >= 1 << 63 else sum(parts)
    named = [(r.cluster, r.cluster_inertia, whole, _digest(centroids[r.cluster])) for r in inertia]
    facts = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select(*(c.split()[0] for c in shape.split(", ")))


def _mean(total: Sequence[int], point: Sequence[int]) -> list[int]:
    """Exact floor of the mean, or the point where there is no vector."""
    *values, n = total
    return [v // n for v in values] if n else list(point)


def _digest(point: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, point.tolist())).encode()).hexdigest()
