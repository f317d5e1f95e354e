"""Centroid clustering with lower bounds from Ptolemy's inequality.

In Euclidean space any four points obey Ptolemy's inequality, so for a vector
q, a centroid o and two pivots p, s

    d(q, o) >= |d(q, p) d(o, s) - d(q, s) d(o, p)| / d(p, s).

The pivots are the first centroids and stay fixed; every vector's exact squared
distances to them are computed once and stored beside it. A round only needs
the distances of its few centroids to the pivots. Per vector, the centroid with
the smallest bound is measured exactly; all centroids whose bound, rounded
down, does not exceed that distance are measured exactly too, the others cannot
be nearest. Centroids near their first place have almost exact bounds.

Each round is one pass of Spark over the stored vectors; a task returns one sum
per centroid and component, so what the driver sees is ``k * dim`` numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auctide.llm.common import stored
from auctide.llm.integer_vectors import floor_means, integer_vectors, matrix, squares, sums_by

#: Vectors bounded and measured at a time inside a task.
PIECE = 2048
#: Relative slack that covers all rounding of a bound: a few units in the last place of each term.
SLACK = 32 * np.finfo(np.float64).eps
NEVER = np.iinfo(np.int64).max


class Pivots:
    """Pivot points in pairs: each pivot with the one farthest from it."""

    def __init__(self, points: np.ndarray):
        self.points = points
        d = squares(points, points)
        far = d.argmax(axis=1)
        pairs = sorted({(min(p, s), max(p, s)) for p, s in enumerate(far.tolist()) if d[p, s] > 0})
        self.pairs = [(p, s, float(np.sqrt(d[p, s]))) for p, s in pairs]

    def bounds(self, to_pivots: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances of vectors to ``centroids``, never above the true ones.

        ``to_pivots``: exact squared distances of the vectors to the pivots.
        Square roots and products are off by a few units in the last place of
        the products; the slack takes more than that off the difference.
        """
        q, o = np.sqrt(to_pivots.astype(np.float64)), np.sqrt(squares(centroids, self.points).astype(np.float64))
        low = np.zeros((len(q), len(o)))
        for p, s, between in self.pairs:
            a, b = q[:, p, None] * o[None, :, s], q[:, s, None] * o[None, :, p]
            np.maximum(low, (np.abs(a - b) - SLACK * (a + b)) / between, out=low)
        return low * low * (1 - SLACK)


def nearest(points: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray,
            pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector (ties: smaller number), its squared distance, exact measurements made."""
    low = pivots.bounds(to_pivots, centroids)
    rows = np.arange(len(points))
    first = low.argmin(axis=1)
    exact = np.full(low.shape, NEVER)
    exact[rows, first] = ((points - centroids[first]) ** 2).sum(axis=1)
    # the nearest float at or above the exact distance, so that an equal centroid always survives
    high = np.nextafter(exact[rows, first].astype(np.float64), np.inf)
    r, c = np.nonzero((low <= high[:, None]) & (exact == NEVER))
    exact[r, c] = ((points[r] - centroids[c]) ** 2).sum(axis=1)
    best = exact.argmin(axis=1)
    return best, exact[rows, best], len(rows) + len(r)


def _pieces(batches: Iterator[pa.RecordBatch], dim: int, k: int):
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE):
            b = batch.slice(at, PIECE)
            yield b, matrix(b.column("point"), dim), matrix(b.column("to_pivots"), k)


def _with_pivots(points: DataFrame, pivots: Pivots, dim: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = squares(matrix(b.column("point"), dim), pivots.points)
            offsets = pa.array(np.arange(len(d) + 1, dtype=np.int32) * d.shape[1])
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("point"), pa.ListArray.from_arrays(offsets, pa.array(d.ravel()))],
                names=["vec_id", "point", "to_pivots"])

    return points.mapInArrow(run, f"vec_id {dict(points.dtypes)['vec_id']}, point array<int>, to_pivots array<bigint>")


def _round(rows: DataFrame, centroids: np.ndarray, pivots: Pivots) -> np.ndarray:
    """The centroids after one assignment of all rows: task sums, added by Spark."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for _, points, to_pivots in _pieces(batches, dim, len(pivots.points)):
            best, _, _ = nearest(points, to_pivots, centroids, pivots)
            sums += sums_by(best, points, k)
            counts += np.bincount(best, minlength=k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k), dim)), pa.array(np.tile(np.arange(dim), k)),
             pa.array(sums.ravel()), pa.array(np.repeat(counts, dim))], names=["c", "pos", "total", "n"])

    got = (rows.mapInArrow(run, "c long, pos long, total long, n long").filter("n > 0")
           .groupBy("c", "pos").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect())
    sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
    for r in got:
        sums[r.c, r.pos], counts[r.c] = r.total, r.n
    return floor_means(centroids, sums, counts)


def cluster(embeddings: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per kept vector.

    Kept are vectors of exactly ``dim`` components, none null or non-finite;
    component x counts as floor(scale * x). The first centroids are the ``k``
    vectors with the smallest sha256 of ``1:<vec_id>`` (a null id counts as the
    text ``null``; of rows that share an id the smaller vector comes first);
    fewer kept vectors give fewer centroids. Rows that repeat an id or a vector
    are vectors of their own. Ties go to the smaller centroid, an empty one
    stays in place. Other columns are ignored; no kept vector, no rows. A
    component of 2^26 or more after scaling raises: its distances would not fit
    the result.
    """
    kept = integer_vectors(embeddings, scale, "vec_id").filter(F.size("point") == dim)
    order = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = [r.point for r in kept.orderBy(order, "point").select("point").limit(k).collect()]
    if not first:
        return kept.select("vec_id", F.lit(0).alias("cluster"),
                           *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
                           F.lit("").alias("centroid_sha256")).limit(0)
    centroids = np.array(first, np.int64)
    pivots = Pivots(centroids)
    rows = stored(_with_pivots(kept, pivots, dim), "cluster-rows")
    for _ in range(rounds):
        centroids = _round(rows, centroids, pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, points, to_pivots in _pieces(batches, dim, len(pivots.points)):
            best, distance, _ = nearest(points, to_pivots, centroids, pivots)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(best.astype(np.int32)),
                                              pa.array(distance)], names=["vec_id", "cluster", "distance"])

    kind = dict(kept.dtypes)["vec_id"]
    found = stored(rows.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "cluster-found")
    total = found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # k rows at most
    inertia = {r.cluster: r.s for r in total}
    per = found.sparkSession.createDataFrame(
        [(c, s, sum(inertia.values()),
          hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in inertia.items()],
        "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (found.join(F.broadcast(per), F.col("cluster") == F.col("c"))  # k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
