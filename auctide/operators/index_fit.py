"""Index weights by least squares over the long table of returns.

The index return of a snapshot is regressed, with an intercept, on the returns
of its stocks. The normal equations are never formed: conjugate gradients need
one product with the matrix and one with its transpose per round, and over the
long table ``(time_id, stock_id, ret)`` these are a join and a grouped sum
each. Up to ``VECTORS`` entries the two vectors are broadcast, as Spark does with
a small table of a join, and a round is two jobs over cells that stay in memory;
the sums of the tasks are vectors of that bounded size. Longer vectors are
tables in the shared folder, and the driver sees two sums per round. So neither
a snapshot nor the number of stocks has to fit one row, one task or the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auctide.session import stored

#: Entries of both vectors together up to which they are broadcast (8 MB); task sums that go to the driver directly.
VECTORS, DIRECT = 1_000_000, 32


class IndexFit(NamedTuple):
    """``weights``: stock_id, n_obs, weight, weight_est (rounded); ``r2`` of the rounded weights without the
    intercept; ``slope``: size of the gradient left, as a share of the first; ``rounds``: products made."""

    weights: DataFrame
    r2: float
    slope: float
    rounds: int


def index_weight_regression(returns: DataFrame, index: DataFrame, decimals: int = 3, tol: float = 1e-10,
                            most_rounds: int = 500) -> IndexFit:
    """Weights of the stocks in the index, rounded to ``decimals``; the intercept is fitted, then dropped.

    ``returns``: (time_id, stock_id, ret); ``index``: (time_id, index_ret). Rows with a
    missing return and snapshots with a missing index return are left out; a stock without a
    row in a snapshot adds nothing to it. Columns are scaled to length one, which keeps the
    rounds few; the intercept is handled by centring the products over the snapshots.
    """
    y = index.filter(F.col("index_ret").isNotNull() & ~F.isnan("index_ret")).select("time_id", "index_ret")
    seen = returns.filter(F.col("ret").isNotNull() & ~F.isnan("ret")).join(y.select("time_id"), "time_id", "left_semi")
    stocks = stored(seen.groupBy("stock_id").agg(F.count(F.lit(1)).alias("n_obs"),
                                                 F.sqrt(F.sum(F.col("ret") * F.col("ret"))).alias("length"))
                    .withColumn("length", F.when(F.col("length") > 0, F.col("length")).otherwise(F.lit(1.0))), "fit-stocks")
    cells = stored(seen.join(stocks.select("stock_id", "length"), "stock_id")
                   .select("time_id", "stock_id", (F.col("ret") / F.col("length")).alias("a")), "fit-cells")
    y = stored(y.join(cells.select("time_id").distinct(), "time_id"), "fit-index")
    n, mean = y.agg(F.count(F.lit(1)), F.avg("index_ret")).first()
    if not n:
        return IndexFit(stocks.select("stock_id", "n_obs", F.lit(0.0).alias("weight"), F.lit(0.0).alias("weight_est")),
                        float("nan"), 0.0, 0)

    solve = _by_broadcast if n + stocks.count() <= VECTORS and y.select("time_id").distinct().count() == n else _by_tables
    side, left, rounds = solve(cells, stocks, y, mean, tol, most_rounds)
    found = stored(stocks.join(side, "stock_id")
                   .withColumn("weight", F.col("w") / F.col("length"))
                   .select("stock_id", "n_obs", "length", "weight", F.round("weight", decimals).alias("weight_est")),
                   "fit-weights")
    fitted = (cells.join(found.select("stock_id", "length", "weight_est"), "stock_id").groupBy("time_id")
              .agg(F.sum(F.col("a") * F.col("length") * F.col("weight_est")).alias("p")).join(y, "time_id"))
    e, d = F.col("index_ret") - F.col("p"), F.col("index_ret") - F.lit(mean)
    rest, total = fitted.agg(F.sum(e * e), F.sum(d * d)).first()
    return IndexFit(found.drop("length"), 1.0 - rest / total if total else float("nan"), math.sqrt(left), rounds)


def _by_tables(cells: DataFrame, stocks: DataFrame, y: DataFrame, mean: float, tol: float,
               most_rounds: int) -> tuple[DataFrame, float, int]:
    """``stock_id, w``; the squared gradient left, as a share of the first; rounds."""
    def from_snapshots(r: DataFrame, old: DataFrame) -> DataFrame:
        """``old`` with ``s``: the product of the transpose with the vector ``r`` over snapshots."""
        s = cells.join(r, "time_id").groupBy("stock_id").agg(F.sum(F.col("a") * F.col("r")).alias("s"))
        return stored(old.join(s, "stock_id"), "fit-side")

    def to_snapshots(p: DataFrame, old: DataFrame) -> DataFrame:
        """``old`` with ``q``: the product with the vector ``p`` over stocks."""
        q = cells.join(p, "stock_id").groupBy("time_id").agg(F.sum(F.col("a") * F.col("p")).alias("q"))
        return stored(old.join(q, "time_id"), "fit-snapshots")

    r = y.select("time_id", (F.col("index_ret") - F.lit(mean)).alias("r"))
    side = from_snapshots(r, stocks.select("stock_id", F.lit(0.0).alias("w"), F.lit(0.0).alias("p")))
    first = slope = side.agg(F.sum(F.col("s") * F.col("s"))).first()[0]
    side, rounds = side.withColumn("p", F.col("s")), 0
    while slope > first * tol * tol and rounds < most_rounds:
        both = to_snapshots(side.select("stock_id", "p"), r)
        middle = both.agg(F.avg("q")).first()[0]
        centred = F.col("q") - F.lit(middle)
        step = slope / both.agg(F.sum(centred * centred)).first()[0]
        r = both.select("time_id", (F.col("r") - F.lit(step) * centred).alias("r"))
        side = from_snapshots(r, side.select("stock_id", (F.col("w") + F.lit(step) * F.col("p")).alias("w"), "p"))
        before, slope = slope, side.agg(F.sum(F.col("s") * F.col("s"))).first()[0]
        side = side.withColumn("p", F.col("s") + F.lit(slope / before) * F.col("p"))
        rounds += 1
    return side.select("stock_id", "w"), slope / first if first else 0.0, rounds


def _by_broadcast(cells: DataFrame, stocks: DataFrame, y: DataFrame, mean: float, tol: float,
                  most_rounds: int) -> tuple[DataFrame, float, int]:
    """As ``_by_tables``; ``time_id`` is a key of ``y``, and both vectors are short."""
    spark = cells.sparkSession
    sc = spark.sparkContext
    index = y.toPandas().sort_values("time_id")
    ids = stocks.select("stock_id").join(cells.select("stock_id").distinct(), "stock_id").toPandas().sort_values("stock_id")
    keys = sc.broadcast((index["time_id"].to_numpy(), ids["stock_id"].to_numpy()))

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A batch of cells as arrays of places and values."""
        for f in frames:
            at = [np.searchsorted(k, f[c].to_numpy()).astype(np.int32) for k, c in zip(keys.value, ("time_id", "stock_id"))]
            yield pd.DataFrame({"i": [at[0].tobytes()], "j": [at[1].tobytes()], "a": [f["a"].to_numpy(np.float64).tobytes()]})

    blocks = cells.mapInPandas(pack, "i binary, j binary, a binary").rdd.map(
        lambda r: (np.frombuffer(r.i, np.int32), np.frombuffer(r.j, np.int32), np.frombuffer(r.a)))
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    depth = 1 if blocks.getNumPartitions() <= DIRECT else 2

    def product(vector: np.ndarray, size: int, over: int) -> np.ndarray:
        """With the vector over stocks (``over`` 1), or of the transpose with one over snapshots (0)."""
        shared = sc.broadcast(vector)

        def part(found):
            total = np.zeros(size)
            for b in found:
                total += np.bincount(b[1 - over], weights=b[2] * shared.value[b[over]], minlength=size)
            yield total
        out = blocks.mapPartitions(part).treeReduce(np.add, depth)
        shared.unpersist()
        return out

    r = index["index_ret"].to_numpy(np.float64) - mean
    w = np.zeros(len(ids))
    s = product(r, len(w), 0)
    p, rounds = s, 0
    first = slope = float(s @ s)
    while slope > first * tol * tol and rounds < most_rounds:
        q = product(p, len(r), 1)
        q = q - q.mean()
        step = slope / float(q @ q)
        w, r = w + step * p, r - step * q
        s = product(r, len(w), 0)
        before, slope = slope, float(s @ s)
        p = s + slope / before * p
        rounds += 1
    blocks.unpersist()
    side = spark.createDataFrame(ids.assign(w=w), cells.select("stock_id").withColumn("w", F.lit(0.0)).schema)
    return side, slope / first if first else 0.0, rounds
