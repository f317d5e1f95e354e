"""Dimension joins: instrument weights, per-snapshot index level, per-stock statistics.

Weight and statistics tables hold one row per stock; the snapshot-level
aggregate holds one row per snapshot. All are plain joins without hints or
counts: adaptive execution broadcasts a side whose measured size is under the
session's threshold and shuffles (and splits skewed keys) beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_weights(df: DataFrame, weights: DataFrame, how: str = "inner",
                 weight_col: str = "weight") -> DataFrame:
    """Attach the weight (inner join drops stocks without one; ``how="left"`` keeps them)."""
    w = weights.select("stock_id", F.col("weight").alias(weight_col))
    return df.join(w, "stock_id", how)


def add_weighted_wap(df: DataFrame, weight_col: str = "weight") -> DataFrame:
    return df.withColumn("weighted_wap", F.col("wap") * F.col(weight_col))


def add_index_wap(df: DataFrame, weight_col: str = "weight") -> DataFrame:
    """``index_wap`` = sum over stocks of wap * weight in the snapshot, joined back on ``time_id``.

    Partial sums are combined map-side, so a crowded snapshot does not land
    in one task; the join side has one row per snapshot and is broadcast, so that the
    panel stays where it is, also when it is ready first.
    """
    idx = df.groupBy("time_id").agg(F.sum(F.col("wap") * F.col(weight_col)).alias("index_wap"))
    return df.join(F.broadcast(idx), "time_id")
