"""Rules of the test tables (FIXTURES.md): weights of the listed suppliers and prediction columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auctide.sources.snapshots import table


def weights_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of the suppliers: none for ``stock_id % 10 == 9``, else ``(1 + stock_id % 7) / 1000``."""
    ids = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("stock_id")).distinct()
    return (ids.filter(F.col("stock_id") % 10 != 9)
            .select("stock_id", ((1 + F.col("stock_id") % 7) / F.lit(1000.0)).alias("weight")))


N_PREDICTIONS = 6


def predictions_by_rule(snap: DataFrame, n: int = N_PREDICTIONS) -> DataFrame:
    """``p_k = coalesce(target, 0) + k * (wap - 1) * 100`` for k = 1..n, with volume for zero_sum."""
    t0 = F.coalesce(F.col("target"), F.lit(0.0))
    cols = {f"p{k}": t0 + F.lit(k) * (F.col("wap") - 1) * 100 for k in range(1, n + 1)}
    return snap.select("stock_id", "time_id", "date_id", "target",
                       (F.col("bid_size") + F.col("ask_size")).alias("volume"), *cols.values()) \
        .toDF("stock_id", "time_id", "date_id", "target", "volume", *cols.keys())
