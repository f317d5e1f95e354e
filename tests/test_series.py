"""Chunked per-stock windows equal plain per-stock windows, also with tiny chunks."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from auctide.functions.expr import diff, roll_mean, roll_std
from auctide.operators.series import ffill_columns, stock_windows, tail_per_key


def _panel(spark, seed=3):
    rng = np.random.default_rng(seed)
    rows, t = [], 0
    for date in range(8):
        for stock in range(4):
            n = int(rng.integers(1, 6))  # chunks of 1..5 rows: halos must reach several chunks back
            for j in range(n):
                v = None if rng.random() < 0.2 else float(rng.normal())
                rows.append((stock, date, date * 10 + j, v, float(rng.normal())))
    return spark.createDataFrame(rows, "stock_id int, date_id int, time_id int, x double, y double")


def _stages(w):
    return {"x_l3": F.lag("x", 3).over(w), "y_d2": diff("y", w, 2), "y_m3": roll_mean("y", 3, w)}


def test_stock_windows_equal_plain_window(spark):
    df = _panel(spark)
    w = Window.partitionBy("stock_id").orderBy("time_id")
    plain = df.withColumns(_stages(w))
    st2 = lambda w: {"y_d2_s4": roll_std("y_d2", 4, w)}
    plain = plain.withColumns(st2(w))
    a = plain.orderBy("stock_id", "time_id").toPandas()
    for rows in (1, 2, 7, 512):  # blocks of one date each, of a few, and one block per stock
        chunked = stock_windows(df, [_stages, st2], lookback=5, rows=rows)
        b = chunked.select(*a.columns).orderBy("stock_id", "time_id").toPandas()
        pd.testing.assert_frame_equal(a, b)


def test_blocks_with_crowded_and_thin_dates(spark):
    """A date larger than a block, and blocks smaller than the reach."""
    sizes = [1, 30, 1, 1, 2, 25, 1, 1, 1, 1, 40, 3]
    rows, t = [], 0
    for date, n in enumerate(sizes):
        for _ in range(n):
            rows.append((1, date, t, float(t * t % 17), None if t % 9 else float(t)))
            t += 1
    df = spark.createDataFrame(rows, "stock_id int, date_id int, time_id int, y double, x double")
    w = Window.partitionBy("stock_id").orderBy("time_id")
    st = lambda w: {"y_l12": F.lag("y", 12).over(w), "y_m6": roll_mean("y", 6, w),
                    "x_l9": F.lag("x_ffill", 9).over(w)}
    filled = F.last("x", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    a = df.withColumn("x_ffill", filled).withColumns(st(w)).orderBy("time_id").toPandas()
    for size in (3, 10, 50):
        b = stock_windows(df, [st], 12, ffill=["x"], rows=size).select(*a.columns).orderBy("time_id").toPandas()
        pd.testing.assert_frame_equal(a, b)


def test_halo_is_small(spark, panel):
    """Rows that the windows see beyond the panel's own: under a tenth."""
    seen = stock_windows(panel, [lambda w: {"n": F.count(F.lit(1)).over(w.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))}], 19, keep_block=True)
    per = seen.groupBy("stock_id", "_block").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("own"))
    all_, own = per.agg(F.sum("n"), F.sum("own")).first()
    assert own == panel.count() and own <= all_ < 1.1 * own


def test_ffill_unbounded(spark):
    df = _panel(spark, seed=11)
    got = ffill_columns(df, ["x"]).orderBy("stock_id", "time_id").toPandas()
    pdf = df.orderBy("stock_id", "time_id").toPandas()
    exp = pdf.groupby("stock_id")["x"].ffill()
    assert np.allclose(got["x_ffill"].fillna(-99), exp.fillna(-99))


def test_tail_per_key(spark):
    df = _panel(spark, seed=5)
    got = tail_per_key(df, 7).select("stock_id", "time_id").orderBy("stock_id", "time_id").toPandas()
    pdf = df.select("stock_id", "time_id").toPandas().sort_values(["stock_id", "time_id"])
    exp = pdf.groupby("stock_id").tail(7).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, exp)
