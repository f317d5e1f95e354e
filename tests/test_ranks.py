"""Distributed ranks, ordinals and the median by descent against plain Python."""

import random
import statistics

import numpy as np
from pyspark.sql import functions as F

from auctide.operators import aggregates as agg
from auctide.operators import folds, ranks
from auctide.sources.snapshots import add_time_id


def test_global_rank_is_the_place_in_order(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), rng.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "s string, n int, i int").repartition(7)
    got = [(r.s, r.n, r.i) for r in ranks.global_rank(df, F.col("s").desc(), "n", "i").orderBy("rank").collect()]
    assert got == sorted(rows, key=lambda r: (-ord(r[0]), r[1], r[2]))
    assert ranks.global_rank(df, "n").agg(F.count_distinct("rank"), F.min("rank"), F.max("rank")).first() == (3000, 0, 2999)
    assert ranks.global_rank(df.limit(0), "n").count() == 0


def test_rank_tasks_stay_small(spark):
    """Groups of one size: the rank needs no window, and no range holds much more than its share."""
    df = spark.range(200_000).select(F.lit(3).alias("size"), F.col("id"))
    plan = ranks.global_rank(df, "size", "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    ranked = ranks.global_rank(df, "size", "id")
    assert ranked.filter(F.col("rank") != F.col("id")).count() == 0


def test_ordinals_of_any_key_type(spark):
    rows = [("b", 2.5), ("a", 1.0), ("b", 1.0), ("a", 1.0)]
    got = ranks.ordinals(spark.createDataFrame(rows, "s string, v double"), "s", "v").orderBy("ordinal").collect()
    assert [(r.s, r.v, r.ordinal) for r in got] == [("a", 1.0, 0), ("b", 1.0, 1), ("b", 2.5, 2)]


def test_folds_over_text_keys(spark):
    days = [f"2024-01-{d:02d}" for d in range(1, 12)]
    df = spark.createDataFrame([(d,) for d in days for _ in range(2)], "date_id string")
    valid = folds.kfold(df, 3).filter("role = 'valid'").collect()
    assert sorted((r.fold, r.date_id) for r in valid) == \
        [(0 if i < 4 else 1 if i < 8 else 2, d) for i, d in enumerate(days)]


def test_more_folds_than_keys(spark):
    df = spark.createDataFrame([(5,), (9,)], "date_id int")
    valid = folds.kfold(df, 4).filter("role = 'valid'").collect()
    assert sorted((r.fold, r.date_id) for r in valid) == [(0, 5), (1, 9)]


def test_time_id(panel):
    got = add_time_id(panel.drop("time_id"))
    assert got.select(*panel.columns).exceptAll(panel).count() == 0 and got.count() == panel.count()


def test_median_by_descent(spark):
    rng = np.random.default_rng(2)
    groups = {
        "close": (1 + rng.random(4001) / 100).tolist(),          # all inside 1/64 octave
        "equal": [2.0] * 500 + [2.0000001] * 500,
        "even": [1.0, 4.0], "one": [7.0], "signs": (-rng.random(301)).tolist() + rng.random(300).tolist(),
        "steep": [1 + 2.0 ** -k for k in range(6, 52)], "wide": np.geomspace(1e-300, 1e300, 999).tolist(),
        "integers": rng.integers(0, 5, 1000).astype(float).tolist()}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("one", None), ("none", None)],
                               "g string, v double").repartition(6)
    for few in (1, 20, 100_000):
        got = {r.g: r.m for r in agg.median_by_descent(df, "g", "v", "m", few=few).collect()}
        assert got == {g: statistics.median(vs) for g, vs in groups.items()}
    assert agg.median_by_descent(df.limit(0), "g", "v").count() == 0


def test_descent_splits_a_crowded_range(spark):
    """A million values inside 1/64 octave: what is left to rank in one task is a thousandth."""
    df = spark.range(1_000_001).select(F.lit("a").alias("g"), (1 + F.col("id") / 1e8).alias("v"))
    got = agg.median_by_descent(df, "g", "v", few=5000)
    assert got.collect()[0].median_v == 1 + 500_000 / 1e8
