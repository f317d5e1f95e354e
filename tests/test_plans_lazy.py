"""Building a plan runs no job; parity flags run; fitted statistics are used as given."""

import uuid

import pytest
from pyspark.sql import functions as F

from auctide.functions.expr import roll_mean
from auctide.operators import aggregates as agg
from auctide.operators import book, folds, joins, post
from auctide.operators.series import day_window
from auctide.plans import queries as Q
from auctide.plans.features import features_nb, features_v1, features_v2
from auctide.plans.fixtures import predictions_by_rule, weights_by_rule
from auctide.sources.snapshots import preprocess
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def weights(spark):
    return weights_by_rule(spark, SF_SMALL).cache()


BUILD = {
    "v1": lambda p, w: features_v1(p, w),
    "v2": lambda p, w: features_v2(p, w),
    "nb": lambda p, w: features_nb(p, w),
    "index_wap": lambda p, w: joins.add_index_wap(joins.join_weights(p, w)),
    "zero_sum": lambda p, w: post.zero_sum(post.ensemble(predictions_by_rule(p), Q.P_COLS), "prediction", "volume"),
    "stats": lambda p, w: agg.stock_unit_stats(p),
}


@pytest.mark.parametrize("name", BUILD)
def test_building_a_plan_runs_no_job(spark, panel, weights, name):
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, name)
    try:
        BUILD[name](panel, weights)
        assert not sc.statusTracker().getJobIdsForGroup(group)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_median_equals_builtin(spark):
    rows = [(g, float(v)) for g, vs in {"a": [3, 1, 2], "b": [1, 1, 1, 9], "c": [-5, 0, 5, -1e-9], "d": [7],
                                        "e": [2.0 ** k for k in range(-30, 31)]}.items() for v in vs]
    df = spark.createDataFrame([*rows, ("a", None), ("z", None)], "g string, v double")
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect() if r.m is not None}
    got = {r.g: r.median_v for r in agg.distributed_median(df, "g", "v").collect()}
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-12 for g in want)


@pytest.mark.parametrize("build", [features_v1, features_v2])
def test_parity_flag_runs(panel, weights, build):
    p = panel.filter("target is not null")
    assert build(p, weights, parity=True).count() == build(p, weights).count()


def test_given_statistics_are_used(panel, weights):
    p = panel.filter("target is not null")
    stats = agg.stock_unit_stats(p.filter(F.col("date_id") <= 20))
    for build in (features_v1, features_v2):
        got = build(p, weights, keep_stock_id=True, stats=stats).select("stock_id", "stock_unit_ptp_size").distinct()
        assert got.exceptAll(stats.select("stock_id", "stock_unit_ptp_size")).count() == 0


def test_harmonic_imbalance_at_zero_sizes(spark):
    df = spark.createDataFrame([(0.0, 10.0), (10.0, 0.0), (0.0, 0.0), (10.0, 30.0)], "bid_size double, ask_size double")
    assert [r.harmonic_imbalance for r in book.harmonic_imbalance(df, "zero").collect()] == [0.0, 0.0, 0.0, 15.0]
    assert [r.harmonic_imbalance for r in book.harmonic_imbalance(df, "null").collect()] == [None, None, None, 15.0]
    assert book.harmonic_imbalance(df, "zero", as_written_v2=True).collect()[3].harmonic_imbalance == 20 + 1 / 30


def test_nan_counts_as_missing_in_windows(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 0, t, v) for t, v in enumerate([1.0, nan, 2.0, 3.0, 4.0])],
                               "stock_id int, date_id int, time_id int, wap double")
    got = [r.m for r in preprocess(df).withColumn("m", roll_mean("wap", 2, day_window())).orderBy("time_id").collect()]
    assert got == [None, None, None, 2.5, 3.5]


def test_greedy_runs_equal_the_plain_pass():
    import random
    rng = random.Random(1)
    for _ in range(200):
        sizes = sorted(((rng.randrange(1, 60), rng.randrange(1, 30)) for _ in range(rng.randrange(1, 8))), reverse=True)
        sizes = list(dict(sizes).items())
        k = rng.randrange(2, 6)
        loads, plain = [0] * k, []
        for size, groups in sizes:
            for r in range(groups):
                j = min(range(k), key=lambda x: (loads[x], x))
                loads[j] += size
                plain.append((size, r, j))
        runs = [(s, r, turn[(r - a) % len(turn)]) for s, a, b, turn in folds._greedy_runs(sizes, k) for r in range(a, b)]
        assert runs == plain


def test_gap_type_is_checked(panel):
    with pytest.raises(TypeError):
        folds.cpcv(panel, 4, 2, purge_gap=0.5)
    assert folds.cpcv(panel, 4, 2, purge_gap=0.5, gap_kind="value").count() > 0
