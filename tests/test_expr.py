import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from auctide.functions.expr import (clean_inf, pct_change, ratio, round_doubles, triplet_imbalance,
                                    with_row_moments)


def test_division_policies(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    rows = df.select(ratio("a", "b", "null").alias("n"), ratio("a", "b", "zero").alias("z")).collect()
    assert [r.n for r in rows] == [None, None, None, None, None, 1.5]
    assert [r.z for r in rows] == [0.0, 0.0, None, None, None, 1.5]
    with pytest.raises(ValueError):
        ratio("a", "b", "bogus")


def test_pct_change_zero_policy(spark):
    df = spark.createDataFrame([(2.0, 0.0), (0.0, 0.0), (3.0, 2.0)], "x double, p double")
    got = [r[0] for r in df.select(pct_change("x", "p", "zero")).collect()]
    assert got == [0.0, None, 0.5]


def test_row_moments_match_pandas(spark):
    rng = np.random.default_rng(7)
    data = rng.normal(1.0, 0.01, size=(60, 6))
    # 0..6 missing values per row, including rows with one, two and three values
    for i in range(60):
        k = i % 7
        data[i, rng.choice(6, size=k, replace=False)] = np.nan
    data[5] = [1.0, 1.0, 1.0, 1.0, np.nan, np.nan]  # zero variance
    cols = [f"c{i}" for i in range(6)]
    pdf = pd.DataFrame(data, columns=cols)
    sdf = spark.createDataFrame([tuple(None if math.isnan(v) else float(v) for v in row) for row in data],
                                ", ".join(f"{c} double" for c in cols))
    out = with_row_moments(sdf.withColumn("i", F.monotonically_increasing_id()), {"m": cols}).orderBy("i").toPandas()
    exp = {"m_mean": pdf.mean(axis=1), "m_std": pdf.std(axis=1), "m_skew": pdf.skew(axis=1),
           "m_kurt": pdf.kurt(axis=1)}
    for k, e in exp.items():
        g = out[k].astype(float)
        assert (g.isna() == e.isna()).all(), k
        assert np.allclose(g[~e.isna()], e[~e.isna()], rtol=1e-9, atol=1e-9), k


def test_triplet_null_rules(spark):
    df = spark.createDataFrame([(1.0, 2.0, 4.0), (1.0, None, 3.0), (2.0, 2.0, 5.0)], "a double, b double, c double")
    strict = [r[0] for r in df.select(triplet_imbalance("a", "b", "c")).collect()]
    skip = [r[0] for r in df.select(triplet_imbalance("a", "b", "c", nulls="skip")).collect()]
    assert strict[0] == pytest.approx(2.0) and strict[1] is None and strict[2] is None
    assert skip[1] == pytest.approx(-3.0)  # mid = 0: (3 - 0) / (0 - 1) = -max/min


def test_clean_inf_and_rounding(spark):
    inf = float("inf")
    df = spark.createDataFrame([(inf, 1), (-inf, 2), (1.23456789012, 3), (-1e-13, 4), (1.23456789012e-7, 5),
                                (123456.123456789, 6)], "x double, k int")
    out = round_doubles(clean_inf(df)).orderBy("k").collect()
    assert [r.x for r in out] == [0.0, 0.0, 1.23456789, 0.0, 1.23456789e-7, 123456.123457]
    assert math.copysign(1.0, out[3].x) == 1.0
    seven = round_doubles(df.filter("k = 3"), significant=lambda name: 7).first()
    assert seven.x == 1.234568


def test_distributed_median_equals_exact(spark):
    from auctide.operators.aggregates import distributed_median
    rng = np.random.default_rng(1)
    rows = []
    for g, n in enumerate([1, 2, 5, 1000, 20000, 8]):
        hi = 50 if g == 4 else 10 ** 6  # group 4: one hot group full of duplicates
        rows += [(g, float(v)) for v in rng.integers(0, hi, size=n)]
    rows += [(7, 1.5), (7, 1.5), (7, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    exact = {r[0]: r[1] for r in df.groupBy("g").agg(F.median("v")).collect()}
    got = {r[0]: r[1] for r in distributed_median(df, "g", "v").collect()}
    assert got == exact
