"""Tree ensembles as SQL, early stopping, and index weights against brute force."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from auctide.operators import folds, index_fit, model, trees
from auctide.plans import queries as Q
from auctide.session import scratch_path, stored
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    data = []
    for i in range(1500):
        a, b, c = rng.normal(size=3)
        data.append((i % 7, i, i, float(a), float(b) if i % 11 else None, float(c), float(3 * a + np.sign(b) + c * c / 4)))
    df = spark.createDataFrame(data, "date_id int, stock_id int, time_id int, a double, b double, c double, target double")
    return model.assemble(df, ["a", "b", "c"]).repartition(2, "stock_id").cache()


@pytest.mark.parametrize("kind", model.KINDS)
def test_expressions_equal_the_fitted_model(rows, kind):
    data = rows.withColumn("features", array_to_vector("x"))
    fitted = model.init_model(kind, **({"numTrees": 5} if kind == "rf" else {"maxIter": 6})).fit(data)
    ours = trees.TreeEnsemble.of(fitted, kind)
    both = fitted.transform(data).withColumn("ours", ours.prediction())
    assert both.agg(F.max(F.abs(F.col("ours") - F.col(f"pred_{kind}")))).first()[0] < 1e-9


def test_staged_errors_equal_those_of_the_library(rows):
    data = rows.withColumn("features", array_to_vector("x"))
    fitted = model.init_model("gbt", maxIter=8).fit(data)
    curve = model.validation_curves({0: rows}, {0: trees.TreeEnsemble.of(fitted, "gbt")}, "target")
    got = [r.mae for r in curve.orderBy("stage").collect()]
    assert np.allclose(got, fitted.evaluateEachIteration(data, "absolute"))


def test_longer_fit_repeats_the_trees_of_a_shorter_one(rows):
    short, long = (model.fit(rows, "gbt", "target", maxIter=n) for n in (4, 9))
    assert long.trees[:4] == short.trees and long.weights[:4] == short.weights


def test_stopping_point():
    assert model.stopping_point([5, 4, 3, 3, 3, 2], 2) == (2, 5, True)
    rng = np.random.default_rng(3)
    for _ in range(300):
        curve, patience = rng.integers(0, 9, rng.integers(1, 20)).tolist(), int(rng.integers(1, 5))
        best, seen, stopped = model.stopping_point(curve, patience)
        # brute force: the first length at which the best of the curve lies `patience` stages back
        ends = [n for n in range(1, len(curve) + 1) if n - 1 - int(np.argmin(curve[:n])) >= patience]
        assert (seen, stopped) == ((ends[0], True) if ends else (len(curve), False))
        assert best == int(np.argmin(curve[:seen]))


def test_folds_stop_as_one_long_fit_would(rows, monkeypatch):
    monkeypatch.setattr(model, "FIRST", 2)
    found = model.fit_cv(rows.drop("x"), ["a", "b", "c"], folds.kfold(rows, 2), patience=2, limit=8)
    for f, m in enumerate(found.models["gbt"]):
        role = folds.kfold(rows, 2).filter(F.col("fold") == f)
        side = {r: rows.join(role.filter(F.col("role") == r).select("date_id"), "date_id", "left_semi")
                for r in ("train", "valid")}
        curve = [r.mae for r in found.curves.filter(F.col("fold") == f).orderBy("stage").collect()]
        best, seen, _ = model.stopping_point(curve, 2)
        assert (m.used, seen) == (best + 1, len(curve)) and m.used <= 8
        mae = side["valid"].agg(F.avg(F.abs(F.col("target") - m.prediction()))).first()[0]
        assert abs(mae - curve[best]) < 1e-9
        assert abs(found.scores.filter(F.col("fold") == f).first().mae - mae) < 1e-9


def test_the_scale_of_the_label_does_not_matter(rows):
    small = rows.withColumn("target", F.col("target") / 1e4 + 7)
    a, b = model.fit(rows, "gbt", "target", maxIter=5), model.fit(small, "gbt", "target", maxIter=5)
    gap = rows.select(F.abs(a.prediction() - 1e4 * (b.prediction() - 7)).alias("g")).agg(F.max("g")).first()[0]
    assert gap < 1e-6


def test_saved_ensembles_come_back(spark, rows):
    ms = {"gbt_fold0": model.fit(rows, "gbt", "target", maxIter=5).cut(3), "rf_all": model.fit(rows, "rf", "target")}
    path = scratch_path(spark, "ensembles")
    trees.save(spark, ms, path)
    assert trees.load(spark, path) == ms


def test_scoring_ensemble_holds_folds_and_refit(rows):
    found, ms = model.scoring_ensemble(rows.drop("x"), ["a", "b", "c"], folds.kfold(rows, 3), ("gbt", "rf"), limit=4)
    assert sorted(ms) == sorted(f"{k}_{n}" for k in ("gbt", "rf") for n in ("fold0", "fold1", "fold2", "all"))
    mean = found.scores.agg(F.avg("scaled_gbt")).first()[0]
    assert ms["gbt_all"].used == max(1, int(mean))
    p = model.predict_all(rows.drop("x"), ["a", "b", "c"], ms)
    assert set(ms) <= set(p.columns) and "x" not in p.columns


def test_unknown_kind():
    with pytest.raises(ValueError):
        model.init_model("linear")


def test_index_weights_equal_least_squares(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 12)) * np.geomspace(0.01, 100, 12)
    y = x @ rng.normal(size=12) + 5 + rng.normal(size=200)
    cells = [(t, 10 * s, float(x[t, s])) for t in range(200) for s in range(12)]
    cells += [(t, 7, None) for t in range(5)] + [(500, 10, 1.0), (501, 20, float("nan"))]
    index = [(t, float(v)) for t, v in enumerate(y)] + [(500, None), (501, float("nan")), (600, 1.0)]
    got = index_fit.index_weight_regression(spark.createDataFrame(cells, "time_id int, stock_id int, ret double"),
                                            spark.createDataFrame(index, "time_id int, index_ret double"))
    want = np.linalg.lstsq(np.c_[x, np.ones(200)], y, rcond=None)[0][:12]
    rows_ = {r.stock_id: r for r in got.weights.collect()}
    assert sorted(rows_) == [10 * s for s in range(12)] and all(r.n_obs == 200 for r in rows_.values())
    assert np.allclose([rows_[10 * s].weight for s in range(12)], want, rtol=1e-6, atol=1e-9)
    assert [rows_[10 * s].weight_est for s in range(12)] == pytest.approx(want.round(3), abs=1e-12)
    e = y - x @ want.round(3)
    assert got.r2 == pytest.approx(1 - (e @ e) / ((y - y.mean()) ** 2).sum()) and got.slope <= 1e-10


def test_index_weights_of_nothing(spark):
    r = spark.createDataFrame([], "time_id int, stock_id int, ret double")
    got = index_fit.index_weight_regression(r, spark.createDataFrame([], "time_id int, index_ret double"))
    assert got.weights.count() == 0 and got.rounds == 0


def test_fold_rows_are_read_without_a_shuffle(rows, monkeypatch, capsys):
    """Only the small fold table travels: no fit and no curve deals the wide rows anew."""
    read, fit, curves = [], model.fit, model.validation_curves
    monkeypatch.setattr(model, "fit", lambda r, *a, **kw: (read.append(r), fit(r, *a, **kw))[1])
    monkeypatch.setattr(model, "validation_curves", lambda v, *a: (read.extend(v.values()), curves(v, *a))[1])
    model.fit_cv(rows.drop("x"), ["a", "b", "c"], folds.kfold(rows, 2), patience=2, limit=2)
    assert len(read) == 4
    for r in read:
        r.explain()
        assert "hashpartitioning" not in capsys.readouterr().out


def test_fits_are_the_same_from_rows_written_before(rows):
    fl = folds.kfold(rows, 2)
    keep = ["date_id", "stock_id", "time_id", "target"]
    a = model.fit_cv(rows.drop("x"), ["a", "b", "c"], fl, patience=2, limit=4)
    b = model.fit_cv(model.training_rows(rows.drop("x"), ["a", "b", "c"], keep), ["a", "b", "c"], fl, patience=2, limit=4)
    assert [m.used for m in a.models["gbt"]] == [m.used for m in b.models["gbt"]]
    for x, y in zip(a.scores.orderBy("fold").collect(), b.scores.orderBy("fold").collect()):
        assert x.n_valid == y.n_valid and x.n_train == y.n_train and abs(x.mae - y.mae) < 1e-9


def test_a_fit_takes_tasks_by_bytes(rows, spark, monkeypatch):
    seen, init = [], model.init_model

    class Spy:
        def __init__(self, *a, **kw):
            self.model = init(*a, **kw)

        def fit(self, data):
            seen.append(data.rdd.getNumPartitions())
            return self.model.fit(data)

    monkeypatch.setattr(model, "init_model", Spy)
    model.fit(rows.repartition(64), "gbt", "target", maxIter=1)
    assert seen == [min(64, spark.sparkContext.defaultParallelism)]


def test_features_are_written_once(spark, monkeypatch):
    wide = []

    def spy(df, name):
        if "x" in df.columns or len(df.columns) > 100:
            wide.append(name)
        return stored(df, name)

    monkeypatch.setattr(Q, "TREES", 1)
    monkeypatch.setattr(Q, "stored", spy)
    monkeypatch.setattr(model, "stored", spy)
    agree = Q.q_model_roundtrip(spark, SF_SMALL).groupBy("models_that_agree").count().collect()
    assert wide == ["model-rows"] and [r[0] for r in agree] == [Q.ML_FOLDS + 1]


def test_short_and_long_vectors_give_the_same_weights(spark, monkeypatch):
    """Broadcast vectors: the tables written do not grow with the rounds, and the weights are those of the other way."""
    rng = np.random.default_rng(8)
    cells = [(t, s, float(rng.normal())) for t in range(60) for s in range(3, 11) if rng.random() < 0.7]
    ret = spark.createDataFrame(cells, "time_id int, stock_id int, ret double").repartition(3)
    idx = (ret.groupBy("time_id").agg((F.sum(F.col("ret") * (F.col("stock_id") % 4) / 100) + F.rand(1) / 1000).alias("index_ret"))
           .unionByName(spark.createDataFrame([(99, None), (7000, 1.0)], "time_id int, index_ret double"))).cache()
    written = []
    monkeypatch.setattr(index_fit, "stored", lambda df, name: (written.append(name), stored(df, name))[1])
    found, tables = [], []
    for most in (0, 1_000_000):
        monkeypatch.setattr(index_fit, "VECTORS", most)
        written.clear()
        fit = index_fit.index_weight_regression(ret, idx)
        tables.append(len(written))
        found.append((fit, {r.stock_id: r for r in fit.weights.collect()}))
    (a, x), (b, y) = found
    assert tables[1] == 4 < tables[0] and a.rounds > 4 and x.keys() == y.keys() == set(range(3, 11))
    assert all(abs(x[s].weight - y[s].weight) < 1e-9 and x[s].n_obs == y[s].n_obs for s in x)
    assert abs(a.r2 - b.r2) < 1e-9 and max(a.slope, b.slope) <= 1e-9


def test_repeated_snapshots_keep_their_weight(spark):
    """Where a snapshot has several index returns, the vectors have no places; the tables still answer."""
    ret = spark.createDataFrame([(t, s, float((t * 7 + s * 3) % 5 - 2)) for t in range(12) for s in range(3)],
                                "time_id int, stock_id int, ret double")
    idx = spark.createDataFrame([(t, float(t % 4)) for t in [*range(12), 3]], "time_id int, index_ret double")
    fit = index_fit.index_weight_regression(ret, idx, most_rounds=3)
    assert fit.weights.count() == 3 and fit.rounds <= 3
