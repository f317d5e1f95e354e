"""What keeps tasks and shuffles small: settings, rows dealt once, narrow columns on the way, lags for frames."""

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from auctide.functions.expr import TEMP, roll_mean, roll_std, rolling
from auctide.operators import aggregates as agg
from auctide.operators.series import along_dates, apply_stages, stock_windows
from auctide.plans.features import features_nb, features_v1, features_v2
from auctide.plans.fixtures import weights_by_rule
from auctide.session import PANEL_SETTINGS, tune
from auctide.sources.snapshots import snapshots
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _series(spark):
    rows = [(s, t // 7, t, None if t % 11 == s else float((t * t) % 23)) for s in range(3) for t in range(40)]
    return spark.createDataFrame(rows, "stock_id int, date_id int, time_id int, x double")


def test_panel_settings_are_set_and_taken_back(spark):
    was = {k: spark.conf.get(k, None) for k in PANEL_SETTINGS}
    tune(spark)
    assert all(spark.conf.get(k) == v for k, v in PANEL_SETTINGS.items())
    tune(spark, panel=False)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") != "8000"
    for k, v in was.items():
        if v is not None:
            spark.conf.set(k, v)


def test_windows_of_a_date_do_not_deal_the_panel_again(spark):
    w = Window.partitionBy("stock_id", "date_id").orderBy("time_id")
    plan = _plan(snapshots(spark, SF_SMALL).withColumn("before", F.lag("wap").over(w)))
    dealt = re.findall(r"Exchange hashpartitioning\(stock_id#\w+, date_id#\w+[^)]*\), (\w+)", plan)
    assert dealt == ["REPARTITION_BY_COL"] and "hashpartitioning(l_suppkey" not in plan


def test_value_counts_are_shuffled_once(spark):
    plan = _plan(agg.stock_unit_stats(_series(spark).selectExpr(
        "stock_id", "x bid_size", "x ask_size", "x bid_price", "x ask_price")))
    filters = {re.sub(r"#\w+", "", f) for f in re.findall(r"Filter (\(isnotnull\(_s#.*)", plan)}
    assert len(filters) == 1  # both readers of the counts ask for the same rows


def test_no_shuffle_carries_the_wide_rows(spark):
    p, w = snapshots(spark, SF_SMALL).filter("target is not null"), weights_by_rule(spark, SF_SMALL)
    for df in (features_v1(p, w, keep_stock_id=True), features_v2(p, w, keep_stock_id=True),
               features_v2(p, w, keep_stock_id=True, reset_daily=True)):
        widest, stack = [], [df._jdf.queryExecution().sparkPlan()]  # what joins take may be shuffled
        while stack:
            n = stack.pop()
            kids = [n.children().apply(i) for i in range(n.children().size())]
            if "Join" in n.nodeName():
                widest += [k.output().size() for k in kids]
            stack += kids
        assert max(widest) < 40


def test_columns_of_a_keyed_table_come_along(spark):
    s = _series(spark)
    keyed = spark.createDataFrame([(0, 5.0), (2, 7.0)], "stock_id int, y double")
    want = sorted(map(tuple, s.join(keyed, "stock_id").select("stock_id", "time_id", "y").collect()))
    a = stock_windows(s, [lambda w: {"b": F.lag("x").over(w)}], 1, keyed=keyed, rows=8)
    for df in (a, along_dates(s, keyed)):
        assert sorted(map(tuple, df.select("stock_id", "time_id", "y").collect())) == want


def test_rolling_from_lags_equals_frames(spark):
    w = Window.partitionBy("stock_id").orderBy("time_id")
    sizes = {"3": 3, "6": 6}
    got = apply_stages(_series(spark), w, [lambda w: rolling({f"m{n}": ("x", k) for n, k in sizes.items()},
                                                             {f"s{n}": ("x", k) for n, k in sizes.items()}, w)])
    assert not [c for c in got.columns if c.startswith(TEMP)]
    assert "count(x" not in _plan(got) and "avg(x" not in _plan(got)
    plain = _series(spark).withColumns({f"m{n}": roll_mean("x", k, w) for n, k in sizes.items()}
                                       | {f"s{n}": roll_std("x", k, w) for n, k in sizes.items()})
    assert got.select(plain.columns).exceptAll(plain).count() == 0 and got.count() == plain.count()


def test_columns_of_a_row_are_made_after_the_deal(spark):
    p, w = snapshots(spark, SF_SMALL).filter("target is not null"), weights_by_rule(spark, SF_SMALL)
    for df in (features_v1(p, w), features_v2(p, w), features_nb(p, w)):
        dealt, stack = [], [df._jdf.queryExecution().sparkPlan()]
        while stack:
            n = stack.pop()
            stack += [n.children().apply(i) for i in range(n.children().size())]
            if "Exchange" in n.nodeName() and re.search(r"hashpartitioning\(stock_id#\d+, _block#", n.toString().split("\n")[0]):
                dealt.append(n.output().toString())
        assert len(dealt) == 1 and not re.search(r"\b(weighted_wap|mid_price|price_spread)#", dealt[0])
