import os
import tempfile

from pyspark.sql import functions as F

from auctide.operators import joins
from auctide.plans.features import features
from auctide.plans.fixtures import weights_by_rule
from auctide.sources.side_tables import downcast
from auctide.sources.snapshots import preprocess, read_snapshots_csv, table
from tests.conftest import SF_SMALL


def test_csv_roundtrip_with_schema(spark, panel):
    d = tempfile.mkdtemp(prefix="auctide-csv-")
    panel.write.mode("overwrite").option("header", True).csv(os.path.join(d, "snap"))
    back = read_snapshots_csv(spark, os.path.join(d, "snap"))
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in panel.schema]
    assert back.count() == panel.count()
    assert back.exceptAll(panel).count() == 0


def test_preprocess_drops_missing_target(panel):
    out = preprocess(panel)
    assert out.filter(F.col("target").isNull()).count() == 0
    assert out.count() == panel.filter(F.col("target").isNotNull()).count()
    assert "target" not in preprocess(panel.drop("target")).columns


def test_downcast(panel):
    t = dict(downcast(panel.drop("row_id")).dtypes)
    assert t["imbalance_buy_sell_flag"] == "tinyint" and t["stock_id"] == "tinyint"
    assert t["wap"] == "float" and t["time_id"] == "smallint"


def test_unknown_version(spark, panel):
    import pytest
    with pytest.raises(ValueError):
        features(panel, "v9", weights_by_rule(spark, SF_SMALL))


def _executed_plan(df):
    """The plan that ran: collect() uses the frame's own execution, so its final adaptive plan is read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return plan


def test_panel_keeps_every_row_of_lineitem(spark, panel):
    li = table(spark, SF_SMALL, "lineitem").select(F.col("l_suppkey").alias("stock_id"),
                                                   F.to_date("l_shipdate").alias("d"))
    days = li.groupBy("stock_id", "d").count()
    assert panel.count() == days.count() == panel.select("stock_id", "date_id", "seconds_in_bucket").distinct().count()
    start = F.lit("1995-01-01").cast("date")
    at = panel.select("stock_id", F.date_add(start, (F.col("date_id") * 55 + F.col("seconds_in_bucket") / 10)
                                             .cast("int")).alias("d"))
    assert at.join(days, ["stock_id", "d"]).agg(F.sum("count")).first()[0] == li.count()
    assert panel.filter("seconds_in_bucket not between 0 and 540").count() == 0


def test_rounding_keeps_small_ratios(spark):
    from auctide.plans import queries as Q
    from auctide.operators import book
    cols = Q.PRESSURE_COLS
    raw = book.pressure(book.book_imbalance(Q._snap(spark, SF_SMALL), "null"), "null").select(*cols)
    seen = Q.q_pressure(spark, SF_SMALL)
    a, b = (df.agg(*[F.count_distinct(c).alias(c) for c in cols]).first() for df in (raw, seen))
    assert all(b[c] >= 0.95 * a[c] for c in cols if a[c] > 100), (a, b)


def test_weights_join_is_broadcast_after_aqe(spark, panel):
    df = joins.join_weights(panel, weights_by_rule(spark, SF_SMALL))
    assert "BroadcastHashJoin" in _executed_plan(df)


def test_no_per_stock_window_over_the_panel(spark, panel):
    """Windows partitioned by stock_id alone run on the per-chunk table only."""
    df = features(panel.filter("target is not null"), "v2", weights_by_rule(spark, SF_SMALL), keep_stock_id=True)
    plan = _executed_plan(df)
    for line in plan.splitlines():
        if "Window [" in line and "windowspecdefinition(stock_id" in line:
            spec = line.split("windowspecdefinition(")[1]
            if not spec.split(",")[1].strip().startswith(("date_id", "_block")):
                # neither a (stock, date) nor a (stock, block) window: must run on a small table -- the
                # per-date table (rows before / carried values / blocks ahead) or the median's bucket counts
                assert any(t in line for t in ("_start", "_carry_", "_own", "_opens", "sum(_c#", "sum(_vc#")), line
