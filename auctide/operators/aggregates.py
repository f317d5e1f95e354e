"""Group aggregates: per-stock statistics, data checks, index returns, fold errors.

All are hash aggregates with map-side partial aggregation. The per-stock
median is exact and computed by ``distributed_median`` from value counts (ranks
over value buckets, then over the values of the needed buckets), so no stock's
values are gathered in one aggregation buffer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auctide.session import stored


def _medians(df: DataFrame, cols, how: str) -> DataFrame:
    """Per-stock medians of ``cols`` as one row per stock (``median_{c}`` columns)."""
    if how in ("distributed", "descent"):
        long = df.select("stock_id", F.explode(F.array(*[
            F.struct(F.lit(c).alias("_var"), F.col(c).cast("double").alias("_v")) for c in cols])).alias("_s"))
        long = long.select("stock_id", "_s._var", "_s._v")
        find = distributed_median if how == "distributed" else median_by_descent
        med = find(long, ["stock_id", "_var"], "_v", name="_med")
        wide = med.groupBy("stock_id").pivot("_var", list(cols)).agg(F.first("_med"))
        return wide.select("stock_id", *[F.col(c).alias(f"median_{c}") for c in cols])
    f = (lambda c: F.percentile_approx(c, 0.5, 10000)) if how == "approx" else F.median
    return df.groupBy("stock_id").agg(*[f(c).alias(f"median_{c}") for c in cols])


def stock_unit_stats(df: DataFrame, median: str = "distributed", ptp_price: str = "bid",
                     prefix: str = "stock_unit_") -> DataFrame:
    """Six per-stock statistics of sizes and prices.

    ``median``: ``"distributed"`` (exact, no group gathered in one task; default),
    ``"descent"`` (the same for values of any distribution, runs jobs), ``"exact"``
    (``F.median``, buffers a group's values), ``"approx"`` (sketch).
    ``ptp_price="bid"``: max(bid_price) - min(bid_price) (v1, v2);
    ``ptp_price="bid-ask"``: max(bid_price) - min(ask_price) (notebook).
    """
    cols = ["bid_size", "ask_size", "bid_price", "ask_price"]
    ptp = (F.max("bid_price") - F.min("bid_price")) if ptp_price == "bid" else (
        F.max("bid_price") - F.min("ask_price"))
    other = df.groupBy("stock_id").agg(
        (F.stddev_samp("bid_size") + F.stddev_samp("ask_size")).alias(f"{prefix}std_size"),
        (F.max("bid_size") - F.min("bid_size")).alias(f"{prefix}ptp_size"),
        (F.stddev_samp("bid_price") + F.stddev_samp("ask_price")).alias(f"{prefix}std_price"),
        ptp.alias(f"{prefix}ptp_price"))
    med = _medians(df, cols, median).select(
        "stock_id",
        (F.col("median_bid_size") + F.col("median_ask_size")).alias(f"{prefix}median_size"),
        (F.col("median_bid_price") + F.col("median_ask_price")).alias(f"{prefix}median_price"))
    return other.join(med, "stock_id").select(
        "stock_id", f"{prefix}median_size", f"{prefix}std_size", f"{prefix}ptp_size",
        f"{prefix}median_price", f"{prefix}std_price", f"{prefix}ptp_price")


def add_stock_unit_stats(df: DataFrame, stats: DataFrame | None = None, how: str = "inner",
                         **kw) -> DataFrame:
    """Join per-stock statistics back (computed on ``df`` itself unless ``stats`` is given,
    e.g. a table fitted on training rows only)."""
    stats = stats if stats is not None else stock_unit_stats(df, **kw)
    return df.join(stats, "stock_id", how)


def global_stock_stats(train: DataFrame, median: str = "distributed") -> DataFrame:
    """Notebook flavour: statistics on training rows, names ``global_*``,
    ``ptp_price = max(bid_price) - min(ask_price)``."""
    return stock_unit_stats(train, median, ptp_price="bid-ask", prefix="global_")


# ---------------------------------------------------------------------- data checks (EDA)

def distinct_counts(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    f = F.count_distinct if exact else F.approx_count_distinct
    return df.agg(*[f(c).alias(f"n_{c}") for c in columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (the expected result is empty)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def days_per_stock_histogram(df: DataFrame) -> DataFrame:
    """How many stocks have each number of trading days."""
    per = df.groupBy("stock_id").agg(F.count_distinct("date_id").alias("n_days"))
    return per.groupBy("n_days").agg(F.count(F.lit(1)).alias("n_stocks"))


def stock_and_index_return(df: DataFrame, k: int = 6) -> DataFrame:
    """``stock_return``, the k-step (60 s) return in bp per (stock, date), and the index return
    that the row's target implies, ``stock_return - target``."""
    w = Window.partitionBy("stock_id", "date_id").orderBy("time_id")
    r = df.withColumn("stock_return", (F.try_divide(F.lead("wap", k).over(w), F.col("wap")) - 1) * 10000)
    return r.withColumn("index_return", F.col("stock_return") - F.col("target"))


def index_return(df: DataFrame, k: int = 6) -> DataFrame:
    """Mean over stocks of the implied index return per snapshot."""
    return stock_and_index_return(df, k).groupBy("time_id").agg(F.avg("index_return").alias("mean_index_return"),
                                    F.count("index_return").alias("n_stocks"))


def mae_by(df: DataFrame, label: str, prediction: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.abs(F.col(label) - F.col(prediction))).alias("mae"),
                               F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------- exact median without gathering a group

#: Value buckets per factor of two.
MEDIAN_STEPS = 64


def _value_counts(df: DataFrame, g: list[str], col: str) -> DataFrame:
    """``g, _x, _vc``: the values of each group and how often they occur."""
    return (df.select(*g, F.col(col).alias("_x")).filter(F.col("_x").isNotNull())
            .groupBy(*g, "_x").agg(F.count(F.lit(1)).alias("_vc")))


def _octave_step(x: Column) -> Column:
    return F.when(x == 0, F.lit(0)).otherwise(
        F.signum(x).cast("int") * (F.floor(F.log2(F.abs(x)) * MEDIAN_STEPS) + F.lit(100_000)))


def distributed_median(df: DataFrame, group, col: str, name: str | None = None) -> DataFrame:
    """Exact interpolated median of ``col`` per ``group`` without one task holding a group.

    1. values collapse to counts per (group, value), map-side first;
    2. an order-preserving bucket (the logarithm of the magnitude, in steps of
       1/64 octave, with the sign) cuts a group's values; counts per bucket and
       a prefix sum over a group's buckets, at most a few thousand, find the
       buckets of the two middle ranks;
    3. ranks inside those buckets only, by a window over (group, bucket).
    One lazy plan: the value counts are shuffled once and reused. The result
    equals ``F.median`` (interpolation between the two middle values). Where a
    group may have very many values within 1/64 octave, use ``median_by_descent``.
    """
    name = name or f"median_{col}"
    g = [group] if isinstance(group, str) else list(group)
    vals = _value_counts(df, g, col).withColumn("_k", _octave_step(F.col("_x")))
    # what the join below asks of its sides, asked of both readers: else their shuffles differ
    for c in (*g, "_k"):
        vals = vals.filter(F.col(c).isNotNull())
    wg = Window.partitionBy(*g)
    wk = wg.orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (vals.groupBy(*g, "_k").agg(F.sum("_vc").alias("_c"))
               .withColumns({"_n": F.sum("_c").over(wg), "_before": F.coalesce(F.sum("_c").over(wk), F.lit(0))}))
    pos = (F.col("_n") - 1) / 2.0
    lo, hi = F.floor(pos), F.ceil(pos)
    holds = [(r >= F.col("_before")) & (r < F.col("_before") + F.col("_c")) for r in (lo, hi)]
    need = buckets.filter(holds[0] | holds[1]).select(*g, "_k", "_before", lo.alias("_lo"), hi.alias("_hi"))
    wv = Window.partitionBy(*g, "_k").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = vals.join(need, [*g, "_k"]).withColumn("_cum", F.col("_before") + F.sum("_vc").over(wv))

    def value_at(rank: str) -> Column:  # the first value whose cumulative count exceeds the rank
        return F.min(F.when(F.col("_cum") > F.col(rank), F.col("_x")))

    picked = near.groupBy(*g).agg(value_at("_lo").alias("_vlo"), value_at("_hi").alias("_vhi"),
                                  F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    med = F.when(F.col("_lo") == F.col("_hi"), F.col("_vlo")).otherwise(
        0.5 * F.col("_vlo") + 0.5 * F.col("_vhi"))
    return picked.select(*g, med.alias(name))


#: Parts of a range in one step of the descent; values that a last step may rank in one task.
SPLIT, FEW_VALUES = 1024, 100_000


def median_by_descent(df: DataFrame, group, col: str, name: str | None = None, few: int = FEW_VALUES) -> DataFrame:
    """Exact interpolated median of ``col`` per ``group``, whatever the distribution of a group's values.

    As in ``distributed_median`` the first step finds, per group, the ranges of
    1/64 octave that hold the two middle ranks. While some range holds more than
    ``few`` values it is cut into ``SPLIT`` equal parts between its smallest and
    its largest value, and the part that holds the rank is kept. Doubles are
    evenly spaced inside such a range, so five steps at most reach single values.
    Each step is an aggregate of counts per part over the values still in a
    range; the ranges, one or two per group, are a table.
    """
    name = name or f"median_{col}"
    g = [group] if isinstance(group, str) else list(group)
    x = F.col("_x")
    vals = stored(_value_counts(df, g, col).withColumn("_k", _octave_step(x)), "median-values")

    def narrow(near: DataFrame, keys: list[str]) -> DataFrame:
        """Per rank (``g, _r``) the part of its range that holds it: bounds, rows before it, values in it."""
        part = near.groupBy(*g, "_r", *keys).agg(F.sum("_vc").alias("_c"), F.count(F.lit(1)).alias("_values"),
                                                 F.min("_x").alias("_min"), F.max("_x").alias("_max"),
                                                 F.first("_before").alias("_base"))
        before = F.sum("_c").over(Window.partitionBy(*g, "_r").orderBy(keys[-1])
                                  .rowsBetween(Window.unboundedPreceding, -1))  # as many rows as parts
        part = part.withColumn("_before", F.col("_base") + F.coalesce(before, F.lit(0)))
        inside = (F.col("_r") >= F.col("_before")) & (F.col("_r") < F.col("_before") + F.col("_c"))
        return stored(part.filter(inside).select(*g, "_r", "_min", "_max", "_before", "_values"), "median-ranges")

    n = vals.groupBy(*g).agg(F.sum("_vc").alias("_n"))
    pos = (F.col("_n") - 1) / 2.0
    ranks = n.select(*g, F.explode(F.array_distinct(F.array(F.floor(pos), F.ceil(pos)))).alias("_r"))
    steps = vals.groupBy(*g, "_k").agg(F.sum("_vc").alias("_vc"), F.min("_x").alias("_x"), F.max("_x").alias("_top"),
                                       F.count(F.lit(1)).alias("_values"))
    # the first step reads the counts per range of 1/64 octave instead of the values
    wk = Window.partitionBy(*g, "_r").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    first = steps.join(ranks, g).withColumn("_before", F.coalesce(F.sum("_vc").over(wk), F.lit(0)))
    ranges = stored(first.filter((F.col("_r") >= F.col("_before")) & (F.col("_r") < F.col("_before") + F.col("_vc")))
                    .select(*g, "_r", F.col("_x").alias("_min"), F.col("_top").alias("_max"), "_before", "_values"),
                    "median-ranges")
    values = vals.select(*g, "_x", "_vc")
    while (ranges.agg(F.max(F.when(F.col("_min") < F.col("_max"), F.col("_values")))).first()[0] or 0) > few:
        near = values.join(ranges, g).filter(x.between(F.col("_min"), F.col("_max")))
        width = F.col("_max") - F.col("_min")
        part = F.when(width > 0, F.least(F.floor((x - F.col("_min")) / width * SPLIT), F.lit(SPLIT - 1))).otherwise(F.lit(0))
        ranges = narrow(near.withColumn("_part", part), ["_part"])
    near = values.join(ranges, g).filter(x.between(F.col("_min"), F.col("_max")))
    upto = Window.partitionBy(*g, "_r").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (near.withColumn("_cum", F.col("_before") + F.sum("_vc").over(upto)).filter(F.col("_cum") > F.col("_r"))
             .groupBy(*g, "_r").agg(F.min("_x").alias("_v")))
    middle = F.when(F.min("_r") == F.max("_r"), F.min("_v")).otherwise(0.5 * F.min("_v") + 0.5 * F.max("_v"))
    return found.groupBy(*g).agg(middle.alias(name))
