"""Snapshot panel: schema, scans, the cast step and the table derived from ``lineitem``.

The reference reads one CSV of closing-auction snapshots. The test data has no
such table, so ``snapshots_from_lineitem`` derives one of the same shape from
``lineitem`` (rules in FIXTURES.md): a supplier's shipping day is one snapshot,
55 consecutive days are one date, so no row of ``lineitem`` is left out and
(stock, date, second) is a key. The panel is one lazy plan; its only
single-partition step sees one row per date of the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auctide.operators.ranks import ordinals

KEY = ["stock_id", "time_id"]

# fixed values: column order and Spark types of the snapshot table
SNAPSHOT_FIELDS = [
    ("stock_id", T.IntegerType()),
    ("date_id", T.IntegerType()),
    ("seconds_in_bucket", T.IntegerType()),
    ("imbalance_size", T.DoubleType()),
    ("imbalance_buy_sell_flag", T.IntegerType()),
    ("reference_price", T.DoubleType()),
    ("matched_size", T.DoubleType()),
    ("far_price", T.DoubleType()),
    ("near_price", T.DoubleType()),
    ("bid_price", T.DoubleType()),
    ("bid_size", T.DoubleType()),
    ("ask_price", T.DoubleType()),
    ("ask_size", T.DoubleType()),
    ("wap", T.DoubleType()),
    ("target", T.DoubleType()),
    ("time_id", T.IntegerType()),
    ("row_id", T.StringType()),
]

SNAPSHOT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in SNAPSHOT_FIELDS])
CAST_TYPES = {n: t for n, t in SNAPSHOT_FIELDS if n != "row_id"}
DOUBLE_COLUMNS = [n for n, t in SNAPSHOT_FIELDS if isinstance(t, T.DoubleType)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_snapshots_csv(spark: SparkSession, path: str, with_target: bool = True) -> DataFrame:
    """CSV scan with an explicit schema (never ``inferSchema``); blank and ``NaN`` cells are NULL."""
    fields = [f for f in SNAPSHOT_SCHEMA.fields if with_target or f.name != "target"]
    return nan_to_null(spark.read.schema(T.StructType(fields)).option("header", True)
                       .option("nanValue", "NaN").csv(path))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NULL is the only missing value inside the engine."""
    dbl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in dbl})


def preprocess(df: DataFrame) -> DataFrame:
    """Cast table of the reference, NaN to NULL; with a target column keep rows whose target is usable."""
    df = nan_to_null(df)
    if "target" in df.columns:
        df = df.filter(F.col("target").isNotNull() & ~F.isnan("target"))
    casts = {c: F.col(c).cast(t) for c, t in CAST_TYPES.items() if c in df.columns}
    return df.withColumns(casts)


def filter_target(df: DataFrame) -> DataFrame:
    return df.filter(F.col("target").isNotNull() & ~F.isnan("target"))


#: Days of one date; seconds_in_bucket runs from 0 to 10 * (DAYS - 1) = 540.
DAYS = 55


def _day_no(d: Column | str) -> Column:
    return F.datediff(d, F.lit("1995-01-01").cast("date"))


def _seconds() -> Column:
    return (F.pmod(_day_no("d"), F.lit(DAYS)) * 10).cast("int")


def _days(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` with the panel's keys: ``stock_id``, ``date_id``, ``d`` (the day)."""
    d = F.to_date("l_shipdate")
    return lineitem.withColumns({"stock_id": F.col("l_suppkey").cast("int"), "d": d,
                                 "date_id": F.floor(_day_no(d) / DAYS).cast("int")})


def _daily(days: DataFrame) -> DataFrame:
    # dealt by (stock, date) before the aggregate: the windows and sums per (stock, date) that follow
    # find their rows in place, and a supplier has hardly more than a row a day to combine beforehand
    li = days.select("stock_id", "date_id", "d", "l_extendedprice", "l_quantity",
                     "l_discount", "l_tax", "l_returnflag").repartition("stock_id", "date_id")
    return (li.groupBy("stock_id", "date_id", "d")
            .agg(F.max("l_extendedprice").alias("mx"), F.min("l_extendedprice").alias("mn"),
                 F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"),
                 F.max("l_discount").alias("disc"), F.max("l_tax").alias("tax"),
                 # the flag only needs to know whether max(l_returnflag) is 'A', 'N' or other;
                 # boolean maxima keep this a hash aggregate (a string max would force a sort)
                 *[F.max((F.col("l_returnflag") > v).cast("int")).alias(f"gt_{v}") for v in ("A", "N")],
                 *[F.max((F.col("l_returnflag") == v).cast("int")).alias(f"eq_{v}") for v in ("A", "N")]))


def _book(daily: DataFrame) -> DataFrame:
    r = daily.withColumn("seconds_in_bucket", _seconds())
    is_a = (F.col("gt_A") == 0) & (F.col("eq_A") == 1)
    is_n = (F.col("gt_N") == 0) & (F.col("eq_N") == 1)
    flag = F.when(is_a, -1).when(is_n, 0).otherwise(1)
    p = r.select(
        "stock_id", "date_id", "seconds_in_bucket", "n", "d",
        "disc", "tax", flag.alias("flag"),
        (F.lit(1.0) - F.lit(0.001) - F.col("disc") / 100).alias("bid_price"),
        (F.lit(1.0) + F.lit(0.001) + F.col("tax") / 100).alias("ask_price"),
        (F.col("q") * 100).alias("bid_size"),
        (F.floor("mx") + F.lit(0.0)).alias("ask_size"),
        (F.floor(F.col("mx") * 10) + F.lit(0.0)).alias("matched_size"),
        (F.floor("mn") + F.lit(0.0)).alias("imb0"),
    )
    late = F.col("seconds_in_bucket") >= 300
    flag_c = F.col("flag")
    return p.select(
        "stock_id", "date_id", "seconds_in_bucket",
        F.when(flag_c == 0, F.lit(0.0)).otherwise(F.col("imb0")).alias("imbalance_size"),
        flag_c.alias("imbalance_buy_sell_flag"),
        F.when(F.dayofmonth("d") == 29, F.lit(None))
        .otherwise((F.col("bid_price") + F.col("ask_price")) / 2 + flag_c * F.lit(0.0005))
        .alias("reference_price"),
        "matched_size",
        F.when(late, F.lit(1.0) + flag_c * (F.col("disc") + F.col("tax")) / 50).alias("far_price"),
        F.when(late, F.lit(1.0) + flag_c * F.col("disc") / 100).alias("near_price"),
        "bid_price", "bid_size", "ask_price", "ask_size",
        ((F.col("bid_price") * F.col("ask_size") + F.col("ask_price") * F.col("bid_size"))
         / (F.col("bid_size") + F.col("ask_size"))).alias("wap"),
        F.when((F.col("n") > 1) & (F.dayofmonth("d") < 4), F.lit(None))
        .otherwise((F.col("disc") - F.col("tax")) * 100 * flag_c).alias("target"),
    )


def snapshot_ordinals(df: DataFrame) -> DataFrame:
    """Dense 0-based ``time_id`` over distinct (date_id, seconds_in_bucket), any number of them: a
    distributed rank, which runs a job."""
    return ordinals(df, "date_id", "seconds_in_bucket", name="time_id").withColumn("time_id", F.col("time_id").cast("int"))


def add_time_id(df: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Attach ``time_id`` by an equi join on (date_id, seconds_in_bucket).

    The key table is small; AQE turns the join into a broadcast when its
    measured size is under the broadcast threshold and keeps a shuffle join
    otherwise. ``keys``: a table of (date_id, seconds_in_bucket, time_id) made before.
    """
    return df.join(snapshot_ordinals(df) if keys is None else keys, ["date_id", "seconds_in_bucket"])


def _calendar(days: DataFrame) -> DataFrame:
    """``time_id`` of the derived panel as one lazy plan: the window without a partition sees one
    row per date, and the seconds of a date are numbered inside it."""
    seconds = days.select("date_id", _seconds().alias("seconds_in_bucket")).distinct()
    dates = seconds.groupBy("date_id").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("date_id").rowsBetween(Window.unboundedPreceding, -1))
    place = F.row_number().over(Window.partitionBy("date_id").orderBy("seconds_in_bucket")) - 1
    return (seconds.withColumn("_i", place)
            .join(dates.select("date_id", F.coalesce(before, F.lit(0)).alias("_before")), "date_id")
            .select("date_id", "seconds_in_bucket", (F.col("_before") + F.col("_i")).cast("int").alias("time_id")))


def row_id(date_id: Column, seconds: Column, stock_id: Column) -> Column:
    return F.concat_ws("_", date_id.cast("string"), seconds.cast("string"), stock_id.cast("string"))


def snapshots_from_lineitem(lineitem: DataFrame) -> DataFrame:
    days = _days(lineitem)
    # a row per snapshot; the hint keeps the panel from being dealt anew where it is ready first
    with_t = add_time_id(_book(_daily(days)), F.broadcast(_calendar(days)))
    cols = [n for n, _ in SNAPSHOT_FIELDS if n != "row_id"]
    return with_t.select(*cols, row_id(F.col("date_id"), F.col("seconds_in_bucket"),
                                       F.col("stock_id")).alias("row_id"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot panel for one scale-factor directory."""
    return snapshots_from_lineitem(table(spark, sf_dir, "lineitem"))


def write_snapshots(df: DataFrame, path: str, partition_by: str | None = "date_id") -> None:
    """Write the panel as parquet, one folder per date, rows sorted by stock then time.

    Day folders let later jobs prune by date; sorting inside files keeps the
    per-stock windows' sort cheap. Range partitions by (date, stock) follow the
    number of rows, so a date is cut into as many tasks as it needs.
    """
    w = df.repartitionByRange("date_id", "stock_id").sortWithinPartitions(
        "date_id", "stock_id", "time_id").write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
