"""Ordered per-instrument series operators that never put a whole instrument in one task.

A window ``PARTITION BY stock_id ORDER BY time_id`` sends every row of a stock
to one task; with one stock holding a third of the data that task is the job.
Here a stock's series is cut into blocks of whole dates with about ``ROWS`` rows
each, by the number of rows that come before a date. Window expressions are
evaluated over ``PARTITION BY (stock_id, block)``, where a block also holds a
*halo*: the dates before it that its first ``lookback`` earlier rows lie in.
With ``lookback`` at least the longest reach of the expressions, the values on
the block's own rows are exact; halo rows are dropped afterwards. A halo is
some dates against some hundred rows.

Forward fill has no bounded reach, so it is done in two levels: the last
non-NULL value inside the block so far, else the last non-NULL value of the
earlier dates, carried along the small per-date table.

The per-date table holds one row per (stock, date); its windows are the only
per-stock sequential step and see a fraction of a stock's rows with a few
columns. A window over single dates needs no halo (``day_window``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from auctide.functions.expr import TEMP

Stage = Callable[[WindowSpec], dict[str, Column] | list[dict[str, Column]]]

KEY, CHUNK, ORDER = "stock_id", "date_id", "time_id"
#: Column with the number of a row's block, and rows of a block.
BLOCK, ROWS = "_block", 512


def day_window(key: str = KEY, chunk: str = CHUNK, order: str = ORDER, block: str | None = None) -> WindowSpec:
    """Per (stock, date) window: bounded groups, evaluated directly. After ``stock_windows`` with
    ``keep_block`` the column ``block`` saves a shuffle and a sort: a date lies in one block."""
    return Window.partitionBy(key, *([block] if block else []), chunk).orderBy(order)


def apply_stages(df: DataFrame, w: WindowSpec, stages: Sequence[Stage]) -> DataFrame:
    """Each stage's columns, or its steps' columns one after another; columns named ``TEMP...`` go with their stage."""
    for st in stages:
        found = st(w)
        for step in found if isinstance(found, list) else [found]:
            df = df.withColumns(step)
        df = df.drop(*[c for c in df.columns if c.startswith(TEMP)])
    return df


def _per_chunk(df: DataFrame, ffill: Sequence[str], key: str, chunk: str, order: str) -> DataFrame:
    """The per-date table: rows (``_cnt``), rows before (``_start``) and last known values before (``_carry_*``)."""
    # a hash aggregate over a narrow projection (partial aggregation); max_by skips NULL
    # orderings, so it yields the date's last non-NULL value
    ends = df.groupBy(key, chunk).agg(
        F.count(F.lit(1)).alias("_cnt"),
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_cl_{c}") for c in ffill])
    wk = Window.partitionBy(key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    return ends.withColumns({
        "_start": F.coalesce(F.sum("_cnt").over(wk), F.lit(0)).cast("long"),
        **{f"_carry_{c}": F.last(f"_cl_{c}", ignorenulls=True).over(wk) for c in ffill},
    }).drop(*[f"_cl_{c}" for c in ffill])


def _filled(columns: Sequence[str], suffix: str, w: WindowSpec) -> dict[str, Column]:
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return {f"{c}{suffix}": F.coalesce(F.last(c, ignorenulls=True).over(upto), F.col(f"_carry_{c}")) for c in columns}


def ffill_columns(df: DataFrame, columns: Sequence[str], suffix: str = "_ffill", key: str = KEY,
                  chunk: str = CHUNK, order: str = ORDER) -> DataFrame:
    """Forward fill per ``key`` in ``order`` (unbounded reach), without a per-key task."""
    carry = [f"_carry_{c}" for c in columns]
    out = df.join(_per_chunk(df, columns, key, chunk, order).select(key, chunk, *carry), [key, chunk])
    return out.withColumns(_filled(columns, suffix, day_window(key, chunk, order))).drop(*carry)


def along_dates(df: DataFrame, keyed: DataFrame, key: str = KEY, chunk: str = CHUNK) -> DataFrame:
    """``df`` with the columns of a table with one row per ``key``, by way of the (key, chunk) pairs: rows that
    lie dealt by them, as for ``day_window``, are not moved."""
    return df.join(df.select(key, chunk).distinct().join(keyed, key), [key, chunk])


def stock_windows(df: DataFrame, stages: Sequence[Stage], lookback: int,
                  ffill: Sequence[str] = (), ffill_suffix: str = "_ffill",
                  key: str = KEY, chunk: str = CHUNK, order: str = ORDER, rows: int = ROWS,
                  keep_block: bool = False, keyed: DataFrame | None = None, keyed_how: str = "inner",
                  derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Evaluate window ``stages`` as if over ``PARTITION BY key ORDER BY order``.

    ``stages`` are callables ``w -> {name: Column}`` applied one after another
    (a later stage may read an earlier stage's columns, which is how a rolling
    mean of a difference is written). ``lookback`` must be at least the
    largest number of earlier rows any expression reaches. ``ffill`` columns
    get a forward-filled twin ``{c}{ffill_suffix}`` before the stages run.
    ``order`` must sort chunks the same way ``chunk`` does (time_id vs date_id).
    ``rows``: about how many rows a block has. The output is partitioned by
    ``key`` and block; ``keep_block`` leaves the block's number in ``BLOCK``.
    ``keyed``: a table with one row per ``key`` whose columns come along with the
    per-date table; joined to the output it could move all its columns once more.
    ``derive`` adds columns made of a row's own values: they are made once the rows
    lie in their blocks, so no shuffle carries them.
    """
    if lookback < 1:
        raise ValueError("lookback must be >= 1")
    full = derive(df) if derive else df
    carry = [f"_carry_{c}" for c in ffill]
    wk = Window.partitionBy(key).orderBy(chunk)
    dates = _per_chunk(full, ffill, key, chunk, order).withColumn("_own", F.floor(F.col("_start") / rows))
    dates = dates.withColumn("_opens", F.coalesce(F.lag("_own").over(wk) != F.col("_own"), F.lit(True)))
    # a date serves the blocks that open within `lookback` rows after its last row; as a date has a row
    # at least, these open within as many dates
    ahead = F.collect_list(F.when(F.col("_opens"), F.struct("_start", "_own"))).over(wk.rowsBetween(1, lookback))
    reach = F.filter(ahead, lambda b: b["_start"] - lookback < F.col("_start") + F.col("_cnt"))
    dates = dates.withColumn("_in", F.concat(F.array("_own"), F.transform(reach, lambda b: b["_own"])))

    along = [c for c in keyed.columns if c != key] if keyed is not None else []
    dates = dates.select(key, chunk, "_own", "_in", *carry)
    if along:
        dates = dates.join(keyed, key, keyed_how)
    both = (df.join(dates, [key, chunk])
            .withColumn(BLOCK, F.explode("_in")).drop("_in"))
    if derive:
        both = derive(both.repartition(key, BLOCK))
        first = [key, chunk, *[c for c in full.columns if c not in (key, chunk)]]
        both = both.select(*[F.col(f"`{c}`") for c in (*first, *[c for c in both.columns if c not in first])])
    w = Window.partitionBy(key, BLOCK).orderBy(chunk, order)
    if ffill:
        both = both.withColumns(_filled(ffill, ffill_suffix, w)).drop(*carry)
    out = apply_stages(both, w, stages).filter(F.col(BLOCK) == F.col("_own")).drop("_own")
    return out if keep_block else out.drop(BLOCK)


def rank_from_end(df: DataFrame, key: str = KEY, chunk: str = CHUNK, order: str = ORDER,
                  within: int | None = None) -> DataFrame:
    """``df`` with ``_rk``: 1 for the last row of each ``key`` by ``order``, 2 for the one before, and so on.

    Rows are ranked from the end inside their chunk; the per-chunk table adds
    the number of rows in later chunks. No key is gathered in one task. Only
    chunks with a rank up to ``within`` are kept, if given.
    """
    wc = Window.partitionBy(key, chunk).orderBy(F.col(order).desc())
    rows = df.withColumn("_rk", F.row_number().over(wc))
    counts = df.groupBy(key, chunk).agg(F.count(F.lit(1)).alias("_cnt"))
    wk = Window.partitionBy(key).orderBy(F.col(chunk).desc()).rowsBetween(Window.unboundedPreceding, -1)
    later = counts.withColumn("_later", F.coalesce(F.sum("_cnt").over(wk), F.lit(0)))
    if within is not None:
        later = later.filter(F.col("_later") < within)
    return (rows.join(later.select(key, chunk, "_later"), [key, chunk])
            .withColumn("_rk", F.col("_rk") + F.col("_later")).drop("_later"))


def tail_per_key(df: DataFrame, n: int, key: str = KEY, chunk: str = CHUNK,
                 order: str = ORDER) -> DataFrame:
    """Last ``n`` rows of each ``key`` by ``order`` (``groupby(key).tail(n)``)."""
    return rank_from_end(df, key, chunk, order, within=n).filter(F.col("_rk") <= n).drop("_rk")
