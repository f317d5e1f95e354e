"""Feature-set pipelines: ``features(df, "v1" | "v2" | "nb", weights, ...)``.

Each pipeline is one lazy plan. Projections are grouped in a few
``withColumns`` stages; window work sits in two places: one (stock, date)
window stage for v1's rolling block and one chunked per-stock stage for the
lags, differences, returns and rolling statistics.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auctide.functions.expr import clean_inf
from auctide.operators import book, joins, windows
from auctide.operators.aggregates import add_stock_unit_stats, global_stock_stats, stock_unit_stats
from auctide.operators.series import BLOCK, along_dates, stock_windows


def _window_inputs(df: DataFrame) -> DataFrame:
    """Columns the window stages read that are not in the panel."""
    return df.withColumns({"price_spread": F.col("ask_price") - F.col("bid_price"),
                           "mid_price": (F.col("ask_price") + F.col("bid_price")) / 2})


def features_v1(df: DataFrame, weights: DataFrame, keep_stock_id: bool = False,
                parity: bool = False, stats: DataFrame | None = None) -> DataFrame:
    """v1: windows inside (stock, date); division by zero gives NULL.

    Plan order: all window work first on the narrow panel (the per-stock stage
    leaves the rows partitioned and sorted by (stock_id, block, date_id), which
    the per-day rolling stage reuses without another exchange), then the wide
    per-row projections. ``parity=True`` reproduces the two name-binding slips
    of the reference: ``imbalance_momentum`` overwrites ``imbalance_size`` and
    ``spread_depth_ratio`` overwrites ``ask_price``, and later steps read the
    overwritten columns. ``stats`` is a fitted per-stock table (training rows);
    without it the statistics are those of ``df``.
    """
    z = "null"
    df = joins.join_weights(df, weights)
    # side tables from the narrow panel, joined before any window
    if stats is None and not parity:
        stats = stock_unit_stats(df)
    df = joins.add_index_wap(df)
    df = stock_windows(df, [windows.momentum_stage(z, with_wap_momentum=False)], lookback=5, keep_block=True,
                       keyed=stats, derive=_window_inputs)
    df = windows.v1_rolling(df, on_zero=z, block=BLOCK).drop(BLOCK)
    df = joins.add_weighted_wap(df)
    df = book.pair_features(df, book.PRICES_V1_COMBOS, z)
    df = book.triplet_features(df, book.PRICES_V1_COMBOS, z, nulls="skip" if parity else "strict")
    df = book.book_imbalance(df, z, "ask/bid")
    df = book.pressure(df, z)
    if parity:
        df = (df.withColumn("imbalance_size", F.col("imbalance_momentum"))
              .withColumn("ask_price", F.col("spread_depth_ratio"))
              .drop("imbalance_momentum", "spread_depth_ratio"))
    df = df.drop("price_spread")
    df = book.row_stats(df)
    df = book.time_features(df, "v1")
    df = add_stock_unit_stats(df) if stats is None else _last(df, stats)
    if not keep_stock_id:
        df = df.drop("stock_id")
    return df.drop("row_id")


_FFILL = [*windows.LAG_COLUMNS, "weighted_wap"]


def _last(df: DataFrame, table: DataFrame) -> DataFrame:
    """``df`` with the columns of a per-stock table at the end."""
    along = [c for c in table.columns if c != "stock_id"]
    return df.select(*[f"`{c}`" for c in df.columns if c not in along], *along)


def _stock_stage(df: DataFrame, z: str, movement_missing: str, reset_daily: bool = False,
                 stats: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """Per-stock lags, returns, differences, momentum and rolling statistics (chunked), with the columns
    of the per-stock table ``stats``; ``reset_daily`` starts every window anew each date. Adds
    ``weighted_wap`` and the window inputs."""
    def derive(d):
        return _window_inputs(joins.add_weighted_wap(d, "stock_weights"))

    stages = [lambda w: {**windows.momentum_stage(z, movement_missing=movement_missing)(w),
                         **windows.v2_stage_lags(z)(w)},
              windows.v2_stage_rolling]
    if reset_daily:
        df = derive(df)
        df = along_dates(df, stats) if how == "inner" else df.join(stats, "stock_id", how)
        out = windows.daily_stages(df, stages, _FFILL)
    else:
        out = stock_windows(df, stages, lookback=windows.LOOKBACK_V2, ffill=_FFILL, keyed=stats, keyed_how=how,
                            derive=derive)
    return out.drop(*[f"{c}_ffill" for c in _FFILL])


def features_v2(df: DataFrame, weights: DataFrame, keep_stock_id: bool = False,
                parity: bool = False, stats: DataFrame | None = None, reset_daily: bool = False) -> DataFrame:
    """v2: windows per stock across days (inside a day with ``reset_daily``); +-inf replaced by 0
    (division policy "zero").

    ``stats`` is a fitted per-stock table (training rows); without it the
    statistics are those of ``df``.
    """
    z = "zero"
    df = joins.join_weights(df, weights, weight_col="stock_weights")
    stats = stats if stats is not None else stock_unit_stats(df)
    df = _stock_stage(df, z, "null", reset_daily, stats)
    df = book.book_imbalance(df, z, "ask/bid")
    df = book.harmonic_imbalance(df, z, as_written_v2=parity)
    df = book.pair_features(df, book.PRICES, z)
    df = book.triplet_features(df, book.PRICES, z, nulls="skip" if parity else "strict")
    df = book.pressure(df, z)
    df = df.withColumn("mid_price*volume", F.col("mid_price_movement") * F.col("volume"))
    df = book.row_stats(df)
    df = book.time_features(df, "v1")
    df = clean_inf(_last(df, stats))
    if not keep_stock_id:
        df = df.drop("stock_id")
    return df.drop("row_id")


def features_nb(df: DataFrame, weights: DataFrame, train_stats: DataFrame | None = None,
                keep_keys: bool = False, reset_daily: bool = False) -> DataFrame:
    """Notebook pipeline (``generate_all_features``): stock weights by left map,
    per-stock lags/returns/diffs/rolling, ``global_*`` statistics from the
    training rows (``train_stats``, default: statistics of ``df``)."""
    z = "zero"
    stats = train_stats if train_stats is not None else global_stock_stats(df)
    base = df.drop("row_id", "target")
    base = joins.join_weights(base, weights, how="left", weight_col="stock_weights")
    base = _stock_stage(base, z, "zero", reset_daily, stats, "left")
    base = book.book_imbalance(base, z, "bid/ask")
    base = book.pair_features(base, book.PRICES, z)
    base = book.triplet_features_nb(base)
    base = book.pressure(base, z)
    base = book.row_stats(base)
    base = base.withColumn("mid_price*volume", F.col("mid_price_movement") * F.col("volume"))
    base = book.harmonic_imbalance(base, z)
    base = clean_inf(base)
    base = book.time_features(base, "nb")
    base = _last(base, stats)
    if not keep_keys:
        base = base.drop("time_id", "date_id")
    return base


REGISTRY: dict[str, Callable[..., DataFrame]] = {"v1": features_v1, "v2": features_v2, "nb": features_nb}


def features(df: DataFrame, version: str, weights: DataFrame, **kw) -> DataFrame:
    try:
        fn = REGISTRY[version]
    except KeyError:
        raise ValueError(f"{version} is not supported.") from None
    return fn(df, weights, **kw)
