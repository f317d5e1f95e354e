"""Window feature blocks.

Two partitionings occur in the reference:
  * per (stock, date) -- the v1 rolling block and the lead labels; groups hold
    at most 55 rows, so a plain window is used;
  * per stock across days -- lags, differences, returns and rolling
    statistics of v2 and the notebook; these go through
    ``series.stock_windows`` (blocks with look-back halos) so no stock is
    gathered in one task.
All frames are ROWS frames ordered by ``time_id``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from auctide.functions.expr import diff, pct_change, ratio, roll_mean, rolling, roll_std, sign_int
from auctide.operators.series import apply_stages, day_window, ffill_columns, stock_windows

# fixed values: the reference's column lists and step sizes
V1_ROLL_COLUMNS = ["imbalance_size", "matched_size", "bid_size", "ask_size", "bid_price",
                   "ask_price", "near_price", "far_price", "reference_price"]
LAG_COLUMNS = ["matched_size", "imbalance_size", "reference_price", "imbalance_buy_sell_flag"]
DIFF_COLUMNS = ["ask_price", "bid_price", "ask_size", "bid_size", "weighted_wap", "price_spread"]
ROLL_DIFF_COLUMNS = ["bid_price", "ask_price", "bid_size", "ask_size"]
STEPS = [1, 3, 5, 10]
ROLL_STEPS = [3, 5, 10]
WAP_LAGS = [1, 2, 3, 4, 5, 6]
SHORT, LONG = 3, 6  # rows in 30 s and 60 s

# ----------------------------------------------------------------------------- per (stock, date)


def rolling_block(columns: Sequence[str], w: WindowSpec) -> list[dict[str, Column]]:
    """The seven v1 features of each column: rolling mean/std over 30 s and 60 s,
    first difference and its rolling means (the difference first)."""
    sizes = {"30s": SHORT, "60s": LONG}
    means = {f"{c}_{s}_rolling_mean": (c, n) for c in [*columns, *[f"{c}_diff" for c in columns]] for s, n in sizes.items()}
    stds = {f"{c}_{s}_rolling_std": (c, n) for c in columns for s, n in sizes.items()}
    return [{f"{c}_diff": diff(c, w) for c in columns}, *rolling(means, stds, w)]


def wap_lag_block(w: WindowSpec, on_zero: str = "null") -> dict[str, Column]:
    out = {}
    for k in WAP_LAGS:
        out[f"wap_shift_{k}_ratio"] = ratio(F.lag("wap", k).over(w), F.col("wap"), on_zero)
    for k in WAP_LAGS:
        out[f"wap_shift_{k}"] = F.lag("wap", k).over(w)
    return out


def v1_rolling(df: DataFrame, columns: Sequence[str] = ("wap", *V1_ROLL_COLUMNS),
               with_wap_lags: bool = True, on_zero: str = "null", block: str | None = None) -> DataFrame:
    """v1 rolling features per (stock, date): 7 per column, plus wap lags and lag ratios."""
    stages = [lambda w: rolling_block(columns, w)]
    if with_wap_lags:
        stages.append(lambda w: wap_lag_block(w, on_zero))
    return apply_stages(df, day_window(block=block), stages)


def lead_label(df: DataFrame, col: str = "wap", k: int = 6, name: str | None = None) -> DataFrame:
    """Value ``k`` rows ahead in the same (stock, date)."""
    return df.withColumn(name or f"{col}_lead_{k}", F.lead(col, k).over(day_window()))


def stock_return(df: DataFrame, k: int = 6) -> DataFrame:
    """60 s stock return in bp, ``(wap[t+k]/wap[t] - 1) * 1e4``, and the implied index return
    ``stock_return - target``."""
    lead = F.lead("wap", k).over(day_window())
    out = df.withColumn("stock_return", (F.try_divide(lead, F.col("wap")) - 1) * 10000)
    return out.withColumn("index_return", F.col("stock_return") - F.col("target"))

# ----------------------------------------------------------------------------- per stock


def v2_stage_lags(on_zero: str, ffill_suffix: str = "_ffill"):
    def stage(w: WindowSpec) -> dict[str, Column]:
        out = {}
        for c in LAG_COLUMNS:
            ff = f"{c}{ffill_suffix}"
            for k in STEPS:
                out[f"{c}_shift_{k}"] = F.lag(c, k).over(w)
                out[f"{c}_ret_{k}"] = pct_change(F.col(ff), F.lag(ff, k).over(w), on_zero)
        for c in DIFF_COLUMNS:
            for k in STEPS:
                out[f"{c}_diff_{k}"] = diff(c, w, k)
        return out
    return stage


def diff_rolling(columns: Sequence[str], steps: Sequence[int], w: WindowSpec) -> list[dict[str, Column]]:
    """Rolling mean and std over ``k`` rows of the column's ``k``-step difference."""
    over = {f"diff_{c}_{k}": (f"{c}_diff_{k}", k) for c in columns for k in steps}
    return rolling({f"rolling_{n}": v for n, v in over.items()}, {f"rolling_std_{n}": v for n, v in over.items()}, w)


def v2_stage_rolling(w: WindowSpec) -> list[dict[str, Column]]:
    out = {}
    for k in ROLL_STEPS:
        out[f"price_change_diff_{k}"] = F.col(f"bid_price_diff_{k}") - F.col(f"ask_price_diff_{k}")
        out[f"size_change_diff_{k}"] = F.col(f"bid_size_diff_{k}") - F.col(f"ask_size_diff_{k}")
    return [out, *diff_rolling(ROLL_DIFF_COLUMNS, ROLL_STEPS, w)]


def momentum_stage(on_zero: str, movement_missing: str = "null", ffill_suffix: str = "_ffill",
                   with_wap_momentum: bool = True):
    """imbalance_momentum, spread_intensity, mid_price_movement (and wap_momentum) per stock.

    Needs ``price_spread`` and ``mid_price``; ``wap_momentum`` needs
    ``weighted_wap`` and its forward-filled twin.
    """
    def stage(w: WindowSpec) -> dict[str, Column]:
        move = sign_int(diff("mid_price", w, 5))
        if movement_missing == "zero":
            move = F.coalesce(move, F.lit(0))
        out = {
            "imbalance_momentum": ratio(diff("imbalance_size", w), F.col("matched_size"), on_zero),
            "spread_intensity": diff("price_spread", w),
            "mid_price_movement": move,
        }
        if with_wap_momentum:
            ff = f"weighted_wap{ffill_suffix}"
            out["wap_momentum"] = pct_change(F.col(ff), F.lag(ff, 6).over(w), on_zero)
        return out
    return stage


LOOKBACK_V2 = 19  # diff over 10 rows, then a rolling frame of 10 rows: 10 + 9 earlier rows


def forward_fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Forward fill per stock in time order, then 0 for what is still missing."""
    out = ffill_columns(df, columns, suffix="__ff")
    out = out.withColumns({c: F.coalesce(F.col(f"{c}__ff"), F.lit(0).cast(df.schema[c].dataType))
                           for c in columns})
    return out.drop(*[f"{c}__ff" for c in columns])


def lags(df: DataFrame, columns: Sequence[str], steps: Sequence[int]) -> DataFrame:
    st = lambda w: {f"{c}_shift_{k}": F.lag(c, k).over(w) for c in columns for k in steps}
    return stock_windows(df, [st], lookback=max(steps))


def diffs(df: DataFrame, columns: Sequence[str], steps: Sequence[int]) -> DataFrame:
    st = lambda w: {f"{c}_diff_{k}": diff(c, w, k) for c in columns for k in steps}
    return stock_windows(df, [st], lookback=max(steps))


def returns(df: DataFrame, columns: Sequence[str], steps: Sequence[int], on_zero: str = "zero") -> DataFrame:
    """Percent change per stock over forward-filled values (``x/x[t-k] - 1``)."""
    def st(w):
        return {f"{c}_ret_{k}": pct_change(F.col(f"{c}_ffill"), F.lag(f"{c}_ffill", k).over(w), on_zero)
                for c in columns for k in steps}
    out = stock_windows(df, [st], lookback=max(steps), ffill=columns)
    return out.drop(*[f"{c}_ffill" for c in columns])


def rolling_of_diffs(df: DataFrame, columns: Sequence[str] = ROLL_DIFF_COLUMNS,
                     steps: Sequence[int] = ROLL_STEPS) -> DataFrame:
    """Rolling mean/std over ``n`` rows of the ``n``-step difference, per stock."""
    def st1(w):
        return {f"{c}_diff_{k}": diff(c, w, k) for c in columns for k in steps}

    return stock_windows(df, [st1, lambda w: diff_rolling(columns, steps, w)], lookback=2 * max(steps) - 1)


def daily_stages(df: DataFrame, stages, ffill: Sequence[str] = (), suffix: str = "_ffill") -> DataFrame:
    """The same ``stages`` with windows (and forward fill) that start anew every date."""
    w = day_window()
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumns({f"{c}{suffix}": F.last(c, ignorenulls=True).over(upto) for c in ffill}) if ffill else df
    return apply_stages(df, w, stages)


def file_order_movement(df: DataFrame) -> DataFrame:
    """``mid_price_movement`` against the row five places earlier in (time, stock) order.

    The order crosses stocks and snapshots, as a difference without a
    partition does on a time-major table. The series is cut into snapshots;
    the first rows of a snapshot take their five predecessors from the ones
    before it, so only the table of snapshot sizes is ordered as a whole.
    """
    place = F.col("time_id").cast("long") * F.lit(1 << 32) + F.col("stock_id")
    d = df.withColumns({"_all": F.lit(0), "_at": place})
    out = stock_windows(d, [lambda w: {"mid_price_movement": sign_int(diff("mid_price", w, 5))}], 5,
                        key="_all", chunk="time_id", order="_at", rows=8192)
    return out.drop("_all", "_at")
