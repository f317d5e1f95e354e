"""Per-row order-book features (projections only; no shuffle)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auctide.functions.expr import (pair_imbalances, ratio, triplet_imbalances,
                                    triplet_imbalances_nb, with_row_moments)

# fixed values: column lists and their orders as the reference uses them
PRICES = ["reference_price", "far_price", "near_price", "ask_price", "bid_price", "wap"]
SIZES = ["matched_size", "bid_size", "ask_size", "imbalance_size"]
PRICES_V1_COMBOS = ["wap", "bid_price", "ask_price", "near_price", "far_price", "reference_price"]
NB_TRIPLET_PRICES = ["ask_price", "bid_price", "wap", "reference_price"]


def book_imbalance(df: DataFrame, on_zero: str = "null", size_ratio: str = "ask/bid") -> DataFrame:
    """volume, mid_price, size_imbalance, liquidity_imbalance, matched_imbalance.

    ``size_ratio`` is ``"ask/bid"`` (v1, v2) or ``"bid/ask"`` (notebook).
    """
    a, b = F.col("ask_size"), F.col("bid_size")
    size_imb = ratio(a, b, on_zero) if size_ratio == "ask/bid" else ratio(b, a, on_zero)
    return df.withColumns({
        "volume": a + b,
        "mid_price": (F.col("ask_price") + F.col("bid_price")) / 2,
        "size_imbalance": size_imb,
        "liquidity_imbalance": ratio(b - a, b + a, on_zero),
        "matched_imbalance": ratio(F.col("imbalance_size") - F.col("matched_size"),
                                   F.col("imbalance_size") + F.col("matched_size"), on_zero),
    })


def harmonic_imbalance(df: DataFrame, on_zero: str = "null", as_written_v2: bool = False) -> DataFrame:
    """``2 / (1/bid + 1/ask)``; ``as_written_v2`` keeps the v2 precedence ``2/(1/bid) + 1/ask``.

    A zero size makes its reciprocal infinite and the mean 0, so the closed
    form ``2ab / (a + b)`` is used (0 when both sizes are 0); with policy
    "null" a zero size gives NULL. Infinite results of the v2 precedence are
    replaced at the end of the formula, not inside it.
    """
    b, a = F.col("bid_size"), F.col("ask_size")
    if as_written_v2:
        h = 2.0 * b + ratio(F.lit(1.0), a, "null")
        if on_zero == "zero":
            h = F.when(a == 0, F.lit(0.0)).otherwise(h)
    elif on_zero == "zero":
        h = F.when(a + b == 0, F.lit(0.0)).otherwise(F.try_divide(2.0 * a * b, a + b))
    else:
        h = F.when((a != 0) & (b != 0), F.try_divide(2.0 * a * b, a + b))
    return df.withColumn("harmonic_imbalance", h)


def pair_features(df: DataFrame, names: Sequence[str] = PRICES, on_zero: str = "null") -> DataFrame:
    return df.withColumns(pair_imbalances(names, on_zero))


def triplet_features(df: DataFrame, names: Sequence[str] = PRICES, on_zero: str = "null",
                     nulls: str = "strict") -> DataFrame:
    return df.withColumns(triplet_imbalances(names, on_zero, nulls))


def triplet_features_nb(df: DataFrame) -> DataFrame:
    return df.withColumns({**triplet_imbalances_nb(NB_TRIPLET_PRICES), **triplet_imbalances_nb(SIZES)})


def pressure(df: DataFrame, on_zero: str = "null") -> DataFrame:
    """price_spread, price_pressure, market_urgency, depth_pressure, spread_depth_ratio,
    micro_price, relative_spread. Needs ``liquidity_imbalance`` (see ``book_imbalance``)."""
    ap, bp, asz, bsz = F.col("ask_price"), F.col("bid_price"), F.col("ask_size"), F.col("bid_size")
    spread = ap - bp
    return df.withColumns({
        "price_spread": spread,
        "price_pressure": F.col("imbalance_size") * spread,
        "market_urgency": F.col("liquidity_imbalance") * spread,
        "depth_pressure": (asz - bsz) * (F.col("far_price") - F.col("near_price")),
        "spread_depth_ratio": ratio(spread, asz + bsz, on_zero),
        "micro_price": ratio(bp * asz + ap * bsz, asz + bsz, on_zero),
        "relative_spread": ratio(spread, F.col("wap"), on_zero),
    })


def row_stats(df: DataFrame) -> DataFrame:
    """all_prices_* and all_sizes_* (mean, std, skew, kurt) across columns, NULLs skipped."""
    return with_row_moments(df, {"all_prices": PRICES, "all_sizes": SIZES})


def time_features(df: DataFrame, naming: str = "v1") -> DataFrame:
    """Calendar features; ``naming="nb"`` uses the notebook's names (dow, minute)."""
    s = F.col("seconds_in_bucket")
    dow, minute = ("dow", "minute") if naming == "nb" else ("day_of_week", "minutes")
    return df.withColumns({
        dow: (F.col("date_id") % 5).cast("int"),
        "seconds": (s % 60).cast("int"),
        minute: F.floor(s / 60).cast("int"),
        "time_to_market_close": (F.lit(540) - s).cast("int"),
    })
