"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads ``lineitem`` of the scale-factor directory (through the
snapshot panel) and runs over the whole table. Floating outputs are rounded
(``round_stable``) so results compare across engines.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auctide.functions.expr import clean_inf, diff, ratio, round_doubles
from auctide.operators import aggregates as agg
from auctide.operators import book, folds, index_fit, joins, model, post, ranks, trees, windows
from auctide.operators.series import day_window, stock_windows, tail_per_key
from auctide.plans.features import features_nb, features_v1, features_v2
from auctide.plans.fixtures import predictions_by_rule, weights_by_rule
from auctide.sources.side_tables import downcast_plan
from auctide.session import drop_at_exit, scratch_path, stored
from auctide.sources.snapshots import (SNAPSHOT_SCHEMA, add_time_id, filter_target, preprocess,
                                       read_snapshots_csv, snapshots)
from auctide.streaming import online, sink

K = ["stock_id", "time_id"]

# fixed parameters of the registered queries (the test panel has 46 dates of 55 days, 0..45)
SPLIT_DAY = 35
N_FOLDS = 3
GAP = 1
CPCV_SPLITS, CPCV_TESTS, CPCV_PURGE, CPCV_EMBARGO = 4, 2, 1, 1
TAIL_ROWS = 21
HEAD_ROWS = 5

DIGITS = {f"all_{g}_{m}": 4 for g in ("prices", "sizes") for m in ("skew", "kurt")}


#: Statistics are sums in an order that engines choose; deviations differ in the ninth digit.
STATISTICS = re.compile(r"rolling|stock_unit_|global_|index|^all_|_mae|^mae$|prediction|mean")


def significant(name: str) -> int:
    return 7 if STATISTICS.search(name) else 9


def out(df: DataFrame) -> DataFrame:
    return round_doubles(df, 6, DIGITS, significant)


@dataclass(frozen=True)
class Inputs:
    """A scale-factor directory with its panel already stored (used by the benchmark)."""

    sf_dir: str
    panel: DataFrame


def _snap(spark, sf):
    return sf.panel if isinstance(sf, Inputs) else snapshots(spark, sf)


def _weights(spark, sf):
    return weights_by_rule(spark, sf.sf_dir if isinstance(sf, Inputs) else sf)


def _sel(df, *cols):
    return out(df.select(*K, *cols))


# ------------------------------------------------------------------ sources, filters, joins

def q_scan_snapshots(spark, sf):
    return out(_snap(spark, sf))


def q_preprocess_cast(spark, sf):
    return out(preprocess(_snap(spark, sf)))


def q_filter_target(spark, sf):
    return _sel(filter_target(_snap(spark, sf)), "target")


def q_downcast_schema(spark, sf):
    return out(downcast_plan(_snap(spark, sf).drop("row_id")))


def q_split_offline(spark, sf):
    s = _snap(spark, sf)
    return s.select(*K, "date_id", F.when(F.col("date_id") <= SPLIT_DAY, "train").otherwise("valid").alias("role"))


def q_ffill_zero(spark, sf):
    cols = ["reference_price", "far_price", "near_price"]
    s = _snap(spark, sf).select(*K, "date_id", *cols)
    return _sel(windows.forward_fill_zero(s, cols), *cols)


def _ieee_div(a, b):
    inf = float("inf")
    return F.when(b == 0, F.when(a > 0, F.lit(inf)).when(a < 0, F.lit(-inf))).otherwise(F.try_divide(a, b))


def q_clean_inf(spark, sf):
    s = _snap(spark, sf)
    raw = s.select(*K, _ieee_div(F.col("matched_size"), F.col("imbalance_size")).alias("matched_per_imbalance"),
                   _ieee_div(F.col("imbalance_size"), F.col("imbalance_buy_sell_flag")).alias("imbalance_per_flag"))
    return out(clean_inf(raw))


def q_map_weights(spark, sf):
    s = _snap(spark, sf)
    d = joins.add_weighted_wap(joins.join_weights(s, _weights(spark, sf), "left", "stock_weights"), "stock_weights")
    return _sel(d, "stock_weights", "weighted_wap")


def q_join_weights(spark, sf):
    s = _snap(spark, sf)
    d = joins.add_weighted_wap(joins.join_weights(s, _weights(spark, sf)))
    return _sel(d, "weight", "weighted_wap")


def q_index_wap(spark, sf):
    s = _snap(spark, sf)
    d = joins.add_weighted_wap(joins.add_index_wap(joins.join_weights(s, _weights(spark, sf))))
    return _sel(d, "weight", "index_wap", "weighted_wap")


def q_stock_unit_stats(spark, sf):
    return out(agg.stock_unit_stats(filter_target(_snap(spark, sf))))


def q_global_stock_stats(spark, sf):
    train = filter_target(_snap(spark, sf)).filter(F.col("date_id") <= SPLIT_DAY)
    return out(agg.global_stock_stats(train))


def q_stock_median_descent(spark, sf):
    """The per-stock statistics with medians found by narrowing ranges of values."""
    return out(agg.stock_unit_stats(filter_target(_snap(spark, sf)), median="descent"))


def q_global_rank(spark, sf):
    """Every row's place in the order of wap over the whole panel."""
    return ranks.global_rank(_snap(spark, sf).select(*K, "wap"), "wap", *K, name="place").select(*K, "place")


def q_add_time_id(spark, sf):
    s = _snap(spark, sf).drop("time_id")
    return add_time_id(s).select("stock_id", "date_id", "seconds_in_bucket", "time_id")


# ------------------------------------------------------------------ row-wise features

def q_row_moments(spark, sf):
    d = book.row_stats(_snap(spark, sf))
    return _sel(d, *[f"all_{g}_{m}" for g in ("prices", "sizes") for m in ("mean", "std", "skew", "kurt")])


def q_pair_imbalance(spark, sf):
    return _sel(book.pair_features(_snap(spark, sf), book.PRICES, "null"), *book.pair_imbalances(book.PRICES))


def q_triplet_imbalance(spark, sf):
    from auctide.functions.expr import triplet_imbalances
    names = list(triplet_imbalances(book.PRICES))
    return _sel(book.triplet_features(_snap(spark, sf), book.PRICES, "null"), *names)


def q_triplet_imbalance_nb(spark, sf):
    from auctide.functions.expr import triplet_imbalances_nb
    names = [*triplet_imbalances_nb(book.NB_TRIPLET_PRICES), *triplet_imbalances_nb(book.SIZES)]
    return _sel(book.triplet_features_nb(_snap(spark, sf)), *names)


BOOK_COLS = ["volume", "mid_price", "size_imbalance", "liquidity_imbalance", "matched_imbalance"]
PRESSURE_COLS = ["price_spread", "price_pressure", "market_urgency", "depth_pressure",
                 "spread_depth_ratio", "micro_price", "relative_spread"]


def q_book_imbalance(spark, sf):
    return _sel(book.book_imbalance(_snap(spark, sf), "null"), *BOOK_COLS)


def q_harmonic_imbalance(spark, sf):
    return _sel(book.harmonic_imbalance(_snap(spark, sf), "zero"), "harmonic_imbalance")


def q_pressure(spark, sf):
    return _sel(book.pressure(book.book_imbalance(_snap(spark, sf), "null"), "null"), *PRESSURE_COLS)


def q_time_features(spark, sf):
    return _sel(book.time_features(_snap(spark, sf)), "day_of_week", "seconds", "minutes", "time_to_market_close")


# ------------------------------------------------------------------ per (stock, date) windows

def q_wap_rolling(spark, sf):
    w = day_window()
    d = _snap(spark, sf).withColumns({
        "wap_30s_rolling_mean": windows.roll_mean("wap", 3, w), "wap_60s_rolling_mean": windows.roll_mean("wap", 6, w),
        "wap_30s_rolling_std": windows.roll_std("wap", 3, w), "wap_60s_rolling_std": windows.roll_std("wap", 6, w)})
    return _sel(d, "wap_30s_rolling_mean", "wap_60s_rolling_mean", "wap_30s_rolling_std", "wap_60s_rolling_std")


def q_wap_diff(spark, sf):
    return _sel(_snap(spark, sf).withColumn("wap_diff", diff("wap", day_window())), "wap_diff")


def q_wap_diff_rolling(spark, sf):
    w = day_window()
    d = _snap(spark, sf).withColumn("wap_diff", diff("wap", w)).withColumns({
        "wap_diff_30s_rolling_mean": windows.roll_mean("wap_diff", 3, w),
        "wap_diff_60s_rolling_mean": windows.roll_mean("wap_diff", 6, w)})
    return _sel(d, "wap_diff", "wap_diff_30s_rolling_mean", "wap_diff_60s_rolling_mean")


def q_wap_lags(spark, sf):
    w = day_window()
    d = _snap(spark, sf).withColumns({f"wap_shift_{k}": F.lag("wap", k).over(w) for k in windows.WAP_LAGS})
    return _sel(d, *[f"wap_shift_{k}" for k in windows.WAP_LAGS])


def q_wap_lag_ratio(spark, sf):
    w = day_window()
    d = _snap(spark, sf).withColumns({f"wap_shift_{k}_ratio": ratio(F.lag("wap", k).over(w), F.col("wap"))
                                      for k in windows.WAP_LAGS})
    return _sel(d, *[f"wap_shift_{k}_ratio" for k in windows.WAP_LAGS])


def book_rolling_names():
    names = []
    for c in windows.V1_ROLL_COLUMNS:
        names += [f"{c}_30s_rolling_mean", f"{c}_60s_rolling_mean", f"{c}_30s_rolling_std",
                  f"{c}_60s_rolling_std", f"{c}_diff", f"{c}_diff_30s_rolling_mean", f"{c}_diff_60s_rolling_mean"]
    return names


def q_book_rolling(spark, sf):
    d = windows.v1_rolling(_snap(spark, sf), windows.V1_ROLL_COLUMNS, with_wap_lags=False)
    return _sel(d, *book_rolling_names())


def q_lead_label(spark, sf):
    d = windows.lead_label(_snap(spark, sf), "wap", 6, "wap_t60").na.drop(subset=["wap_t60"])
    return _sel(d, "wap", "wap_t60")


def q_stock_return(spark, sf):
    return _sel(windows.stock_return(_snap(spark, sf)), "stock_return", "index_return")


def q_target_from_index(spark, sf):
    s = _snap(spark, sf)
    d = joins.add_index_wap(joins.join_weights(s, _weights(spark, sf)))
    w = day_window()
    d = d.withColumn("target_calc", (ratio(F.lead("wap", 6).over(w), F.col("wap"))
                                     - ratio(F.lead("index_wap", 6).over(w), F.col("index_wap"))) * 10000)
    return _sel(d, "target", "target_calc")


# ------------------------------------------------------------------ per stock windows (chunked)

def _momentum_input(spark, sf):
    s = _snap(spark, sf)
    return book.pressure(book.book_imbalance(s, "zero"), "zero")


def q_mid_price_movement(spark, sf):
    d = stock_windows(_momentum_input(spark, sf), [windows.momentum_stage("zero", with_wap_momentum=False)], 5)
    d = d.withColumn("mid_price*volume", F.col("mid_price_movement") * F.col("volume"))
    return _sel(d, "mid_price_movement", "mid_price*volume")


def q_movement_file_order(spark, sf):
    """``mid_price_movement`` as a difference without a partition gives it on a time-major table."""
    s = _snap(spark, sf).withColumn("mid_price", (F.col("ask_price") + F.col("bid_price")) / 2)
    return _sel(windows.file_order_movement(s), "mid_price_movement")


def q_imbalance_momentum(spark, sf):
    d = stock_windows(_momentum_input(spark, sf), [windows.momentum_stage("zero", with_wap_momentum=False)], 5)
    return _sel(d, "imbalance_momentum")


def q_spread_intensity(spark, sf):
    d = stock_windows(_momentum_input(spark, sf), [windows.momentum_stage("zero", with_wap_momentum=False)], 5)
    return _sel(d, "spread_intensity")


def q_wap_momentum(spark, sf):
    s = _snap(spark, sf)
    d = joins.add_weighted_wap(joins.join_weights(s, _weights(spark, sf), weight_col="stock_weights"), "stock_weights")
    d = stock_windows(d, [lambda w: {"wap_momentum": windows.pct_change(
        F.col("weighted_wap_ffill"), F.lag("weighted_wap_ffill", 6).over(w), "zero")}], 6, ffill=["weighted_wap"])
    return _sel(d, "weighted_wap", "wap_momentum")


def q_book_lags(spark, sf):
    d = windows.lags(_snap(spark, sf), windows.LAG_COLUMNS, windows.STEPS)
    return _sel(d, *[f"{c}_shift_{k}" for c in windows.LAG_COLUMNS for k in windows.STEPS])


def q_book_returns(spark, sf):
    d = windows.returns(_snap(spark, sf), windows.LAG_COLUMNS, windows.STEPS, "zero")
    return _sel(d, *[f"{c}_ret_{k}" for c in windows.LAG_COLUMNS for k in windows.STEPS])


def _diff_input(spark, sf):
    s = _snap(spark, sf)
    d = joins.add_weighted_wap(joins.join_weights(s, _weights(spark, sf), weight_col="stock_weights"), "stock_weights")
    return d.withColumn("price_spread", F.col("ask_price") - F.col("bid_price"))


def q_book_diffs(spark, sf):
    d = windows.diffs(_diff_input(spark, sf), windows.DIFF_COLUMNS, windows.STEPS)
    return _sel(d, *[f"{c}_diff_{k}" for c in windows.DIFF_COLUMNS for k in windows.STEPS])


def q_change_diff(spark, sf):
    d = windows.diffs(_diff_input(spark, sf), ["bid_price", "ask_price", "bid_size", "ask_size"], windows.ROLL_STEPS)
    d = d.withColumns({
        **{f"price_change_diff_{k}": F.col(f"bid_price_diff_{k}") - F.col(f"ask_price_diff_{k}") for k in windows.ROLL_STEPS},
        **{f"size_change_diff_{k}": F.col(f"bid_size_diff_{k}") - F.col(f"ask_size_diff_{k}") for k in windows.ROLL_STEPS}})
    return _sel(d, *[f"{p}_change_diff_{k}" for p in ("price", "size") for k in windows.ROLL_STEPS])


def q_rolling_diff(spark, sf):
    d = windows.rolling_of_diffs(_snap(spark, sf))
    return _sel(d, *[f"rolling_{s}diff_{c}_{k}" for c in windows.ROLL_DIFF_COLUMNS for k in windows.ROLL_STEPS
                     for s in ("", "std_")])


def q_tail_per_stock(spark, sf):
    return tail_per_key(_snap(spark, sf), TAIL_ROWS).select(*K, "date_id", "seconds_in_bucket")


# ------------------------------------------------------------------ sorts, limits, unions

def q_sorted_panel(spark, sf):
    return _sel(_snap(spark, sf).orderBy("stock_id", "time_id"), "wap")


def q_head_rows(spark, sf):
    s = _snap(spark, sf).orderBy("date_id", "seconds_in_bucket", "stock_id").limit(HEAD_ROWS)
    return _sel(s, "date_id", "seconds_in_bucket", "wap")


def q_append_snapshot(spark, sf):
    """History (last 21 rows per stock before the newest snapshot) + the newest snapshot
    without its target, unioned by name."""
    s = _snap(spark, sf)
    last = s.agg(F.max("time_id")).first()[0]  # one scalar
    hist = tail_per_key(s.filter(F.col("time_id") < last), TAIL_ROWS)
    new = s.filter(F.col("time_id") == last).drop("target")
    u = hist.select(*K, "date_id", "wap", "target").unionByName(new.select(*K, "date_id", "wap"),
                                                               allowMissingColumns=True)
    return out(u)


# ------------------------------------------------------------------ data checks

def q_eda_distinct(spark, sf):
    return agg.distinct_counts(_snap(spark, sf), ["stock_id", "date_id", "seconds_in_bucket", "time_id"])


def q_eda_values(spark, sf):
    return agg.distinct_values(_snap(spark, sf), "date_id")


def q_eda_duplicate_keys(spark, sf):
    return agg.duplicate_keys(_snap(spark, sf), ["stock_id", "date_id", "seconds_in_bucket"])


def q_eda_days_hist(spark, sf):
    return agg.days_per_stock_histogram(_snap(spark, sf))


def q_index_return(spark, sf):
    return out(agg.index_return(_snap(spark, sf)))


# ------------------------------------------------------------------ validation splits

def q_cv_kfold(spark, sf):
    s = _snap(spark, sf)
    f = folds.kfold(s, N_FOLDS)
    per_day = s.groupBy("date_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return f.join(per_day, "date_id")


def q_cv_group_kfold(spark, sf):
    return folds.group_kfold(_snap(spark, sf), N_FOLDS)


def q_cv_time_series(spark, sf):
    return folds.time_series_split(_snap(spark, sf), N_FOLDS, gap=GAP)


def q_cv_purged_block(spark, sf):
    return folds.purged_block_split(_snap(spark, sf), N_FOLDS, gap=GAP)


def q_cv_purged_group(spark, sf):
    return folds.purged_group_split(_snap(spark, sf), N_FOLDS, group_gap=GAP)


def q_cv_cpcv(spark, sf):
    return folds.cpcv(_snap(spark, sf), CPCV_SPLITS, CPCV_TESTS, CPCV_PURGE, CPCV_EMBARGO)


def q_cv_paths(spark, sf):
    c = folds.cpcv(_snap(spark, sf), CPCV_SPLITS, CPCV_TESTS, CPCV_PURGE, CPCV_EMBARGO)
    return (c.filter(F.col("role") == "valid").groupBy("split", "block", "path")
            .agg(F.count(F.lit(1)).alias("n_keys"), F.min("date_id").alias("first_key")))


def q_mae_by_fold(spark, sf):
    s = filter_target(_snap(spark, sf))
    p = predictions_by_rule(s)
    valid = folds.kfold(s, N_FOLDS).filter(F.col("role") == "valid").select("fold", "date_id")
    long = p.join(valid, "date_id").select(
        "fold", "target", F.explode(F.array(*[F.struct(F.lit(f"p{k}").alias("model"), F.col(f"p{k}").alias("p"))
                                              for k in range(1, 7)])).alias("m"))
    long = long.select("fold", "target", "m.model", "m.p")
    return out(agg.mae_by(long, "target", "p", ["fold", "model"]))


# ------------------------------------------------------------------ ensembles, post-processing

P_COLS = [f"p{k}" for k in range(1, 7)]


def _preds(spark, sf):
    return predictions_by_rule(_snap(spark, sf))


def q_ensemble_mean(spark, sf):
    return _sel(post.ensemble(_preds(spark, sf), P_COLS), "prediction")


def q_ensemble_decay(spark, sf):
    return _sel(post.ensemble(_preds(spark, sf), P_COLS, post.decay_weights(len(P_COLS))), "prediction")


def q_demean_snapshot(spark, sf):
    d = post.demean(post.ensemble(_preds(spark, sf), P_COLS, post.decay_weights(len(P_COLS))))
    return _sel(d, "prediction")


def q_clip_predictions(spark, sf):
    d = post.ensemble(_preds(spark, sf), P_COLS, post.decay_weights(len(P_COLS)))
    d = post.clip(d.withColumn("prediction", F.col("prediction") * 2), "prediction", -64.0, 64.0)
    return _sel(d, "prediction")


def q_zero_sum(spark, sf):
    d = post.zero_sum(post.ensemble(_preds(spark, sf), P_COLS), "prediction", "volume")
    return _sel(d, "prediction")


# ------------------------------------------------------------------ full feature sets

def q_features_v1(spark, sf):
    s = filter_target(_snap(spark, sf))
    return out(features_v1(s, _weights(spark, sf), keep_stock_id=True))


def q_features_v2(spark, sf):
    s = filter_target(_snap(spark, sf))
    return out(features_v2(s, _weights(spark, sf), keep_stock_id=True))


def q_features_v2_daily(spark, sf):
    """The v2 set with windows that start anew every date."""
    s = filter_target(_snap(spark, sf))
    return out(features_v2(s, _weights(spark, sf), keep_stock_id=True, reset_daily=True))


def q_features_nb(spark, sf):
    s = filter_target(_snap(spark, sf))
    stats = agg.global_stock_stats(s.filter(F.col("date_id") <= SPLIT_DAY))
    return out(features_nb(s, _weights(spark, sf), train_stats=stats, keep_keys=True))




# ------------------------------------------------------------------ streaming (file source -> keyed state)

FFILL = [*windows.LAG_COLUMNS, "wap"]


def _stream_source(spark, rows, batches=4):
    """The folder of a simulated source, and the files of one append: what a micro-batch takes."""
    path = scratch_path(spark, "stream-src")
    files = online.write_stream_files(stored(rows, "stream-rows"), path, batches=batches)
    drop_at_exit(spark, path)
    return path, files


def _fitted(spark, sf, rows):
    """Weights and per-stock statistics of ``rows``, stored: micro-batches only look them up."""
    weights = stored(_weights(spark, sf), "weights")
    return weights, stored(agg.stock_unit_stats(joins.join_weights(rows, weights)), "stats")


def _online_v2(weights, stats):
    return lambda b: online.new_rows(features_v2(b, weights, keep_stock_id=True, stats=stats))


def q_stream_features(spark, sf):
    """The v2 feature set computed online: equal to the batch result."""
    s = filter_target(_snap(spark, sf))
    weights, stats = _fitted(spark, sf, s)
    source, files = _stream_source(spark, s)
    path, _ = online.run_stream(spark, source, SNAPSHOT_SCHEMA, _online_v2(weights, stats),
                                ffill=FFILL, files_per_trigger=files, name="stream-features")
    return out(sink.read(spark, path))


def q_stream_tail(spark, sf):
    """Keyed state after the stream: the last 21 rows per stock, read from the state store."""
    source, files = _stream_source(spark, _snap(spark, sf))
    res, _ = online.run_stream(spark, source, SNAPSHOT_SCHEMA,
                               lambda b: online.new_rows(b).select(*K), files_per_trigger=files, name="stream-tail")
    return out(online.state_rows(spark, res).select(*[f.name for f in SNAPSHOT_SCHEMA.fields]))


def q_stream_start_state(spark, sf):
    """The v2 features of the last date, computed online by a stream whose state starts from a batch
    table of the dates before. Reference prices stop three dates earlier, so each stock's last known
    one is older than the rows the state keeps and must come from the carried values."""
    s = filter_target(_snap(spark, sf))
    last = s.agg(F.max("date_id")).first()[0]
    s = stored(s.withColumn("reference_price", F.when(F.col("date_id") < last - 3, F.col("reference_price"))), "start-rows")
    weights, stats = _fitted(spark, sf, s)
    initial = stored(online.history_state(s.filter(F.col("date_id") < last), FFILL), "start-state")
    source, files = _stream_source(spark, s.filter(F.col("date_id") == last), 2)
    path, _ = online.run_stream(spark, source, SNAPSHOT_SCHEMA, _online_v2(weights, stats), ffill=FFILL,
                                files_per_trigger=files, name="stream-start", initial=initial)
    return out(sink.read(spark, path))


#: The unordered stream: rows come up to this many steps late, except that every 53rd early row comes last.
STEPS_LATE, TOO_LATE, EARLY_DATES = 40, 53, 5


def q_stream_reordered(spark, sf):
    """Lagged values from a stream whose files hold rows out of order. Rows wait in the state until
    the watermark has passed them, so the lags are those of the ordered series; rows that come after
    everything else are listed (``late``) and take no part."""
    s = _snap(spark, sf).select(*[f.name for f in SNAPSHOT_SCHEMA.fields])
    last = s.agg(F.max("time_id")).first()[0]
    spread = F.pmod(F.xxhash64("row_id"), F.lit(STEPS_LATE)).cast("int")
    planted = (F.col("date_id") < EARLY_DATES) & ((F.col("stock_id") * 7 + F.col("time_id")) % TOO_LATE == 0)
    step = last // 6 + 1
    slot = F.when(planted, F.lit(6)).otherwise(F.floor(F.least(F.col("time_id") + spread, F.lit(last)) / step).cast("int"))
    path = scratch_path(spark, "stream-src")
    files = online.write_stream_files(stored(s.withColumn("slot", slot), "stream-rows"), path, by="slot", batches=7)
    online.close_stream(spark, path, SNAPSHOT_SCHEMA, last + STEPS_LATE + 2)
    drop_at_exit(spark, path)
    res, _ = online.run_stream(
        spark, path, SNAPSHOT_SCHEMA,
        lambda b: online.new_rows(windows.lags(b, ["bid_price", "bid_size"], windows.STEPS)).drop("row_id"),
        files_per_trigger=files, name="stream-reordered", delay=STEPS_LATE, list_late=True)
    names = [f"{c}_shift_{k}" for c in ("bid_price", "bid_size") for k in windows.STEPS]
    rows = sink.read(spark, res).select(*K, *names, F.lit(False).alias("late"))
    late = sink.read(spark, res, "late").select(*K, F.lit(True).alias("late"))
    return out(rows.unionByName(late, allowMissingColumns=True))


def q_stream_metrics(spark, sf):
    """What the stream's manifest says after all files: rows that came in, were new and were late, and
    whether every committed batch took time and the rows read back are those it counted."""
    source, files = _stream_source(spark, _snap(spark, sf))
    path, progress = online.run_stream(spark, source, SNAPSHOT_SCHEMA, lambda b: online.new_rows(b).select(*K),
                                       files_per_trigger=files, name="stream-metrics")
    read = sink.read(spark, path).agg(F.count(F.lit(1)).alias("rows_read"))
    per = sink.manifest(spark, path).agg(F.sum("rows_new").alias("rows_new"), F.sum("rows_late").alias("rows_late"),
                                         F.every(F.col("seconds") > 0).alias("all_timed"))
    return per.join(F.broadcast(read)).withColumn(  # one row each
        "rows_in", F.lit(sum(p.numInputRows for p in progress)).cast("long"))


# ------------------------------------------------------------------ models

#: Folds, and the most trees of a fold: the registered queries stop at one fit of ``model.FIRST`` trees.
ML_FOLDS, TREES = 5, 32


def model_features(df):
    """Feature columns of a feature set: everything but keys and target."""
    return [c for c in df.columns if c not in ("stock_id", "time_id", "date_id", "row_id", "target")]


def _model_input(spark, sf, rows=None, stats=None):
    """Training rows with the array of all v2 features, written once, and the features' names."""
    s = filter_target(_snap(spark, sf)) if rows is None else rows
    f = features_v2(s, _weights(spark, sf), keep_stock_id=True, stats=stats)
    cols = model_features(f)
    return model.training_rows(f, cols, [*K, "date_id", "target"]), cols


def _against_constant(rows, prediction, label, by, most=1.0, name="beats_constant"):
    """Per group: rows, the error of the best constant, and whether the prediction's is at most ``most`` times that."""
    m = agg.mae_by(rows, label, prediction, by).join(model.constant_mae(rows, label, by), by)
    return out(m.select(*by, "n", "constant_mae", (F.col("mae") <= most * F.col("constant_mae")).alias(name)))


def q_gbt_cv(spark, sf):
    """Five folds by date, three model kinds; rows per fold, the error of the best constant,
    and whether the averaged prediction beats it."""
    d, cols = _model_input(spark, sf)
    fit = model.fit_cv(d, cols, folds.kfold(d, ML_FOLDS), kinds=tuple(model.KINDS), limit=TREES)
    return (_against_constant(fit.oof, "prediction", "target", ["fold"]).withColumnRenamed("n", "n_valid")
            .join(fit.scores.select("fold", "n_train"), "fold"))


def q_gbt_early_stopping(spark, sf):
    """Per fold: validation rows, and how the curve of the boosted trees ended. ``best_is_minimum``: the
    kept stage has the smallest error of the curve; ``above_minimum``: that error less the curve's smallest;
    ``rule_kept``: the curve ended ``PATIENCE`` stages behind its best, or at the limit; ``oof_gap``: mean
    error of the cut model on the fold's rows less the curve's value at the kept stage."""
    d, cols = _model_input(spark, sf)
    fit = model.fit_cv(d, cols, folds.kfold(d, ML_FOLDS), limit=TREES)
    ends = fit.curves.groupBy("fold").agg(
        F.count(F.lit(1)).alias("seen"), F.min("mae").alias("low"), F.min_by("stage", "mae").alias("low_at"),
        F.max(F.when(F.col("best"), F.col("stage"))).alias("best"),
        F.max(F.when(F.col("best"), F.col("mae"))).alias("kept"))
    rule = (F.col("seen") == F.col("best") + 1 + model.PATIENCE) | (F.col("seen") == TREES)
    return fit.scores.join(ends, "fold").select(
        "fold", "n_valid", (F.col("best") == F.col("low_at")).alias("best_is_minimum"),
        (F.col("kept") - F.col("low")).alias("above_minimum"), rule.alias("rule_kept"),
        F.round(F.col("mae") - F.col("kept"), 9).alias("oof_gap"))


def q_refit_full(spark, sf):
    """Refit on all rows with the mean rescaled best iteration of five folds."""
    d, cols = _model_input(spark, sf)
    found = model.fit_cv(d, cols, folds.kfold(d, ML_FOLDS), limit=TREES)
    p = model.predict_all(d, cols, {"pred": model.refit(d, cols, "gbt", found.scores)})
    return _against_constant(p.withColumn("kind", F.lit("gbt")), "pred", "target", ["kind"])


def q_model_roundtrip(spark, sf):
    """Five fold models and the refit model written and read back; predictions must agree on every row."""
    d, cols = _model_input(spark, sf)
    _, ms = model.scoring_ensemble(d, cols, folds.kfold(d, ML_FOLDS), limit=TREES)
    path = scratch_path(spark, "models")
    trees.save(spark, ms, path)
    drop_at_exit(spark, path)
    back = trees.load(spark, path)
    both = model.predict_all(d, cols, {f"{n}_before": m for n, m in ms.items()}
                             | {f"{n}_after": m for n, m in back.items()})
    agree = [F.col(f"{n}_before").eqNullSafe(F.col(f"{n}_after")).cast("int") for n in ms]
    return both.select(*K, sum(agree[1:], agree[0]).alias("models_that_agree"))


def _returns(spark, sf):
    r = agg.stock_and_index_return(_snap(spark, sf)).na.drop(subset=["stock_return", "index_return"])
    return stored(r.select(*K, F.col("stock_return").alias("ret"), "index_return"), "returns")


def q_index_weights(spark, sf):
    """Index-weight regression: the index return implied by return and target, on the stock
    returns; per stock its observations, and whether the fit is finite, at its optimum (no slope
    is left) and explains something."""
    r = _returns(spark, sf)
    idx = r.groupBy("time_id").agg(F.avg("index_return").alias("index_ret"))
    fit = index_fit.index_weight_regression(r.select(*K, "ret"), idx)
    return fit.weights.select("stock_id", "n_obs", (~F.isnan("weight") & F.lit(fit.slope <= 1e-9)
                                                    & F.lit(0 <= fit.r2 <= 1)).alias("fitted"))


def q_index_weights_planted(spark, sf):
    """The same regression on an index with known weights: each stock's estimated weight, and the
    R^2 of the rounded weights once the planted constant of 3 bp is left out."""
    r = _returns(spark, sf)
    w = _weights(spark, sf)
    idx = (r.join(w, "stock_id", "left").groupBy("time_id")
           .agg((F.sum(F.col("ret") * F.coalesce("weight", F.lit(0.0))) + 3).alias("index_ret")))
    fit = index_fit.index_weight_regression(r.select(*K, "ret"), idx)
    return out(fit.weights.select("stock_id", "n_obs", "weight_est", F.lit(fit.r2).alias("r2_index")))


def q_objective_change(spark, sf):
    """Train on the 60 s ahead wap, derive the target through the index, then stack the
    prediction as a feature of a second fit on the target. Per stage: rows, the error of the best
    constant for the label the stage was fitted on, and whether its out-of-fold error is fine
    (``ok``): no larger in the stacked stage; at most a tenth larger in the first one, whose label,
    the wap of another day of the derived panel, cannot be told from the features."""
    s = filter_target(_snap(spark, sf))
    extra = joins.add_index_wap(joins.join_weights(s, _weights(spark, sf))).select(
        *K, "weight", "index_wap", F.lead("wap", 6).over(day_window()).alias("stock_wap_t60"))
    f = features_v2(s, _weights(spark, sf), keep_stock_id=True)
    cols = model_features(f)
    d = model.training_rows(f.join(extra, K).na.drop(subset=["stock_wap_t60"]), cols,
                            [*K, "date_id", "target", "stock_wap_t60", "wap", "weight", "index_wap"])
    fl = folds.kfold(d, ML_FOLDS)
    oof = model.fit_cv(d, cols, fl, label="stock_wap_t60", limit=TREES).oof
    p = oof.select(*K, F.col("prediction").alias("pred_stock_wap_t60")).join(d, K)
    pi = p.groupBy("time_id").agg(F.sum(F.col("pred_stock_wap_t60") * F.col("weight")).alias("pred_index_wap_t60"))
    p = p.join(pi, "time_id").withColumn(
        "pred_target", (F.try_divide(F.col("pred_stock_wap_t60"), F.col("wap"))
                        - F.try_divide(F.col("pred_index_wap_t60"), F.col("index_wap"))) * 10000)
    stacked = ["pred_stock_wap_t60", "pred_target"]
    p = stored(model.assemble(p, stacked, "_more").select(*K, "date_id", "target", F.concat("x", "_more").alias("x")),
               "stacked-rows")
    oof2 = model.fit_cv(p, [*cols, *stacked], fl, limit=TREES).oof
    first = _against_constant(oof.withColumn("stage", F.lit("wap_ahead")), "prediction", "stock_wap_t60", ["stage"],
                              most=1.1, name="ok")
    second = _against_constant(oof2.withColumn("stage", F.lit("stacked")), "prediction", "target", ["stage"], name="ok")
    return first.unionByName(second)


def score_last_day(spark, sf, files_per_trigger=None):
    """Online scoring of the last date: five fold models, the refit model and the statistics come from
    the days before it, and so does the keyed state the stream starts with; decay-weighted ensemble,
    de-meaned per snapshot (``centred``), clipped to [-64, 64] (``prediction``). ``files_per_trigger``:
    by default those of one append."""
    s = stored(filter_target(_snap(spark, sf)), "score-rows")
    last = s.agg(F.max("date_id")).first()[0]
    hist = s.filter(F.col("date_id") < last)
    weights, stats = _fitted(spark, sf, hist)
    d, cols = _model_input(spark, sf, hist, stats)
    _, ms = model.scoring_ensemble(d, cols, folds.kfold(d, ML_FOLDS), limit=TREES)
    decay = post.decay_weights(len(ms))
    features = _online_v2(weights, stats)

    def score(batch):
        p = model.predict_all(features(batch), cols, ms)
        return post.ensemble(p, list(ms), decay).select(*K, "date_id", "prediction")

    initial = stored(online.history_state(hist, FFILL), "score-state")
    source, files = _stream_source(spark, s.filter(F.col("date_id") == last), 2)
    path, _ = online.run_stream(spark, source, SNAPSHOT_SCHEMA, score, ffill=FFILL,
                                files_per_trigger=files_per_trigger or files, name="stream-score", initial=initial)
    centred = post.demean(sink.read(spark, path), name="centred")
    return post.clip(centred.withColumn("prediction", F.col("centred")))


def q_stream_score(spark, sf):
    """Scores of the last date: rows of each snapshot, the mean of its centred scores, and whether
    the clipped ones are in range."""
    p = stored(score_last_day(spark, sf), "scores")
    per = p.groupBy("time_id").agg(F.count(F.lit(1)).alias("n_scored"), F.round(F.avg("centred"), 6).alias("m"))
    return p.join(per, "time_id").select(*K, "date_id", "n_scored", (F.col("m") + 0.0).alias("centre"),
                                         F.col("prediction").between(-64, 64).alias("in_range"))


def q_scan_csv(spark, sf):
    """The panel written as CSV with ``NaN`` text for missing prices, read back with the declared
    schema: equal to the panel, missing values NULL."""
    s = _snap(spark, sf)
    path = scratch_path(spark, "panel-csv")
    gaps = {c: F.coalesce(F.col(c), F.lit(float("nan"))) for c in ("reference_price", "far_price", "near_price")}
    s.withColumns(gaps).write.option("header", True).csv(path)
    drop_at_exit(spark, path)
    return out(read_snapshots_csv(spark, path))


def q_cv_fold_rows(spark, sf):
    """Panel rows of each validation fold (P3)."""
    s = _snap(spark, sf)
    f = folds.kfold(s, N_FOLDS)
    parts = [folds.assign(s, f, i, "valid").select(*K, F.lit(i).alias("fold")) for i in range(N_FOLDS)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows


def q_cv_cpcv_value(spark, sf):
    """CPCV with gaps in key units instead of key counts."""
    return folds.cpcv(_snap(spark, sf), CPCV_SPLITS, CPCV_TESTS, 2, 3, gap_kind="value")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
