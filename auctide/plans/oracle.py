"""DuckDB SQL for the registered queries (the independent check of each Spark plan).

Every statement starts with the snapshot-panel CTEs of FIXTURES.md (they run
unchanged on DuckDB over the ``lineitem`` view) and then states the operator
in plain SQL: per-stock windows are written as ordinary
``PARTITION BY stock_id`` windows, so they also check the chunked Spark
evaluation. Floating outputs are rounded like the Spark side.
"""

from __future__ import annotations

import re
from itertools import combinations

# fixed values: column lists, steps and parameters, stated here once more so that the SQL takes nothing from the engine
PRICES = ["reference_price", "far_price", "near_price", "ask_price", "bid_price", "wap"]
SIZES = ["matched_size", "bid_size", "ask_size", "imbalance_size"]
PRICES_V1_COMBOS = ["wap", "bid_price", "ask_price", "near_price", "far_price", "reference_price"]
NB_TRIPLET_PRICES = ["ask_price", "bid_price", "wap", "reference_price"]
V1_ROLL_COLUMNS = ["imbalance_size", "matched_size", "bid_size", "ask_size", "bid_price", "ask_price", "near_price",
                   "far_price", "reference_price"]
LAG_COLUMNS = ["matched_size", "imbalance_size", "reference_price", "imbalance_buy_sell_flag"]
DIFF_COLUMNS = ["ask_price", "bid_price", "ask_size", "bid_size", "weighted_wap", "price_spread"]
ROLL_DIFF_COLUMNS = ["bid_price", "ask_price", "bid_size", "ask_size"]
BOOK_COLS = ["volume", "mid_price", "size_imbalance", "liquidity_imbalance", "matched_imbalance"]
PRESSURE_COLS = ["price_spread", "price_pressure", "market_urgency", "depth_pressure", "spread_depth_ratio",
                 "micro_price", "relative_spread"]
ROLLED = ["30s_rolling_mean", "60s_rolling_mean", "30s_rolling_std", "60s_rolling_std", "diff",
          "diff_30s_rolling_mean", "diff_60s_rolling_mean"]
STEPS, ROLL_STEPS, WAP_LAGS = [1, 3, 5, 10], [3, 5, 10], [1, 2, 3, 4, 5, 6]
SPLIT_DAY, N_FOLDS, ML_FOLDS, GAP, TAIL_ROWS, HEAD_ROWS = 35, 3, 5, 1, 21, 5
CPCV_SPLITS, CPCV_TESTS, CPCV_PURGE, CPCV_EMBARGO = 4, 2, 1, 1
DECAY = [1 / 32, 1 / 32, 1 / 16, 1 / 8, 1 / 4, 1 / 2]
DIGITS = {"all_prices_skew": 4, "all_prices_kurt": 4, "all_sizes_skew": 4, "all_sizes_kurt": 4}
INT_BOUNDS = [("tinyint", -128, 127), ("smallint", -32768, 32767),
              ("int", -2147483648, 2147483647), ("bigint", -9223372036854775808, 9223372036854775807)]

FIXTURE_CTES = """d AS (
 SELECT l_suppkey AS stock_id, CAST(l_shipdate AS DATE) AS d, MAX(l_extendedprice) AS mx, MIN(l_extendedprice) AS mn,
  SUM(l_quantity) AS q, COUNT(*) AS n, MAX(l_discount) AS disc, MAX(l_tax) AS tax, MAX(l_returnflag) AS rf
 FROM lineitem GROUP BY 1, 2),
s AS (SELECT *, DATE_DIFF('day', DATE '1995-01-01', d) AS day_no FROM d),
r AS (SELECT *, CAST(FLOOR(day_no / 55e0) AS INT) AS date_id,
  CAST(10 * (day_no - 55 * FLOOR(day_no / 55e0)) AS INT) AS seconds_in_bucket FROM s),
p AS (SELECT CAST(stock_id AS INT) AS stock_id, date_id, seconds_in_bucket,
  CASE rf WHEN 'A' THEN -1 WHEN 'N' THEN 0 ELSE 1 END AS flag, n, d,
  1.0e0 - 0.001e0 - disc/100 AS bid_price, 1.0e0 + 0.001e0 + tax/100 AS ask_price,
  q*100 AS bid_size, FLOOR(mx)+0e0 AS ask_size, FLOOR(mx*10)+0e0 AS matched_size, FLOOR(mn)+0e0 AS imb0, disc, tax
 FROM r),
a AS (SELECT stock_id, date_id, seconds_in_bucket,
  CASE WHEN flag = 0 THEN 0e0 ELSE imb0 END AS imbalance_size, flag AS imbalance_buy_sell_flag,
  CASE WHEN DAY(d) = 29 THEN NULL ELSE (bid_price+ask_price)/2 + flag*0.0005e0 END AS reference_price, matched_size,
  CASE WHEN seconds_in_bucket >= 300 THEN 1e0 + flag*(disc+tax)/50 END AS far_price,
  CASE WHEN seconds_in_bucket >= 300 THEN 1e0 + flag*disc/100 END AS near_price,
  bid_price, bid_size, ask_price, ask_size,
  (bid_price*ask_size + ask_price*bid_size)/(bid_size+ask_size) AS wap,
  CASE WHEN n > 1 AND DAY(d) < 4 THEN NULL ELSE (disc-tax)*100*flag END AS target
 FROM p),
t AS (SELECT date_id, seconds_in_bucket, CAST(ROW_NUMBER() OVER (ORDER BY date_id, seconds_in_bucket) - 1 AS INT) AS time_id
 FROM (SELECT DISTINCT date_id, seconds_in_bucket FROM a)),
snap AS (SELECT a.*, t.time_id, CONCAT(CAST(a.date_id AS STRING),CONCAT(CHR(95),CONCAT(CAST(a.seconds_in_bucket AS STRING),CONCAT(CHR(95),CAST(a.stock_id AS STRING))))) AS row_id FROM a JOIN t ON a.date_id=t.date_id AND a.seconds_in_bucket=t.seconds_in_bucket),
wts AS (SELECT stock_id, (1 + stock_id % 7) / 1000e0 AS weight FROM (SELECT DISTINCT CAST(s_suppkey AS INT) AS stock_id FROM supplier) WHERE stock_id % 10 <> 9),
tsnap AS (SELECT * FROM snap WHERE target IS NOT NULL AND NOT isnan(target))"""

SNAP_DOUBLES = ["imbalance_size", "reference_price", "matched_size", "far_price", "near_price", "bid_price",
                "bid_size", "ask_price", "ask_size", "wap", "target"]
SNAP_COLS = ["stock_id", "date_id", "seconds_in_bucket", "imbalance_size", "imbalance_buy_sell_flag",
             "reference_price", "matched_size", "far_price", "near_price", "bid_price", "bid_size", "ask_price",
             "ask_size", "wap", "target", "time_id", "row_id"]

WSD = "PARTITION BY stock_id, date_id ORDER BY time_id"
WS = "PARTITION BY stock_id ORDER BY time_id"
KEYS = ["stock_id", "time_id"]


def qi(n: str) -> str:
    return '"' + n + '"'


def rnd(n: str, d: int | None = None) -> str:
    d = DIGITS.get(n) if d is None else d
    x = qi(n)
    if d is None:
        kept = 6 if re.search("rolling|stock_unit_|global_|index|^all_|_mae|^mae$|prediction|mean", n) else 8
        scale = f"POW(10e0, GREATEST(6e0, {kept}e0 - FLOOR(LOG10(ABS({x})))))"
        return (f"(CASE WHEN ABS({x}) < 1e-12 THEN 0e0 WHEN ABS({x}) < 1e9 THEN FLOOR({x} * {scale} + 0.5e0) / {scale} "
                f"ELSE {x} END) AS {x}")
    return f"(CASE WHEN ABS({x}) < 1e9 THEN FLOOR({x} * 1e{d} + 0.5e0) / 1e{d} ELSE {x} END) AS {x}"


def sel(src: str, doubles=(), others=(), keys=KEYS, tail: str = "") -> str:
    cols = [qi(k) for k in keys] + [qi(o) for o in others] + [rnd(c) for c in doubles]
    return f"SELECT {', '.join(cols)} FROM {src} {tail}"


def sql(*ctes: str, final: str) -> str:
    return "WITH " + ",\n".join([FIXTURE_CTES, *ctes]) + "\n" + final


def div(a: str, b: str, z: str = "null") -> str:
    if z == "null":
        return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END)"
    return f"(CASE WHEN ({b}) = 0 THEN (CASE WHEN ({a}) <> 0 THEN 0e0 END) ELSE ({a}) / ({b}) END)"


def pct(x: str, prev: str, z: str = "zero") -> str:
    if z == "zero":
        return f"(CASE WHEN ({prev}) = 0 THEN (CASE WHEN ({x}) <> 0 THEN 0e0 END) ELSE ({x}) / ({prev}) - 1 END)"
    return f"(CASE WHEN ({prev}) = 0 THEN NULL ELSE ({x}) / ({prev}) - 1 END)"


def roll(fn: str, c: str, n: int, w: str) -> str:
    fr = f"OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"(CASE WHEN COUNT({c}) {fr} = {n} THEN {fn}({c}) {fr} END)"


def lag(c: str, k: int, w: str) -> str:
    return f"LAG({c}, {k}) OVER ({w})"


def ffill(c: str) -> str:
    return f"LAST_VALUE({c} IGNORE NULLS) OVER ({WS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def triplet(a: str, b: str, c: str, z: str = "null") -> str:
    mx, mn = f"GREATEST({a}, {b}, {c})", f"LEAST({a}, {b}, {c})"
    mid = f"(({a} + {b} + {c}) - {mx} - {mn})"
    return div(f"{mx} - {mid}", f"{mid} - {mn}", z)


def triplet_nb(a: str, b: str, c: str) -> str:
    mx, mn = f"GREATEST({a}, {b}, {c})", f"LEAST({a}, {b}, {c})"
    mid = f"({a} + {b} + {c} - {mn} - {mx})"
    return f"(CASE WHEN {mid} <> {mn} THEN ({mx} - {mid}) / ({mid} - {mn}) END)"


def moments(cols, prefix: str) -> tuple[str, str, str]:
    """Three SELECT-list fragments (count/mean, central sums, statistics) for row moments."""
    cnt = " + ".join(f"(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END)" for c in cols)
    tot = " + ".join(f"COALESCE({c}, 0e0)" for c in cols)
    s1 = f"({cnt}) AS _{prefix}_n, (CASE WHEN ({cnt}) > 0 THEN ({tot}) / ({cnt}) END) AS _{prefix}_m"

    def msum(k):
        return " + ".join(f"COALESCE(POW({c} - _{prefix}_m, {k}e0), 0e0)" for c in cols)
    s2 = f"{msum(2)} AS _{prefix}_m2, {msum(3)} AS _{prefix}_m3, {msum(4)} AS _{prefix}_m4"
    n, m2, m3, m4 = f"_{prefix}_n", f"_{prefix}_m2", f"_{prefix}_m3", f"_{prefix}_m4"

    def nz(x):
        return f"(CASE WHEN ABS({x}) < 1e-14 THEN 0e0 ELSE {x} END)"
    std = f"CASE WHEN {n} > 1 THEN SQRT({m2} / ({n} - 1)) END"
    skew = (f"CASE WHEN {n} > 2 THEN CASE WHEN {nz(m2)} = 0 THEN 0e0 ELSE "
            f"({n} * SQRT({n} - 1e0) / ({n} - 2e0)) * ({nz(m3)} / POW({nz(m2)}, 1.5e0)) END END")
    num = nz(f"{n} * ({n} + 1e0) * ({n} - 1e0) * {m4}")
    den = nz(f"({n} - 2e0) * ({n} - 3e0) * POW({m2}, 2e0)")
    adj = f"(3 * POW({n} - 1e0, 2e0) / (({n} - 2e0) * ({n} - 3e0)))"
    kurt = f"CASE WHEN {n} > 3 THEN CASE WHEN {den} = 0 THEN 0e0 ELSE {num} / {den} - {adj} END END"
    s3 = (f"_{prefix}_m AS {prefix}_mean, {std} AS {prefix}_std, {skew} AS {prefix}_skew, "
          f"{kurt} AS {prefix}_kurt")
    return s1, s2, s3


MOMENT_COLS = [f"all_{g}_{m}" for g in ("prices", "sizes") for m in ("mean", "std", "skew", "kurt")]


def _moment_ctes(src: str, name: str) -> list[str]:
    p1, p2, p3 = moments(PRICES, "all_prices")
    s1, s2, s3 = moments(SIZES, "all_sizes")
    return [f"{name}1 AS (SELECT *, {p1}, {s1} FROM {src})",
            f"{name}2 AS (SELECT *, {p2}, {s2} FROM {name}1)",
            f"{name} AS (SELECT *, {p3}, {s3} FROM {name}2)"]


# ----------------------------------------------------------------------------- per-query SQL

def o_scan_snapshots():
    others = [c for c in SNAP_COLS if c not in SNAP_DOUBLES]
    return sql(final=sel("snap", SNAP_DOUBLES, [c for c in others if c not in KEYS]))


def o_preprocess_cast():
    others = [c for c in SNAP_COLS if c not in SNAP_DOUBLES]
    return sql(final=sel("tsnap", SNAP_DOUBLES, [c for c in others if c not in KEYS]))


def o_filter_target():
    return sql(final=sel("tsnap", ["target"]))


def o_downcast_schema():
    ints = ["stock_id", "date_id", "seconds_in_bucket", "imbalance_buy_sell_flag", "time_id"]
    parts = []
    for c in [x for x in SNAP_COLS if x != "row_id"]:
        lo, hi = f"CAST(MIN({c}) AS DOUBLE)", f"CAST(MAX({c}) AS DOUBLE)"
        if c in ints:
            t = "CASE " + " ".join(f"WHEN {lo} > {a} AND {hi} < {b} THEN '{n}'" for n, a, b in INT_BOUNDS) + " END"
        else:
            t = "'float'"
        parts.append(f"SELECT '{c}' AS \"column\", {lo} AS min_value, {hi} AS max_value, {t} AS narrow_type FROM snap")
    return sql(f"x AS ({' UNION ALL '.join(parts)})", final=sel("x", ["min_value", "max_value"], ["narrow_type"],
                                                                 keys=["column"]))


def o_split_offline():
    return sql(final=f"SELECT stock_id, time_id, date_id, CASE WHEN date_id <= {SPLIT_DAY} THEN 'train' "
                     "ELSE 'valid' END AS role FROM snap")


def o_ffill_zero():
    cols = ["reference_price", "far_price", "near_price"]
    body = ", ".join(f"COALESCE({ffill(c)}, 0e0) AS {c}" for c in cols)
    return sql(f"x AS (SELECT stock_id, time_id, {body} FROM snap)", final=sel("x", cols))


def o_clean_inf():
    def ieee(a, b):
        return (f"(CASE WHEN {b} = 0 THEN (CASE WHEN {a} > 0 THEN 'inf'::DOUBLE WHEN {a} < 0 THEN '-inf'::DOUBLE END)"
                f" ELSE {a} / {b} END)")

    def clean(x):
        return f"(CASE WHEN {x} IN ('inf'::DOUBLE, '-inf'::DOUBLE) THEN 0e0 ELSE {x} END)"
    x = (f"x AS (SELECT stock_id, time_id, {clean(ieee('matched_size', 'imbalance_size'))} AS matched_per_imbalance, "
         f"{clean(ieee('imbalance_size', 'imbalance_buy_sell_flag'))} AS imbalance_per_flag FROM snap)")
    return sql(x, final=sel("x", ["matched_per_imbalance", "imbalance_per_flag"]))


def o_map_weights():
    x = ("x AS (SELECT stock_id, time_id, wts.weight AS stock_weights, wap * wts.weight AS weighted_wap "
         "FROM snap LEFT JOIN wts USING (stock_id))")
    return sql(x, final=sel("x", ["stock_weights", "weighted_wap"]))


def o_join_weights():
    x = "x AS (SELECT stock_id, time_id, weight, wap * weight AS weighted_wap FROM snap JOIN wts USING (stock_id))"
    return sql(x, final=sel("x", ["weight", "weighted_wap"]))


def o_index_wap():
    j = "j AS (SELECT * FROM snap JOIN wts USING (stock_id))"
    iw = "iw AS (SELECT time_id, SUM(wap * weight) AS index_wap FROM j GROUP BY time_id)"
    x = "x AS (SELECT stock_id, time_id, weight, index_wap, wap * weight AS weighted_wap FROM j JOIN iw USING (time_id))"
    return sql(j, iw, x, final=sel("x", ["weight", "index_wap", "weighted_wap"]))


def _stock_stats_sql(src: str, prefix: str, ptp_price: str) -> str:
    return (f"SELECT stock_id, MEDIAN(bid_size) + MEDIAN(ask_size) AS {prefix}median_size, "
            f"STDDEV_SAMP(bid_size) + STDDEV_SAMP(ask_size) AS {prefix}std_size, "
            f"MAX(bid_size) - MIN(bid_size) AS {prefix}ptp_size, "
            f"MEDIAN(bid_price) + MEDIAN(ask_price) AS {prefix}median_price, "
            f"STDDEV_SAMP(bid_price) + STDDEV_SAMP(ask_price) AS {prefix}std_price, "
            f"{ptp_price} AS {prefix}ptp_price FROM {src} GROUP BY stock_id")


STAT_NAMES = ["median_size", "std_size", "ptp_size", "median_price", "std_price", "ptp_price"]


def o_stock_unit_stats():
    x = f"x AS ({_stock_stats_sql('tsnap', 'stock_unit_', 'MAX(bid_price) - MIN(bid_price)')})"
    return sql(x, final=sel("x", [f"stock_unit_{n}" for n in STAT_NAMES], keys=["stock_id"]))


def o_stock_median_descent():
    return o_stock_unit_stats()


def o_global_rank():
    return sql(final="SELECT stock_id, time_id, ROW_NUMBER() OVER (ORDER BY wap, stock_id, time_id) - 1 AS place FROM snap")


def o_global_stock_stats():
    x = (f"tr AS (SELECT * FROM tsnap WHERE date_id <= {SPLIT_DAY}), "
         f"x AS ({_stock_stats_sql('tr', 'global_', 'MAX(bid_price) - MIN(ask_price)')})")
    return sql(x, final=sel("x", [f"global_{n}" for n in STAT_NAMES], keys=["stock_id"]))


def o_add_time_id():
    return sql(final="SELECT stock_id, date_id, seconds_in_bucket, "
                     "CAST(DENSE_RANK() OVER (ORDER BY date_id, seconds_in_bucket) - 1 AS INT) AS time_id FROM snap")


def o_row_moments():
    return sql(*_moment_ctes("snap", "rm"), final=sel("rm", MOMENT_COLS))


def o_pair_imbalance():
    cols = {f"{a}_{b}_imb": div(f"{a} - {b}", f"{a} + {b}") for a, b in combinations(PRICES, 2)}
    x = "x AS (SELECT stock_id, time_id, " + ", ".join(f"{e} AS {n}" for n, e in cols.items()) + " FROM snap)"
    return sql(x, final=sel("x", list(cols)))


def o_triplet_imbalance():
    cols = {f"{a}_{b}_{c}_imb": triplet(a, b, c) for a, b, c in combinations(PRICES, 3)}
    x = "x AS (SELECT stock_id, time_id, " + ", ".join(f"{e} AS {n}" for n, e in cols.items()) + " FROM snap)"
    return sql(x, final=sel("x", list(cols)))


def o_triplet_imbalance_nb():
    cols = {f"{a}_{b}_{c}_imb2": triplet_nb(a, b, c)
            for names in (NB_TRIPLET_PRICES, SIZES) for a, b, c in combinations(names, 3)}
    x = "x AS (SELECT stock_id, time_id, " + ", ".join(f"{e} AS {n}" for n, e in cols.items()) + " FROM snap)"
    return sql(x, final=sel("x", list(cols)))


def book_sql(z: str = "null", size_ratio: str = "ask/bid") -> dict[str, str]:
    si = div("ask_size", "bid_size", z) if size_ratio == "ask/bid" else div("bid_size", "ask_size", z)
    return {
        "volume": "ask_size + bid_size",
        "mid_price": "(ask_price + bid_price) / 2",
        "size_imbalance": si,
        "liquidity_imbalance": div("bid_size - ask_size", "bid_size + ask_size", z),
        "matched_imbalance": div("imbalance_size - matched_size", "imbalance_size + matched_size", z),
    }


def pressure_sql(z: str = "null") -> dict[str, str]:
    sp = "(ask_price - bid_price)"
    return {
        "price_spread": sp,
        "price_pressure": f"imbalance_size * {sp}",
        "market_urgency": f"liquidity_imbalance * {sp}",
        "depth_pressure": "(ask_size - bid_size) * (far_price - near_price)",
        "spread_depth_ratio": div(sp, "ask_size + bid_size", z),
        "micro_price": div("bid_price * ask_size + ask_price * bid_size", "ask_size + bid_size", z),
        "relative_spread": div(sp, "wap", z),
    }


def harmonic_sql(z: str = "zero") -> str:
    if z == "zero":
        return "(CASE WHEN ask_size + bid_size = 0 THEN 0e0 ELSE 2e0 * ask_size * bid_size / (ask_size + bid_size) END)"
    return ("(CASE WHEN ask_size <> 0 AND bid_size <> 0 THEN 2e0 * ask_size * bid_size / (ask_size + bid_size) END)")


def _cols(d: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {qi(n)}" for n, e in d.items())


def o_book_imbalance():
    x = f"x AS (SELECT stock_id, time_id, {_cols(book_sql())} FROM snap)"
    return sql(x, final=sel("x", BOOK_COLS))


def o_harmonic_imbalance():
    x = f"x AS (SELECT stock_id, time_id, {harmonic_sql()} AS harmonic_imbalance FROM snap)"
    return sql(x, final=sel("x", ["harmonic_imbalance"]))


def o_pressure():
    b = f"b AS (SELECT *, {_cols(book_sql())} FROM snap)"
    x = f"x AS (SELECT stock_id, time_id, {_cols(pressure_sql())} FROM b)"
    return sql(b, x, final=sel("x", PRESSURE_COLS))


def time_sql(naming: str = "v1") -> dict[str, str]:
    dow, minute = ("dow", "minute") if naming == "nb" else ("day_of_week", "minutes")
    return {dow: "CAST(date_id % 5 AS INT)", "seconds": "CAST(seconds_in_bucket % 60 AS INT)",
            minute: "CAST(seconds_in_bucket // 60 AS INT)",
            "time_to_market_close": "CAST(540 - seconds_in_bucket AS INT)"}


def o_time_features():
    x = f"x AS (SELECT stock_id, time_id, {_cols(time_sql())} FROM snap)"
    return sql(final=f"SELECT stock_id, time_id, {_cols(time_sql())} FROM snap")


# ---------------------------------------------------------------- per (stock, date) windows

def o_wap_rolling():
    cols = {"wap_30s_rolling_mean": roll("AVG", "wap", 3, WSD), "wap_60s_rolling_mean": roll("AVG", "wap", 6, WSD),
            "wap_30s_rolling_std": roll("STDDEV_SAMP", "wap", 3, WSD),
            "wap_60s_rolling_std": roll("STDDEV_SAMP", "wap", 6, WSD)}
    return sql(f"x AS (SELECT stock_id, time_id, {_cols(cols)} FROM snap)", final=sel("x", list(cols)))


def o_wap_diff():
    return sql(f"x AS (SELECT stock_id, time_id, wap - {lag('wap', 1, WSD)} AS wap_diff FROM snap)",
               final=sel("x", ["wap_diff"]))


def o_wap_diff_rolling():
    x1 = f"x1 AS (SELECT stock_id, date_id, time_id, wap - {lag('wap', 1, WSD)} AS wap_diff FROM snap)"
    x = (f"x AS (SELECT stock_id, time_id, wap_diff, {roll('AVG', 'wap_diff', 3, WSD)} AS wap_diff_30s_rolling_mean, "
         f"{roll('AVG', 'wap_diff', 6, WSD)} AS wap_diff_60s_rolling_mean FROM x1)")
    return sql(x1, x, final=sel("x", ["wap_diff", "wap_diff_30s_rolling_mean", "wap_diff_60s_rolling_mean"]))


def o_wap_lags():
    cols = {f"wap_shift_{k}": lag("wap", k, WSD) for k in WAP_LAGS}
    return sql(f"x AS (SELECT stock_id, time_id, {_cols(cols)} FROM snap)", final=sel("x", list(cols)))


def o_wap_lag_ratio():
    cols = {f"wap_shift_{k}_ratio": div(lag("wap", k, WSD), "wap") for k in WAP_LAGS}
    return sql(f"x AS (SELECT stock_id, time_id, {_cols(cols)} FROM snap)", final=sel("x", list(cols)))


def v1_rolling_sql(src: str, name: str, columns) -> list[str]:
    first, second = {}, {}
    for c in columns:
        first.update({f"{c}_30s_rolling_mean": roll("AVG", c, 3, WSD), f"{c}_60s_rolling_mean": roll("AVG", c, 6, WSD),
                      f"{c}_30s_rolling_std": roll("STDDEV_SAMP", c, 3, WSD),
                      f"{c}_60s_rolling_std": roll("STDDEV_SAMP", c, 6, WSD),
                      f"{c}_diff": f"{c} - {lag(c, 1, WSD)}"})
        second.update({f"{c}_diff_30s_rolling_mean": roll("AVG", f"{c}_diff", 3, WSD),
                       f"{c}_diff_60s_rolling_mean": roll("AVG", f"{c}_diff", 6, WSD)})
    return [f"{name}1 AS (SELECT *, {_cols(first)} FROM {src})",
            f"{name} AS (SELECT *, {_cols(second)} FROM {name}1)"]


def o_book_rolling():
    return sql(*v1_rolling_sql("snap", "br", V1_ROLL_COLUMNS), final=sel("br", [f"{c}_{r}" for c in V1_ROLL_COLUMNS for r in ROLLED]))


def o_lead_label():
    x = f"x AS (SELECT stock_id, time_id, wap, LEAD(wap, 6) OVER ({WSD}) AS wap_t60 FROM snap)"
    return sql(x, final=sel("x", ["wap", "wap_t60"], tail="WHERE wap_t60 IS NOT NULL"))


def o_stock_return():
    x1 = f"x1 AS (SELECT *, ({div(f'LEAD(wap, 6) OVER ({WSD})', 'wap')} - 1) * 10000 AS stock_return FROM snap)"
    x = "x AS (SELECT stock_id, time_id, stock_return, stock_return - target AS index_return FROM x1)"
    return sql(x1, x, final=sel("x", ["stock_return", "index_return"]))


def o_target_from_index():
    j = "j AS (SELECT * FROM snap JOIN wts USING (stock_id))"
    iw = "iw AS (SELECT time_id, SUM(wap * weight) AS index_wap FROM j GROUP BY time_id)"
    x = (f"x AS (SELECT stock_id, time_id, target, ({div(f'LEAD(wap, 6) OVER ({WSD})', 'wap')} - "
         f"{div(f'LEAD(index_wap, 6) OVER ({WSD})', 'index_wap')}) * 10000 AS target_calc "
         f"FROM j JOIN iw USING (time_id))")
    return sql(j, iw, x, final=sel("x", ["target", "target_calc"]))


# ---------------------------------------------------------------- per stock windows

def momentum_sql(z: str, movement_missing: str = "null") -> dict[str, str]:
    move = f"CAST(SIGN(mid_price - {lag('mid_price', 5, WS)}) AS INT)"
    if movement_missing == "zero":
        move = f"COALESCE({move}, 0)"
    return {"imbalance_momentum": div(f"imbalance_size - {lag('imbalance_size', 1, WS)}", "matched_size", z),
            "spread_intensity": f"price_spread - {lag('price_spread', 1, WS)}",
            "mid_price_movement": move}


def _momentum_base() -> list[str]:
    return [f"b0 AS (SELECT *, {_cols(book_sql('zero'))} FROM snap)",
            f"b AS (SELECT *, {_cols(pressure_sql('zero'))} FROM b0)",
            f"m AS (SELECT *, {_cols(momentum_sql('zero'))} FROM b)"]


def o_mid_price_movement():
    x = 'x AS (SELECT stock_id, time_id, mid_price_movement, mid_price_movement * volume AS "mid_price*volume" FROM m)'
    return sql(*_momentum_base(), x, final=sel("x", ["mid_price*volume"], ["mid_price_movement"]))


def o_imbalance_momentum():
    return sql(*_momentum_base(), final=sel("m", ["imbalance_momentum"]))


def o_spread_intensity():
    return sql(*_momentum_base(), final=sel("m", ["spread_intensity"]))


def o_wap_momentum():
    j = "j AS (SELECT *, wap * weight AS weighted_wap FROM snap JOIN wts USING (stock_id))"
    f = f"f AS (SELECT *, {ffill('weighted_wap')} AS ww_ff FROM j)"
    x = f"x AS (SELECT stock_id, time_id, weighted_wap, {pct('ww_ff', lag('ww_ff', 6, WS))} AS wap_momentum FROM f)"
    return sql(j, f, x, final=sel("x", ["weighted_wap", "wap_momentum"]))


def lags_sql() -> dict[str, str]:
    return {f"{c}_shift_{k}": lag(c, k, WS) for c in LAG_COLUMNS for k in STEPS}


def returns_sql(z: str = "zero") -> dict[str, str]:
    return {f"{c}_ret_{k}": pct(f"{c}_ff", lag(f"{c}_ff", k, WS), z) for c in LAG_COLUMNS for k in STEPS}


def ffill_sql(cols) -> dict[str, str]:
    return {f"{c}_ff": ffill(c) for c in cols}


def o_book_lags():
    cols = lags_sql()
    ints = [n for n in cols if n.startswith("imbalance_buy_sell_flag")]
    return sql(f"x AS (SELECT stock_id, time_id, {_cols(cols)} FROM snap)",
               final=sel("x", [n for n in cols if n not in ints], ints))


def o_book_returns():
    f = f"f AS (SELECT *, {_cols(ffill_sql(LAG_COLUMNS))} FROM snap)"
    cols = returns_sql()
    return sql(f, f"x AS (SELECT stock_id, time_id, {_cols(cols)} FROM f)", final=sel("x", list(cols)))


def _diff_base() -> str:
    return ("j AS (SELECT *, wap * weight AS weighted_wap, ask_price - bid_price AS price_spread "
            "FROM snap JOIN wts USING (stock_id))")


def diffs_sql(cols, steps) -> dict[str, str]:
    return {f"{c}_diff_{k}": f"{c} - {lag(c, k, WS)}" for c in cols for k in steps}


def o_book_diffs():
    cols = diffs_sql(DIFF_COLUMNS, STEPS)
    return sql(_diff_base(), f"x AS (SELECT stock_id, time_id, {_cols(cols)} FROM j)", final=sel("x", list(cols)))


def change_sql() -> dict[str, str]:
    out = {}
    for k in ROLL_STEPS:
        out[f"price_change_diff_{k}"] = f"bid_price_diff_{k} - ask_price_diff_{k}"
    for k in ROLL_STEPS:
        out[f"size_change_diff_{k}"] = f"bid_size_diff_{k} - ask_size_diff_{k}"
    return out


def o_change_diff():
    d = diffs_sql(["bid_price", "ask_price", "bid_size", "ask_size"], ROLL_STEPS)
    x1 = f"x1 AS (SELECT stock_id, time_id, {_cols(d)} FROM j)"
    c = change_sql()
    return sql(_diff_base(), x1, f"x AS (SELECT stock_id, time_id, {_cols(c)} FROM x1)", final=sel("x", list(c)))


def rolling_diff_sql() -> dict[str, str]:
    out = {}
    for c in ROLL_DIFF_COLUMNS:
        for k in ROLL_STEPS:
            out[f"rolling_diff_{c}_{k}"] = roll("AVG", f"{c}_diff_{k}", k, WS)
            out[f"rolling_std_diff_{c}_{k}"] = roll("STDDEV_SAMP", f"{c}_diff_{k}", k, WS)
    return out


def o_rolling_diff():
    d = diffs_sql(ROLL_DIFF_COLUMNS, ROLL_STEPS)
    x1 = f"x1 AS (SELECT stock_id, time_id, {_cols(d)} FROM snap)"
    r = rolling_diff_sql()
    return sql(x1, f"x AS (SELECT stock_id, time_id, {_cols(r)} FROM x1)", final=sel("x", list(r)))


def o_tail_per_stock():
    x = ("x AS (SELECT stock_id, time_id, date_id, seconds_in_bucket, "
         "ROW_NUMBER() OVER (PARTITION BY stock_id ORDER BY time_id DESC) AS rk FROM snap)")
    return sql(x, final=f"SELECT stock_id, time_id, date_id, seconds_in_bucket FROM x WHERE rk <= {TAIL_ROWS}")


# ---------------------------------------------------------------- sorts, limits, unions, checks

def o_sorted_panel():
    return sql(final=sel("snap", ["wap"], tail="ORDER BY stock_id, time_id"))


def o_head_rows():
    return sql(final=sel("snap", ["wap"], ["date_id", "seconds_in_bucket"],
                         tail=f"ORDER BY date_id, seconds_in_bucket, stock_id LIMIT {HEAD_ROWS}"))


def o_append_snapshot():
    last = "(SELECT MAX(time_id) FROM snap)"
    h = (f"h AS (SELECT stock_id, time_id, date_id, wap, target, ROW_NUMBER() OVER "
         f"(PARTITION BY stock_id ORDER BY time_id DESC) AS rk FROM snap WHERE time_id < {last})")
    u = (f"u AS (SELECT stock_id, time_id, date_id, wap, target FROM h WHERE rk <= {TAIL_ROWS} "
         f"UNION ALL SELECT stock_id, time_id, date_id, wap, CAST(NULL AS DOUBLE) AS target FROM snap "
         f"WHERE time_id = {last})")
    return sql(h, u, final=sel("u", ["wap", "target"], ["date_id"]))


def o_eda_distinct():
    cols = ["stock_id", "date_id", "seconds_in_bucket", "time_id"]
    return sql(final="SELECT " + ", ".join(f"COUNT(DISTINCT {c}) AS n_{c}" for c in cols) + " FROM snap")


def o_eda_values():
    return sql(final="SELECT DISTINCT date_id FROM snap ORDER BY date_id")


def o_eda_duplicate_keys():
    return sql(final="SELECT stock_id, date_id, seconds_in_bucket, COUNT(*) AS n FROM snap "
                     "GROUP BY stock_id, date_id, seconds_in_bucket HAVING COUNT(*) > 1")


def o_eda_days_hist():
    per = "per AS (SELECT stock_id, COUNT(DISTINCT date_id) AS n_days FROM snap GROUP BY stock_id)"
    return sql(per, final="SELECT n_days, COUNT(*) AS n_stocks FROM per GROUP BY n_days")


def o_index_return():
    x1 = f"x1 AS (SELECT *, ({div(f'LEAD(wap, 6) OVER ({WSD})', 'wap')} - 1) * 10000 AS stock_return FROM snap)"
    x = ("x AS (SELECT time_id, AVG(stock_return - target) AS mean_index_return, "
         "COUNT(stock_return - target) AS n_stocks FROM x1 GROUP BY time_id)")
    return sql(x1, x, final=sel("x", ["mean_index_return"], ["n_stocks"], keys=["time_id"]))


# ---------------------------------------------------------------- validation splits

def _dates(name: str = "dt") -> str:
    return (f"{name} AS (SELECT date_id, CAST(ROW_NUMBER() OVER (ORDER BY date_id) - 1 AS INT) AS i, "
            f"COUNT(*) OVER () AS n FROM (SELECT DISTINCT date_id FROM snap))")


def _fold_ids(k: int) -> str:
    return f"(SELECT CAST(range AS INT) AS fold FROM range({k}))"


def o_cv_kfold():
    b = (f"b AS (SELECT date_id, CAST(NTILE({N_FOLDS}) OVER (ORDER BY date_id) - 1 AS INT) AS blk "
         f"FROM (SELECT DISTINCT date_id FROM snap))")
    per = "per AS (SELECT date_id, COUNT(*) AS n_rows FROM snap GROUP BY date_id)"
    return sql(b, per, final=f"SELECT f.fold, CASE WHEN f.fold = b.blk THEN 'valid' ELSE 'train' END AS role, "
                             f"b.date_id, per.n_rows FROM b CROSS JOIN {_fold_ids(N_FOLDS)} f "
                             f"JOIN per ON per.date_id = b.date_id")


def o_cv_group_kfold():
    k = N_FOLDS
    g = ("g AS (SELECT stock_id, COUNT(*) AS n, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, stock_id) AS i "
         "FROM snap GROUP BY stock_id)")
    zeros = "[" + ", ".join(["0"] * k) + "]::BIGINT[]"
    pick = "list_position(gk.loads, list_min(gk.loads)) - 1"
    rec = (f"gk(i, stock_id, blk, loads) AS (SELECT 0::BIGINT, NULL::INT, NULL::INT, {zeros} UNION ALL "
           f"SELECT g.i, g.stock_id, CAST({pick} AS INT), "
           f"list_transform(range({k}), lambda j: gk.loads[j + 1] + CASE WHEN j = {pick} THEN g.n ELSE 0 END) "
           f"FROM gk JOIN g ON g.i = gk.i + 1)")
    return ("WITH RECURSIVE " + ",\n".join([FIXTURE_CTES, g, rec]) + "\n" +
            f"SELECT f.fold, CASE WHEN f.fold = gk.blk THEN 'valid' ELSE 'train' END AS role, gk.stock_id "
            f"FROM gk CROSS JOIN {_fold_ids(k)} f WHERE gk.stock_id IS NOT NULL")


def o_cv_time_series():
    k, gap = N_FOLDS, GAP
    ts = f"(dt.n - {k} * (dt.n // {k + 1}) + f.fold * (dt.n // {k + 1}))"
    role = (f"CASE WHEN dt.i >= {ts} AND dt.i < {ts} + (dt.n // {k + 1}) THEN 'valid' "
            f"WHEN dt.i < {ts} - {gap} THEN 'train' END")
    x = f"x AS (SELECT f.fold, {role} AS role, dt.date_id FROM dt CROSS JOIN {_fold_ids(k)} f)"
    return sql(_dates(), x, final="SELECT * FROM x WHERE role IS NOT NULL")


def o_cv_purged_block():
    nf, gap = N_FOLDS, GAP
    fs = f"(SELECT COUNT(DISTINCT date_id) FROM snap) // {nf}"
    st, en = f"(f.fold * ({fs}))", f"(f.fold * ({fs}) + ({fs}))"
    test = f"(dt.date_id >= {en} AND dt.date_id < {en} + ({fs}))"
    train = (f"(CASE WHEN f.fold < {nf - 1} THEN ((dt.date_id >= {st} AND dt.date_id < {en} - 2) OR "
             f"dt.date_id > {en} + {gap} + 2) ELSE (dt.date_id >= {st} AND dt.date_id < {en}) END) AND NOT {test}")
    x = (f"x AS (SELECT f.fold, dt.date_id, {test} AS te, {train} AS tr FROM dt CROSS JOIN {_fold_ids(nf)} f)")
    return sql(_dates(), x, final="SELECT fold, 'train' AS role, date_id FROM x WHERE tr "
                                  "UNION ALL SELECT fold, 'valid' AS role, date_id FROM x WHERE te")


def o_cv_purged_group():
    k, gap = N_FOLDS, GAP
    gts = f"(dt.n // {k + 1})"
    s = f"(dt.n - {k} * {gts} + f.fold * {gts})"
    role = f"CASE WHEN dt.i >= {s} AND dt.i < {s} + {gts} THEN 'valid' WHEN dt.i < {s} - {gap} THEN 'train' END"
    x = f"x AS (SELECT f.fold, {role} AS role, dt.date_id FROM dt CROSS JOIN {_fold_ids(k)} f)"
    return sql(_dates(), x, final="SELECT * FROM x WHERE role IS NOT NULL")


def _cpcv_ctes() -> list[str]:
    n = CPCV_SPLITS
    blk = (f"blk AS (SELECT date_id, CAST(NTILE({n}) OVER (ORDER BY date_id) - 1 AS INT) AS b "
           f"FROM (SELECT DISTINCT date_id FROM snap))")
    pos = ("pos AS (SELECT date_id, b, ROW_NUMBER() OVER (PARTITION BY b ORDER BY date_id) - 1 AS r, "
           "COUNT(*) OVER (PARTITION BY b) AS len FROM blk)")
    # test sets: pairs x < y of block ids in lexicographic order
    comb = (f"comb AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY x.range, y.range) - 1 AS INT) AS split, "
            f"CAST(x.range AS INT) AS b1, CAST(y.range AS INT) AS b2 FROM range({n}) x JOIN range({n}) y "
            f"ON x.range < y.range)")
    mem = "mem AS (SELECT split, b1 AS b FROM comb UNION ALL SELECT split, b2 AS b FROM comb)"
    grid = ("grid AS (SELECT c.split, p.date_id, p.b, p.r, p.len, "
            "EXISTS (SELECT 1 FROM mem m WHERE m.split = c.split AND m.b = p.b) AS in_test, "
            "EXISTS (SELECT 1 FROM mem m WHERE m.split = c.split AND m.b = p.b + 1) AS before_test, "
            "EXISTS (SELECT 1 FROM mem m WHERE m.split = c.split AND m.b = p.b - 1) AS after_test, "
            "(SELECT COUNT(*) FROM mem m WHERE m.split <= c.split AND m.b = p.b) AS path_no "
            "FROM pos p CROSS JOIN (SELECT DISTINCT split FROM comb) c)")
    role = (f"CASE WHEN in_test THEN 'valid' WHEN NOT ((before_test AND r >= len - {CPCV_PURGE}) OR "
            f"(after_test AND r < {CPCV_EMBARGO})) THEN 'train' END")
    cv = (f"cv AS (SELECT split, {role} AS role, date_id, b AS block, "
          f"CASE WHEN in_test THEN CAST(path_no AS INT) END AS path FROM grid)")
    return [blk, pos, comb, mem, grid, cv]


def o_cv_cpcv():
    return sql(*_cpcv_ctes(), final="SELECT * FROM cv WHERE role IS NOT NULL")


def o_cv_paths():
    return sql(*_cpcv_ctes(), final="SELECT split, block, path, COUNT(*) AS n_keys, MIN(date_id) AS first_key "
                                    "FROM cv WHERE role = 'valid' GROUP BY split, block, path")


def _preds() -> str:
    ps = ", ".join(f"COALESCE(target, 0e0) + {k} * (wap - 1) * 100 AS p{k}" for k in range(1, 7))
    return f"pr AS (SELECT stock_id, time_id, date_id, target, bid_size + ask_size AS volume, {ps} FROM snap)"


def o_mae_by_fold():
    ps = ", ".join(f"COALESCE(target, 0e0) + {k} * (wap - 1) * 100 AS p{k}" for k in range(1, 7))
    pr = f"pr AS (SELECT date_id, target, {ps} FROM tsnap)"
    b = (f"b AS (SELECT date_id, CAST(NTILE({N_FOLDS}) OVER (ORDER BY date_id) - 1 AS INT) AS fold "
         f"FROM (SELECT DISTINCT date_id FROM tsnap))")
    lg = "lg AS (" + " UNION ALL ".join(
        f"SELECT b.fold, pr.target, 'p{k}' AS model, pr.p{k} AS p FROM pr JOIN b USING (date_id)"
        for k in range(1, 7)) + ")"
    x = "x AS (SELECT fold, model, AVG(ABS(target - p)) AS mae, COUNT(*) AS n FROM lg GROUP BY fold, model)"
    return sql(pr, b, lg, x, final=sel("x", ["mae"], ["n"], keys=["fold", "model"]))


def _ens(weights=None) -> str:
    if weights is None:
        return "(" + " + ".join(f"p{k}" for k in range(1, 7)) + ") / 6e0"
    return " + ".join(f"p{k} * {w!r}" for k, w in zip(range(1, 7), weights))


def o_ensemble_mean():
    return sql(_preds(), f"x AS (SELECT stock_id, time_id, {_ens()} AS prediction FROM pr)",
               final=sel("x", ["prediction"]))


def o_ensemble_decay():
    return sql(_preds(), f"x AS (SELECT stock_id, time_id, {_ens(DECAY)} AS prediction FROM pr)",
               final=sel("x", ["prediction"]))


def o_demean_snapshot():
    e = f"e AS (SELECT stock_id, time_id, {_ens(DECAY)} AS p FROM pr)"
    x = "x AS (SELECT stock_id, time_id, p - AVG(p) OVER (PARTITION BY time_id) AS prediction FROM e)"
    return sql(_preds(), e, x, final=sel("x", ["prediction"]))


def o_clip_predictions():
    e = f"e AS (SELECT stock_id, time_id, ({_ens(DECAY)}) * 2 AS p FROM pr)"
    x = "x AS (SELECT stock_id, time_id, LEAST(GREATEST(p, -64e0), 64e0) AS prediction FROM e)"
    return sql(_preds(), e, x, final=sel("x", ["prediction"]))


def o_zero_sum():
    e = f"e AS (SELECT stock_id, time_id, volume, {_ens()} AS p FROM pr)"
    x = ("x AS (SELECT stock_id, time_id, p - SQRT(volume) * (SUM(p) OVER (PARTITION BY time_id) / "
         "SUM(SQRT(volume)) OVER (PARTITION BY time_id)) AS prediction FROM e)")
    return sql(_preds(), e, x, final=sel("x", ["prediction"]))


def o_movement_file_order():
    x = ("x AS (SELECT stock_id, time_id, CAST(SIGN((ask_price + bid_price) / 2 - LAG((ask_price + bid_price) / 2, 5) "
         "OVER (ORDER BY time_id, stock_id)) AS INT) AS mid_price_movement FROM snap)")
    return sql(x, final="SELECT * FROM x")


# ---------------------------------------------------------------- streaming (stream output = batch SQL)

def o_stream_tail():
    x = "x AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY stock_id ORDER BY time_id DESC) AS rk FROM snap)"
    others = [c for c in SNAP_COLS if c not in SNAP_DOUBLES and c not in KEYS]
    return sql(x, final=sel("x", SNAP_DOUBLES, others, tail=f"WHERE rk <= {TAIL_ROWS}"))


def o_stream_features():
    return o_features_v2()


def o_stream_start_state():
    stale = ("tsnap AS (SELECT * REPLACE (CASE WHEN date_id < (SELECT MAX(date_id) FROM snap WHERE target IS NOT NULL) - 3 "
             "THEN reference_price END AS reference_price) FROM snap WHERE target IS NOT NULL AND NOT isnan(target))")
    head, tail = o_features_v2().split("tsnap AS (", 1)
    depth, at = 1, 0
    while depth:  # the end of the panel's definition
        depth += {"(": 1, ")": -1}.get(tail[at], 0)
        at += 1
    return head + stale + tail[at:] + " WHERE date_id = (SELECT MAX(date_id) FROM tsnap)"


def o_stream_reordered():
    planted = "date_id < 5 AND (stock_id * 7 + time_id) % 53 = 0"
    cols = {f"{c}_shift_{k}": lag(c, k, WS) for c in ("bid_price", "bid_size") for k in (1, 3, 5, 10)}
    x = f"x AS (SELECT stock_id, time_id, {_cols(cols)}, FALSE AS late FROM snap WHERE NOT ({planted}))"
    y = (f"y AS (SELECT * FROM x UNION ALL BY NAME SELECT stock_id, time_id, TRUE AS late FROM snap WHERE {planted})")
    return sql(x, y, final=sel("y", list(cols), ["late"]))


def o_stream_metrics():
    return sql(final="SELECT COUNT(*) AS rows_new, CAST(0 AS BIGINT) AS rows_late, TRUE AS all_timed, "
                     "COUNT(*) AS rows_read, COUNT(*) AS rows_in FROM snap")


# ---------------------------------------------------------------- CSV, fold rows, models

def o_scan_csv():
    return o_scan_snapshots()


def o_cv_fold_rows():
    b = (f"b AS (SELECT date_id, CAST(NTILE({N_FOLDS}) OVER (ORDER BY date_id) - 1 AS INT) AS fold "
         "FROM (SELECT DISTINCT date_id FROM snap))")
    return sql(b, final="SELECT stock_id, time_id, fold FROM snap JOIN b USING (date_id)")


def o_cv_cpcv_value():
    *front, _ = _cpcv_ctes()
    edge = ("edge AS (SELECT *, MIN(date_id) OVER (PARTITION BY split, b) AS lo, "
            "MAX(date_id) OVER (PARTITION BY split, b) AS hi FROM grid)")
    role = ("CASE WHEN in_test THEN 'valid' WHEN NOT ((before_test AND date_id > hi - 2) OR "
            "(after_test AND date_id < lo + 3)) THEN 'train' END")
    cv = (f"cv AS (SELECT split, {role} AS role, date_id, b AS block, "
          "CASE WHEN in_test THEN CAST(path_no AS INT) END AS path FROM edge)")
    return sql(*front, edge, cv, final="SELECT * FROM cv WHERE role IS NOT NULL")


_MODEL_ROWS = "m AS (SELECT tsnap.* FROM tsnap JOIN wts USING (stock_id))"


def _model_folds():
    return (f"b AS (SELECT date_id, CAST(NTILE({ML_FOLDS}) OVER (ORDER BY date_id) - 1 AS INT) AS fold "
            "FROM (SELECT DISTINCT date_id FROM m))")


def _constant(src: str, by: str, label: str = "target") -> list[str]:
    """CTEs up to ``con``: per group its rows and the mean distance from the median."""
    return [f"mid AS (SELECT {by}, MEDIAN({label}) AS med FROM {src} GROUP BY {by})",
            f"con AS (SELECT {by}, COUNT(*) AS n, AVG(ABS({label} - med)) AS constant_mae "
            f"FROM {src} JOIN mid USING ({by}) GROUP BY {by})"]


def o_gbt_cv():
    x = "x AS (SELECT m.*, b.fold FROM m JOIN b USING (date_id))"
    return sql(_MODEL_ROWS, _model_folds(), x, *_constant("x", "fold"),
               final=f"SELECT fold, n AS n_valid, (SELECT COUNT(*) FROM m) - n AS n_train, {rnd('constant_mae')}, "
                     "TRUE AS beats_constant FROM con")


def o_gbt_early_stopping():
    return sql(_MODEL_ROWS, _model_folds(),
               final="SELECT fold, COUNT(*) AS n_valid, TRUE AS best_is_minimum, 0e0 AS above_minimum, "
                     "TRUE AS rule_kept, 0e0 AS oof_gap FROM m JOIN b USING (date_id) GROUP BY fold")


def o_refit_full():
    x = "x AS (SELECT 'gbt' AS kind, target FROM m)"
    return sql(_MODEL_ROWS, x, *_constant("x", "kind"),
               final=f"SELECT kind, n, {rnd('constant_mae')}, TRUE AS beats_constant FROM con")


def o_model_roundtrip():
    return sql(_MODEL_ROWS, final=f"SELECT stock_id, time_id, {ML_FOLDS} + 1 AS models_that_agree FROM m")


def o_index_weights():
    r = f"ret AS (SELECT stock_id, LEAD(wap, 6) OVER ({WSD}) AS later, target FROM snap)"
    return sql(r, final="SELECT stock_id, COUNT(*) AS n_obs, TRUE AS fitted FROM ret "
                        "WHERE later IS NOT NULL AND target IS NOT NULL GROUP BY stock_id")


def o_index_weights_planted():
    r = f"ahead AS (SELECT stock_id, time_id, target, (LEAD(wap, 6) OVER ({WSD}) / wap - 1) * 10000 AS ret FROM snap)"
    x = ("x AS (SELECT stock_id, time_id, ret, COALESCE(weight, 0) AS weight FROM ahead LEFT JOIN wts USING (stock_id) "
         "WHERE ret IS NOT NULL AND target IS NOT NULL)")
    y = "y AS (SELECT time_id, SUM(ret * weight) + 3 AS index_ret FROM x GROUP BY time_id)"
    r2 = "g AS (SELECT 1 - 9e0 * COUNT(*) / SUM((index_ret - mean) ** 2) AS r2_index FROM y, (SELECT AVG(index_ret) AS mean FROM y))"
    z = "z AS (SELECT stock_id, COUNT(*) AS n_obs, ANY_VALUE(weight) AS weight_est, ANY_VALUE(r2_index) AS r2_index FROM x, g GROUP BY stock_id)"
    return sql(r, x, y, r2, z, final=f"SELECT stock_id, n_obs, {rnd('weight_est')}, {rnd('r2_index')} FROM z")


def o_objective_change():
    r = f"ahead AS (SELECT target, LEAD(wap, 6) OVER ({WSD}) AS later FROM m)"
    x = ("x AS (SELECT 'wap_ahead' AS stage, later AS label FROM ahead WHERE later IS NOT NULL "
         "UNION ALL SELECT 'stacked', target FROM ahead WHERE later IS NOT NULL)")
    return sql(_MODEL_ROWS, r, x, *_constant("x", "stage", "label"),
               final=f"SELECT stage, n, {rnd('constant_mae')}, TRUE AS ok FROM con")


def o_stream_score():
    return sql(_MODEL_ROWS, final="SELECT stock_id, time_id, date_id, COUNT(*) OVER (PARTITION BY time_id) AS n_scored, "
                                  "0e0 AS centre, TRUE AS in_range "
                                  "FROM m WHERE date_id = (SELECT MAX(date_id) FROM tsnap)")


# ---------------------------------------------------------------- full feature sets

PIPE_INTS = {"stock_id", "date_id", "seconds_in_bucket", "imbalance_buy_sell_flag", "time_id", "mid_price_movement",
             "day_of_week", "seconds", "minutes", "dow", "minute", "time_to_market_close",
             *[f"imbalance_buy_sell_flag_shift_{k}" for k in STEPS]}


def _pipeline_final(src: str, cols: list[str], clean: bool) -> list[str] | str:
    dbl = [c for c in cols if c not in PIPE_INTS]
    ints = [c for c in cols if c in PIPE_INTS and c not in KEYS]
    if clean:
        body = ", ".join([qi(c) for c in KEYS + ints] + [
            f"CASE WHEN {qi(c)} IN ('inf'::DOUBLE, '-inf'::DOUBLE) THEN 0e0 ELSE {qi(c)} END AS {qi(c)}" for c in dbl])
        return [f"fin AS (SELECT {body} FROM {src})"], sel("fin", dbl, ints)
    return [], sel(src, dbl, ints)


def _pipe_windows(prefix: str, src: str, z: str, movement_missing: str) -> tuple[list[str], list[str]]:
    """Per-stock stage of v2/nb as CTEs; returns (ctes, new column names)."""
    ffc = [*LAG_COLUMNS, "weighted_wap"]
    ff = {f"{c}_ff": ffill(c) for c in ffc}
    w1 = {**momentum_sql(z, movement_missing), "wap_momentum": pct("weighted_wap_ff", lag("weighted_wap_ff", 6, WS), z),
          **lags_sql(), **returns_sql(z), **diffs_sql(DIFF_COLUMNS, STEPS)}
    w2 = {**change_sql(), **rolling_diff_sql()}
    excl = ", ".join(f"{c}_ff" for c in ffc)
    ctes = [f"{prefix}f AS (SELECT *, {_cols(ff)} FROM {src})",
            f"{prefix}w1 AS (SELECT *, {_cols(w1)} FROM {prefix}f)",
            f"{prefix}w2 AS (SELECT * EXCLUDE ({excl}), {_cols(w2)} FROM {prefix}w1)"]
    return ctes, [*w1, *w2]


def _stats_cte(name: str, src: str, prefix: str, ptp: str) -> str:
    return f"{name} AS ({_stock_stats_sql(src, prefix, ptp)})"


def o_features_v1():
    z = "null"
    cols = [c for c in SNAP_COLS if c != "row_id"]
    ctes = ["v1j AS (SELECT tsnap.*, w.weight FROM tsnap JOIN wts w USING (stock_id))",
            "v1iw AS (SELECT time_id, SUM(wap * weight) AS index_wap FROM v1j GROUP BY time_id)",
            "v1b AS (SELECT v1j.*, v1iw.index_wap, v1j.wap * v1j.weight AS weighted_wap, "
            "ask_price - bid_price AS price_spread, (ask_price + bid_price) / 2 AS mid_price "
            "FROM v1j JOIN v1iw USING (time_id))"]
    cols += ["weight", "index_wap", "weighted_wap", "mid_price"]
    mom = momentum_sql(z)
    ctes.append(f"v1m AS (SELECT *, {_cols(mom)} FROM v1b)")
    cols += list(mom)
    roll_cols = ("wap", *V1_ROLL_COLUMNS)
    ctes += v1_rolling_sql("v1m", "v1r", roll_cols)
    cols += [n for c in roll_cols for n in (f"{c}_30s_rolling_mean", f"{c}_60s_rolling_mean", f"{c}_30s_rolling_std",
                                            f"{c}_60s_rolling_std", f"{c}_diff", f"{c}_diff_30s_rolling_mean",
                                            f"{c}_diff_60s_rolling_mean")]
    wl = {**{f"wap_shift_{k}_ratio": div(lag("wap", k, WSD), "wap") for k in WAP_LAGS},
          **{f"wap_shift_{k}": lag("wap", k, WSD) for k in WAP_LAGS}}
    ctes.append(f"v1l AS (SELECT *, {_cols(wl)} FROM v1r)")
    cols += list(wl)
    pairs = {f"{a}_{b}_imb": div(f"{a} - {b}", f"{a} + {b}") for a, b in combinations(PRICES_V1_COMBOS, 2)}
    trips = {f"{a}_{b}_{c}_imb": triplet(a, b, c) for a, b, c in combinations(PRICES_V1_COMBOS, 3)}
    bk = book_sql(z)
    ctes.append(f"v1p1 AS (SELECT * EXCLUDE (mid_price), {_cols({**pairs, **trips, **bk})} FROM v1l)")
    cols += list(pairs) + list(trips) + [c for c in bk if c != "mid_price"]
    pr = {k: v for k, v in pressure_sql(z).items() if k != "price_spread"}
    ctes.append(f"v1p2 AS (SELECT * EXCLUDE (price_spread), {_cols(pr)} FROM v1p1)")
    cols += list(pr)
    ctes += _moment_ctes("v1p2", "v1rm")
    cols += MOMENT_COLS
    ts = time_sql("v1")
    ctes.append(f"v1t AS (SELECT *, {_cols(ts)} FROM v1rm)")
    cols += list(ts)
    ctes.append(_stats_cte("v1st", "v1j", "stock_unit_", "MAX(bid_price) - MIN(bid_price)"))
    ctes.append("v1x AS (SELECT * FROM v1t JOIN v1st USING (stock_id))")
    cols += [f"stock_unit_{n}" for n in STAT_NAMES]
    extra, final = _pipeline_final("v1x", cols, clean=False)
    return sql(*ctes, *extra, final=final)


def o_features_v2():
    z = "zero"
    cols = [c for c in SNAP_COLS if c != "row_id"]
    ctes = ["v2j AS (SELECT tsnap.*, w.weight AS stock_weights, tsnap.wap * w.weight AS weighted_wap "
            "FROM tsnap JOIN wts w USING (stock_id))",
            "v2b AS (SELECT *, ask_price - bid_price AS price_spread, (ask_price + bid_price) / 2 AS mid_price FROM v2j)"]
    cols += ["stock_weights", "weighted_wap", "price_spread", "mid_price"]
    wc, wcols = _pipe_windows("v2", "v2b", z, "null")
    ctes += wc
    cols += wcols
    bk = {k: v for k, v in book_sql(z).items() if k != "mid_price"}
    pairs = {f"{a}_{b}_imb": div(f"{a} - {b}", f"{a} + {b}", z) for a, b in combinations(PRICES, 2)}
    trips = {f"{a}_{b}_{c}_imb": triplet(a, b, c, z) for a, b, c in combinations(PRICES, 3)}
    ctes.append(f"v2p1 AS (SELECT *, {_cols({**bk, 'harmonic_imbalance': harmonic_sql(z), **pairs, **trips})} FROM v2w2)")
    cols += [*bk, "harmonic_imbalance", *pairs, *trips]
    pr = {k: v for k, v in pressure_sql(z).items() if k != "price_spread"}
    ctes.append(f'v2p2 AS (SELECT *, {_cols(pr)}, mid_price_movement * volume AS "mid_price*volume" FROM v2p1)')
    cols += [*pr, "mid_price*volume"]
    ctes += _moment_ctes("v2p2", "v2rm")
    cols += MOMENT_COLS
    ts = time_sql("v1")
    ctes.append(f"v2t AS (SELECT *, {_cols(ts)} FROM v2rm)")
    cols += list(ts)
    ctes.append(_stats_cte("v2st", "v2j", "stock_unit_", "MAX(bid_price) - MIN(bid_price)"))
    ctes.append("v2x AS (SELECT * FROM v2t JOIN v2st USING (stock_id))")
    cols += [f"stock_unit_{n}" for n in STAT_NAMES]
    extra, final = _pipeline_final("v2x", cols, clean=True)
    return sql(*ctes, *extra, final=final)


def o_features_v2_daily():
    return o_features_v2().replace(WS, WSD)


def o_features_nb():
    z = "zero"
    cols = [c for c in SNAP_COLS if c not in ("row_id", "target")]
    ctes = ["nbj AS (SELECT tsnap.* EXCLUDE (row_id, target), w.weight AS stock_weights, "
            "tsnap.wap * w.weight AS weighted_wap FROM tsnap LEFT JOIN wts w USING (stock_id))",
            "nbb AS (SELECT *, ask_price - bid_price AS price_spread, (ask_price + bid_price) / 2 AS mid_price FROM nbj)"]
    cols += ["stock_weights", "weighted_wap", "price_spread", "mid_price"]
    wc, wcols = _pipe_windows("nb", "nbb", z, "zero")
    ctes += wc
    cols += wcols
    bk = {k: v for k, v in book_sql(z, "bid/ask").items() if k != "mid_price"}
    pairs = {f"{a}_{b}_imb": div(f"{a} - {b}", f"{a} + {b}", z) for a, b in combinations(PRICES, 2)}
    trips = {f"{a}_{b}_{c}_imb2": triplet_nb(a, b, c)
             for names in (NB_TRIPLET_PRICES, SIZES) for a, b, c in combinations(names, 3)}
    ctes.append(f"nbp1 AS (SELECT *, {_cols({**bk, **pairs, **trips})} FROM nbw2)")
    cols += [*bk, *pairs, *trips]
    pr = {k: v for k, v in pressure_sql(z).items() if k != "price_spread"}
    ctes.append(f"nbp2 AS (SELECT *, {_cols(pr)} FROM nbp1)")
    cols += list(pr)
    ctes += _moment_ctes("nbp2", "nbrm")
    cols += MOMENT_COLS
    ts = time_sql("nb")
    ctes.append(f'nbt AS (SELECT *, mid_price_movement * volume AS "mid_price*volume", '
                f"{harmonic_sql(z)} AS harmonic_imbalance, {_cols(ts)} FROM nbrm)")
    cols += ["mid_price*volume", "harmonic_imbalance", *ts]
    ctes.append(f"nbtr AS (SELECT * FROM tsnap WHERE date_id <= {SPLIT_DAY})")
    ctes.append(_stats_cte("nbst", "nbtr", "global_", "MAX(bid_price) - MIN(ask_price)"))
    ctes.append("nbx AS (SELECT * FROM nbt LEFT JOIN nbst USING (stock_id))")
    cols += [f"global_{n}" for n in STAT_NAMES]
    extra, final = _pipeline_final("nbx", cols, clean=True)
    return sql(*ctes, *extra, final=final)


ORACLES = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("o_") and callable(fn)}


def oracle_sql() -> dict[str, str]:
    return {name: fn() for name, fn in ORACLES.items()}
