"""Leak-safe validation splits as fold tables ``(fold, role, key)``.

A fold table is joined back to the panel (``assign``), never turned into row
index arrays. Fold tables are built from the *distinct* keys, of any number and
type; a key's place among them is a distributed rank (``ranks.ordinals``), and
contiguous blocks of keys follow from it by arithmetic. Each key is expanded to
the folds by ``explode`` over a fold-id array and tagged by a range predicate --
no cross join. Parameters that shape the table (counts, sizes) come from one
scalar count when the rule needs it.
"""

from __future__ import annotations

import math
from itertools import accumulate, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auctide.operators.ranks import global_rank, ordinals

INF = math.inf


def _ordinals(df: DataFrame, key: str) -> DataFrame:
    return ordinals(df, key, name="_i").withColumn("_i", F.col("_i").cast("int"))


def _blocks(df: DataFrame, key: str, n: int) -> DataFrame:
    """Distinct keys in ``n`` contiguous blocks, the first ones a key larger where they do not divide:
    ``_b`` the block, ``_r`` the key's place in it, ``_len`` the block's keys."""
    keys = _ordinals(df, key)
    size, larger = divmod(keys.count(), n)
    i, cut = F.col("_i"), larger * (size + 1)
    b = F.when(i < cut, F.floor(i / (size + 1))).otherwise(larger + F.floor((i - cut) / max(size, 1)))
    return keys.withColumn("_b", b.cast("int")).withColumns({
        "_r": (i - F.col("_b") * size - F.least(F.col("_b"), F.lit(larger))).cast("int"),
        "_len": F.lit(size) + F.when(F.col("_b") < larger, 1).otherwise(0)})


def _n_keys(df: DataFrame, key: str) -> int:
    return df.select(key).distinct().count()


def _expand(keys: DataFrame, n_folds: int, role: Column, key: str, fold_name: str = "fold") -> DataFrame:
    """One row per (key, fold) with ``role`` evaluated on column ``_f``; rows with NULL role dropped."""
    out = keys.withColumn("_f", F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))))
    out = out.withColumn("role", role).filter(F.col("role").isNotNull())
    return out.select(F.col("_f").alias(fold_name), "role", key)


def kfold(df: DataFrame, n_splits: int = 5, key: str = "date_id") -> DataFrame:
    """Contiguous blocks of sorted distinct keys; the first ``n % k`` blocks hold one more."""
    role = F.when(F.col("_f") == F.col("_b"), F.lit("valid")).otherwise(F.lit("train"))
    return _expand(_blocks(df, key, n_splits), n_splits, role, key)


def time_series_split(df: DataFrame, n_splits: int = 5, gap: int = 0, key: str = "date_id",
                      max_train_size: int | None = None) -> DataFrame:
    """Expanding-window split: ``test = n // (k+1)`` keys per fold, training ends ``gap`` keys earlier."""
    n = _n_keys(df, key)
    n_folds = n_splits + 1
    if n_folds > n:
        raise ValueError(f"{n} keys cannot fill {n_folds} folds")
    test_size = n // n_folds
    if n - gap - test_size * n_splits <= 0:
        raise ValueError("Too many splits or too large a gap for the number of samples.")
    first = n - n_splits * test_size
    ts = F.lit(first) + F.col("_f") * test_size
    i = F.col("_i")
    train_lo = F.lit(0) if max_train_size is None else F.greatest(ts - gap - max_train_size, F.lit(0))
    role = (F.when((i >= ts) & (i < ts + test_size), F.lit("valid"))
            .when((i >= train_lo) & (i < ts - gap), F.lit("train")))
    return _expand(_ordinals(df, key), n_splits, role, key)


def purged_block_split(df: DataFrame, n_folds: int = 5, fold_size: int | None = None, gap: int = 5,
                       key: str = "date_id", parity: bool = False) -> DataFrame:
    """Notebook folds on key *values*: test ``[end, end+size)``; train ``[start, end-2)`` plus
    keys after ``end+gap+2``; the last fold trains on ``[start, end)``.

    Default removes test keys from train; ``parity=True`` keeps the overlap of the reference.
    """
    if fold_size is None:
        fold_size = _n_keys(df, key) // n_folds
    d, f = F.col(key), F.col("_f")
    start = f * fold_size
    end = start + fold_size
    test = (d >= end) & (d < end + fold_size)
    train_mid = ((d >= start) & (d < end - 2)) | (d > end + gap + 2)
    train_last = (d >= start) & (d < end)
    train = F.when(f < n_folds - 1, train_mid).otherwise(train_last)
    if not parity:
        train = train & ~test
    keys = df.select(key).distinct()
    out = keys.withColumn("_f", F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))))
    tr = out.filter(train).select(F.col("_f").alias("fold"), F.lit("train").alias("role"), key)
    te = out.filter(test).select(F.col("_f").alias("fold"), F.lit("valid").alias("role"), key)
    return tr.unionByName(te)


def purged_group_split(df: DataFrame, n_splits: int = 5, group_gap: int = 0,
                       max_train_group_size: float = INF, max_test_group_size: float = INF,
                       key: str = "date_id") -> DataFrame:
    """Purged group time-series split over sorted distinct groups (k+1 folds, gap in groups)."""
    n = _n_keys(df, key)
    n_folds = n_splits + 1
    if n_folds > n:
        raise ValueError(f"{n} groups cannot fill {n_folds} folds")
    gts = int(min(n // n_folds, max_test_group_size))
    first = n - n_splits * gts
    s = F.lit(first) + F.col("_f") * gts
    i = F.col("_i")
    lo = F.lit(0) if max_train_group_size == INF else F.greatest(s - group_gap - int(max_train_group_size), F.lit(0))
    role = (F.when((i >= s) & (i < s + gts), F.lit("valid"))
            .when((i >= lo) & (i < s - group_gap), F.lit("train")))
    return _expand(_ordinals(df, key), n_splits, role, key)


def _greedy_runs(sizes: list[tuple[int, int]], n_splits: int) -> list[tuple]:
    """``(size, from rank, to rank, folds in turn)`` of the greedy pass, from (size, groups) pairs.

    Once the loads lie within one group of each other, groups of that size go
    round the folds in a fixed order, so a size costs a few steps however many
    groups have it.
    """
    loads, out = [0] * n_splits, []
    for size, groups in sizes:
        at = 0
        while at < groups:
            order = sorted(range(n_splits), key=lambda x: (loads[x], x))
            if loads[order[-1]] - loads[order[0]] < size:
                out.append((size, at, groups, order))
                full, rest = divmod(groups - at, n_splits)
                for i, j in enumerate(order):
                    loads[j] += size * (full + (i < rest))
                break
            j, nxt = order[0], order[1]
            run = max(1, min(groups - at, (loads[nxt] - loads[j]) // size))
            out.append((size, at, at + run, [j]))
            loads[j] += size * run
            at += run
    return out


def group_kfold(df: DataFrame, n_splits: int = 5, group: str = "stock_id") -> DataFrame:
    """Greedy group k-fold: groups by size (desc, then id), each to the currently lightest fold.

    The greedy pass runs over the histogram of group sizes (one row per
    distinct size reaches the driver); a group finds its fold by its rank
    among the groups of its size, which is its rank among all groups less
    the groups that are larger.
    """
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    hist = [(r["_n"], r["count"]) for r in counts.groupBy("_n").count().orderBy(F.col("_n").desc()).collect()]
    if sum(m for _, m in hist) < n_splits:
        raise ValueError(f"{sum(m for _, m in hist)} groups cannot fill {n_splits} folds")
    larger = dict(zip([size for size, _ in hist], accumulate([0, *[m for _, m in hist]])))
    runs = df.sparkSession.createDataFrame(
        [(size, larger[size] + lo, larger[size] + hi, turn) for size, lo, hi, turn in _greedy_runs(hist, n_splits)],
        "_size long, _from long, _to long, _turn array<int>")
    r = F.col("_rank")
    table = (global_rank(counts, F.col("_n").desc(), F.col(group), name="_rank")
             .join(runs, (F.col("_n") == F.col("_size")) & (r >= F.col("_from")) & (r < F.col("_to")))
             .select(group, F.element_at("_turn", ((r - F.col("_from")) % F.size("_turn") + 1).cast("int")).alias("_b")))
    role = F.when(F.col("_f") == F.col("_b"), F.lit("valid")).otherwise(F.lit("train"))
    return _expand(table, n_splits, role, group)


def cpcv(df: DataFrame, n_splits: int = 5, n_tests: int = 2, purge_gap: int | float = 0,
         embargo_gap: int | float = 0, key: str = "date_id", gap_kind: str = "count",
         parity: bool = False) -> DataFrame:
    """Combinatorial purged cross-validation as ``(split, role, key, block, path)``.

    Keys are cut into ``n_splits`` contiguous blocks; each of the C(n, t)
    splits tests ``n_tests`` blocks (lexicographic order). A training block
    just before a test block loses its last ``purge_gap`` keys, one just after
    loses its first ``embargo_gap`` keys. ``gap_kind="value"`` measures the
    gaps in key units instead of key counts. ``path`` numbers the backtest
    path a test block belongs to. ``parity=True`` makes an integer purge gap
    of 0 drop the whole block, as the reference does.
    """
    if n_tests >= n_splits:
        raise ValueError(f"{n_tests} test blocks need more than {n_splits} blocks")
    if gap_kind == "count" and not all(isinstance(g, int) for g in (purge_gap, embargo_gap)):
        raise TypeError("gaps counted in keys must be whole numbers; use gap_kind='value' for lengths")
    combos = [list(c) for c in combinations(range(n_splits), n_tests)]
    n_comb = len(combos)
    keys = _blocks(df, key, n_splits)
    if gap_kind == "value":
        edges = keys.groupBy("_b").agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
        keys = keys.join(F.broadcast(edges), "_b")  # n_splits rows
    combos_lit = F.array(*[F.array(*[F.lit(b) for b in c]) for c in combos])
    x = keys.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(n_comb - 1))))
    test_set = F.element_at(combos_lit, F.col("_s") + 1)
    b = F.col("_b")
    in_test = F.array_contains(test_set, b)
    before_test = F.array_contains(test_set, b + 1)
    after_test = F.array_contains(test_set, b - 1)
    if gap_kind == "count":
        if purge_gap == 0:
            purged = F.lit(bool(parity))
        else:
            purged = F.col("_r") >= F.col("_len") - int(purge_gap)
        embargoed = F.col("_r") < int(embargo_gap)
    elif gap_kind == "value":
        purged = F.col(key) > F.col("_hi") - purge_gap
        embargoed = F.col(key) < F.col("_lo") + embargo_gap
    else:
        raise ValueError(f"unknown gap kind {gap_kind!r}")
    dropped = (before_test & purged) | (after_test & embargoed)
    path = F.size(F.filter(F.slice(combos_lit, 1, F.col("_s") + 1), lambda c: F.array_contains(c, b)))
    out = x.withColumns({
        "role": F.when(in_test, F.lit("valid")).when(~dropped, F.lit("train")),
        "path": F.when(in_test, path.cast("int")),
    }).filter(F.col("role").isNotNull())
    return out.select(F.col("_s").alias("split"), "role", key, F.col("_b").alias("block"), "path")


def assign(df: DataFrame, folds: DataFrame, fold: int, role: str, key: str = "date_id") -> DataFrame:
    """Rows of ``df`` in one fold's role (semi join on the key; the fold side is per key, not per row)."""
    sel = folds.filter((F.col(folds.columns[0]) == fold) & (F.col("role") == role)).select(key)
    return df.join(sel, key, "left_semi")
