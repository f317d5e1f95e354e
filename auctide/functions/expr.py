"""Column-expression building blocks (all JVM-side, inside whole-stage codegen).

Division policy (Spark 4 runs ANSI mode, where ``x / 0`` raises):
  * ``"null"`` -- x/0 and 0/0 give NULL (the v1 feature set; it kept inf in
    the reference, here missing takes its place);
  * ``"zero"`` -- x/0 gives 0 and 0/0 gives NULL: the reference replaced
    +-inf by 0 at the end of the v2 and notebook feature sets, and NaN stays
    missing.
No bare ``/`` on data columns is used anywhere in the engine.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: ColumnOrName, b: ColumnOrName, on_zero: str = "null") -> Column:
    a, b = col(a), col(b)
    if on_zero == "null":
        return F.try_divide(a, b)
    if on_zero == "zero":
        return F.when(b == 0, F.when(a != 0, F.lit(0.0))).otherwise(F.try_divide(a, b))
    raise ValueError(f"unknown division policy {on_zero!r}")


def pct_change(x: ColumnOrName, prev: ColumnOrName, on_zero: str = "null") -> Column:
    """``x / prev - 1``; with policy "zero" an infinite result becomes 0."""
    x, prev = col(x), col(prev)
    if on_zero == "zero":
        return F.when(prev == 0, F.when(x != 0, F.lit(0.0))).otherwise(F.try_divide(x, prev) - 1)
    return F.try_divide(x, prev) - 1


def frame(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), Window.currentRow)


def roll(fn: Callable[[Column], Column], c: ColumnOrName, n: int, w: WindowSpec) -> Column:
    """Rolling ``fn`` over the last ``n`` rows; NULL until ``n`` non-null values are in the frame."""
    wn = frame(w, n)
    c = col(c)
    return F.when(F.count(c).over(wn) == n, fn(c).over(wn))


def roll_mean(c: ColumnOrName, n: int, w: WindowSpec) -> Column:
    return roll(F.avg, c, n, w)


def roll_std(c: ColumnOrName, n: int, w: WindowSpec) -> Column:
    return roll(F.stddev_samp, c, n, w)


#: Prefix of columns that only serve the next step of a stage.
TEMP = "_roll_"


def rolling(means: dict[str, tuple[str, int]], stds: dict[str, tuple[str, int]], w: WindowSpec) -> list[dict[str, Column]]:
    """``roll_mean`` and ``roll_std`` of many columns (``{name: (column, n)}``) as steps for ``withColumns``.

    The rows of a frame come as lags, each fetched once; the mean is a projection over them, in the order in
    which a sliding frame adds up, and so is the test that all ``n`` are there. Sliding frames start anew
    for every row and function; only the deviations, whose last digits depend on how they are summed, keep one.
    """
    reach: dict[str, int] = {}
    for c, n in [*means.values(), *stds.values()]:
        reach[c] = max(n, reach.get(c, 0))

    def rows(c: str, n: int) -> list[str]:
        return [_quoted(f"{TEMP}{k}_{c}" if k else c) for k in range(n - 1, -1, -1)]

    fetched = {f"{TEMP}{k}_{c}": F.lag(c, k).over(w) for c, n in reach.items() for k in range(1, n)}
    fetched |= {f"{TEMP}std{n}_{c}": F.stddev_samp(c).over(frame(w, n)) for c, n in stds.values()}
    out = {name: F.expr("(" + " + ".join(f"CAST({x} AS DOUBLE)" for x in rows(c, n)) + f") / {n}D")
           for name, (c, n) in means.items()}
    out |= {name: F.expr(f"CASE WHEN {' AND '.join(f'{x} IS NOT NULL' for x in rows(c, n))} "
                         f"THEN {_quoted(f'{TEMP}std{n}_{c}')} END") for name, (c, n) in stds.items()}
    return [fetched, out]


def diff(c: ColumnOrName, w: WindowSpec, k: int = 1) -> Column:
    return col(c) - F.lag(col(c), k).over(w)


def sign_int(c: Column) -> Column:
    return F.signum(c).cast("int")


def sql_ratio(a: str, b: str, on_zero: str = "null") -> str:
    """``ratio`` of two SQL texts."""
    if on_zero == "null":
        return f"try_divide({a}, {b})"
    if on_zero == "zero":
        return f"CASE WHEN {b} = 0 THEN CASE WHEN {a} <> 0 THEN 0D END ELSE try_divide({a}, {b}) END"
    raise ValueError(f"unknown division policy {on_zero!r}")


def pair_imbalance(a: str, b: str, on_zero: str = "null") -> Column:
    a, b = _quoted(a), _quoted(b)
    return F.expr(sql_ratio(f"({a} - {b})", f"({a} + {b})", on_zero))


def pair_imbalances(names: Sequence[str], on_zero: str = "null") -> dict[str, Column]:
    return {f"{a}_{b}_imb": pair_imbalance(a, b, on_zero) for a, b in combinations(names, 2)}


def triplet_imbalance(a: str, b: str, c: str, on_zero: str = "null", nulls: str = "strict") -> Column:
    """``(max - mid) / (mid - min)`` over three columns, ``mid = sum - max - min``.

    ``nulls="strict"``: NULL when any input is NULL (default).
    ``nulls="skip"``: max/min skip NULLs and the sum counts NULL as 0, as the
    reference's horizontal operators do.
    """
    xs = [_quoted(x) for x in (a, b, c)]
    if nulls not in ("skip", "strict"):
        raise ValueError(f"unknown null rule {nulls!r}")
    most, least = f"greatest({', '.join(xs)})", f"least({', '.join(xs)})"
    total = " + ".join(f"coalesce({x}, 0D)" for x in xs) if nulls == "skip" else " + ".join(xs)
    mid = f"({total} - {most} - {least})"
    return F.expr(sql_ratio(f"({most} - {mid})", f"({mid} - {least})", on_zero))


def triplet_imbalances(names: Sequence[str], on_zero: str = "null", nulls: str = "strict",
                       suffix: str = "imb") -> dict[str, Column]:
    return {f"{a}_{b}_{c}_{suffix}": triplet_imbalance(a, b, c, on_zero, nulls)
            for a, b, c in combinations(names, 3)}


def triplet_imbalance_nb(a: str, b: str, c: str) -> Column:
    """Notebook flavour: ``mid == min`` gives NULL; ``mid = a + b + c - min - max``."""
    xs = [F.col(a), F.col(b), F.col(c)]
    mx, mn = F.greatest(*xs), F.least(*xs)
    mid = xs[0] + xs[1] + xs[2] - mn - mx
    return F.when(mid != mn, F.try_divide(mx - mid, mid - mn))


def triplet_imbalances_nb(names: Sequence[str]) -> dict[str, Column]:
    return {f"{a}_{b}_{c}_imb2": triplet_imbalance_nb(a, b, c) for a, b, c in combinations(names, 3)}


# Row moments -------------------------------------------------------------------------------

_FP_ERR = 1e-14


def _nz(c: str) -> str:
    """Values below 1e-14 in magnitude count as 0 (floating-point noise rule)."""
    return f"CASE WHEN abs({c}) < {_FP_ERR}D THEN 0D ELSE {c} END"


def row_moment_stages(names: Sequence[str], prefix: str) -> list[dict[str, Column]]:
    """Row-wise mean, std (ddof 1), skew and excess kurtosis over ``names``, NULLs skipped.

    Returned as two ``withColumns`` stages (count and mean first, moments
    second) plus the temporary column names to drop afterwards. Skew needs
    3 values, kurtosis 4; bias-corrected (sample) estimators.
    """
    xs = [_quoted(c) for c in names]
    n, m = f"_{prefix}_n", f"_{prefix}_m"
    count = " + ".join(f"CASE WHEN {x} IS NOT NULL THEN 1 ELSE 0 END" for x in xs)
    total = " + ".join(f"coalesce({x}, 0D)" for x in xs)
    stage1 = {n: F.expr(count), m: F.expr(f"try_divide({total}, {count})")}

    def msum(k: int) -> str:
        return "(" + " + ".join(f"coalesce(power({x} - {m}, {k}D), 0D)" for x in xs) + ")"

    m2, m3, m4, d = msum(2), msum(3), msum(4), f"cast({n} AS double)"
    m2z, m3z = _nz(m2), _nz(m3)
    skew = (f"CASE WHEN {n} > 2 THEN CASE WHEN {m2z} = 0D THEN 0D ELSE "
            f"try_divide({d} * sqrt({d} - 1), {d} - 2) * try_divide({m3z}, power({m2z}, 1.5D)) END END")
    num = _nz(f"({d} * ({d} + 1) * ({d} - 1) * {m4})")
    den = _nz(f"(({d} - 2) * ({d} - 3) * power({m2}, 2D))")
    adj = f"try_divide(3 * power({d} - 1, 2D), ({d} - 2) * ({d} - 3))"
    stage2 = {
        f"{prefix}_mean": F.col(m),
        f"{prefix}_std": F.expr(f"CASE WHEN {n} > 1 THEN sqrt(try_divide({m2}, {d} - 1)) END"),
        f"{prefix}_skew": F.expr(skew),
        f"{prefix}_kurt": F.expr(f"CASE WHEN {n} > 3 THEN CASE WHEN {den} = 0D THEN 0D ELSE try_divide({num}, {den}) - {adj} END END"),
    }
    return [stage1, stage2]


def with_row_moments(df, groups: dict[str, Sequence[str]]):
    """Add ``{prefix}_mean/std/skew/kurt`` for each ``prefix -> columns`` entry."""
    s1, s2, tmp = {}, {}, []
    for prefix, names in groups.items():
        a, b = row_moment_stages(names, prefix)
        s1.update(a)
        s2.update(b)
        tmp.extend(a.keys())
    return df.withColumns(s1).withColumns(s2).drop(*tmp)


def _floating(df) -> list[str]:
    from pyspark.sql import types as T
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def clean_inf(df, columns: Sequence[str] | None = None):
    """Replace +-inf by 0 in floating columns (strings and integers untouched).

    One SQL text per column: over the hundred and more columns of a feature set, building such
    expressions call by call takes seconds on the driver. The rounding below is written alike.
    """
    return df.withColumns({c: F.expr(f"CASE WHEN abs({_quoted(c)}) = double('infinity') THEN 0D ELSE {_quoted(c)} END")
                           for c in _floating(df) if columns is None or c in columns})


ROUND_LIMIT = 1e9
SIGNIFICANT, TINY = 9, 1e-12


def round_half_up(name: str, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` for |x| < 1e9, else x unchanged.

    Written as plain IEEE arithmetic so any engine gives the same bits for
    the same input (the built-in ROUNDs of engines differ on half-way and
    very large values); -0.0 comes out as 0.0.
    """
    x, scale = _quoted(name), f"{10 ** digits}D"
    return F.expr(f"CASE WHEN abs({x}) < {ROUND_LIMIT}D THEN floor({x} * {scale} + 0.5D) / {scale} ELSE {x} END")


def round_stable(name: str, digits: int, significant: int = SIGNIFICANT) -> Column:
    """At least ``digits`` decimals and at least ``significant`` significant digits.

    Small values get more decimals, so a column of ratios around 1e-7 keeps
    its values; magnitudes below ``TINY`` are floating-point noise and become 0.
    """
    x = _quoted(name)
    scale = f"power(10D, greatest({digits}D, {significant - 1}D - floor(log10(abs({x})))))"
    return F.expr(f"CASE WHEN abs({x}) < {TINY}D THEN 0D WHEN abs({x}) < {ROUND_LIMIT}D "
                  f"THEN floor({x} * {scale} + 0.5D) / {scale} ELSE {x} END")


def round_doubles(df, digits: int = 6, overrides: dict[str, int] | None = None,
                  significant: Callable[[str], int] = lambda name: SIGNIFICANT):
    """Round floating columns for cross-engine comparison (``round_stable`` with the column's
    ``significant`` digits); columns in ``overrides``, whose values carry cancellation noise, to
    absolute decimals (``round_half_up``)."""
    overrides = overrides or {}
    out = {c: round_half_up(c, overrides[c]) if c in overrides else round_stable(c, digits, significant(c))
           for c in _floating(df)}
    return df.withColumns(out) if out else df
