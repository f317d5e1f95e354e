"""The storage-narrowing plan of a table (``downcast``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOAT_TYPES = (T.FloatType, T.DoubleType)

# fixed values: integer bounds the narrowing rule compares against (strict < and >)
INT_BOUNDS = [("tinyint", -128, 127), ("smallint", -32768, 32767),
              ("int", -2147483648, 2147483647), ("bigint", -9223372036854775808, 9223372036854775807)]


def downcast_plan(df: DataFrame) -> DataFrame:
    """One row per numeric column: observed min/max and the narrowest type that fits.

    Integers go to the smallest type whose bounds hold with strict ``<``/``>``;
    floating columns go to 32-bit float. One aggregate over all columns, then
    an unpivot -- nothing is collected.
    """
    num = [f for f in df.schema.fields if isinstance(f.dataType, _INT_TYPES + _FLOAT_TYPES)]
    aggs = []
    for f in num:
        aggs += [F.min(f.name).cast("double").alias(f"{f.name}__min"),
                 F.max(f.name).cast("double").alias(f"{f.name}__max")]
    mm = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"),
                 F.lit(isinstance(f.dataType, _INT_TYPES)).alias("_int"),
                 F.col(f"{f.name}__min").alias("min_value"),
                 F.col(f"{f.name}__max").alias("max_value")) for f in num]))
    out = mm.select(rows.alias("r")).select("r.*")
    lo, hi = F.col("min_value"), F.col("max_value")
    int_type = F.lit(None).cast("string")
    for name, a, b in reversed(INT_BOUNDS):
        int_type = F.when((lo > a) & (hi < b), F.lit(name)).otherwise(int_type)
    return out.select("column", "min_value", "max_value",
                      F.when(F.col("_int"), int_type).otherwise(F.lit("float")).alias("narrow_type"))


def downcast(df: DataFrame) -> DataFrame:
    """Cast numeric columns to the narrow types of ``downcast_plan`` (one small action:
    the plan has one row per column)."""
    plan = {r["column"]: r["narrow_type"] for r in downcast_plan(df).collect()}
    return df.withColumns({c: F.col(c).cast(t) for c, t in plan.items() if t})
