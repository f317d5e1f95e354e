"""Ranks over a whole table without a window over a whole table.

Rows are dealt to ranges of the order, sorted inside each, numbered where they
are and written once; a range's rows before it come from the row counts of the
ranges, a few hundred numbers at most. No task holds more than its range.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auctide.session import stored

#: ``monotonically_increasing_id`` holds the partition above this bit and the row inside it below.
_ROW_BITS = 33


def global_rank(df: DataFrame, *order: str | Column, name: str = "rank") -> DataFrame:
    """``df`` with ``name``: 0 for the first row in ``order``, 1 for the next, and so on.

    Rows that are equal in ``order`` get different ranks in no fixed order and
    share a range; add a column that tells them apart where there are many.
    """
    at = F.col("_at")
    rows = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("_at", F.monotonically_increasing_id()), "ranked")
    parts = rows.groupBy(F.shiftright(at, _ROW_BITS).alias("_part")).count().orderBy("_part").collect()  # a row per range
    starts = [0, *accumulate(p["count"] for p in parts)]
    before = df.sparkSession.createDataFrame([(p["_part"], s) for p, s in zip(parts, starts)], "_part long, _before long")
    return (rows.withColumn("_part", F.shiftright(at, _ROW_BITS)).join(F.broadcast(before), "_part")  # a row per range
            .withColumn(name, F.col("_before") + at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
            .drop("_at", "_part", "_before"))


def ordinals(df: DataFrame, *keys: str, name: str = "ordinal") -> DataFrame:
    """The distinct ``keys`` of ``df`` with their place in order, from 0 (a dense rank), for keys of any type."""
    return global_rank(df.select(*keys).distinct(), *keys, name=name)
