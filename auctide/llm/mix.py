"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source is a queue of its documents in a seeded shuffle order; after its
last document the queue starts over, up to ``max_epochs`` passes. A document's
virtual finish time is the number of its source's words up to and including
it, divided by the source's weight. Serving all queues in order of virtual
finish time and stopping at the total budget gives every source
``min(max_epochs * size, weight * level)`` words, where ``level`` is the
virtual time at which the budget is spent (exhausted sources leave their share
to the others by weight).

Scale: a source may hold any share of all rows. The running word count of a
source is a prefix over hash ranges of the shuffle key (one row per source and
range) plus a window inside one range, so no task sorts a whole source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auctide.llm.common import WORD, stored

#: Hex digits of the shuffle key that name a range of a source: 16**3 ranges.
RANGE_DIGITS = 3


def word_count(c: str):
    return F.coalesce(F.regexp_count(F.col(c), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], budget: float,
                   max_epochs: int) -> DataFrame:
    """``(source, weight, source_size, target, level)``, one row per source.

    ``budget`` is a multiple of all words. Sources in code point order, null
    last, take ``weights`` in turn. The two windows below order one row per
    source, not documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    at = (F.row_number().over(by_name) - 1) % len(weights) + 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), at.cast("int"))
    cap = F.col("source_size") * F.lit(max_epochs)
    per = per.withColumn("weight", w).withColumn("full_at", cap / F.col("weight"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    prior = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(float(budget))
    level = (total - F.coalesce(F.sum(cap).over(prior), F.lit(0))) / F.sum("weight").over(rest)
    per = per.withColumn("level_here", level)
    free = F.col("level_here") <= F.col("full_at")
    per = per.withColumn("level", F.min_by("level_here", F.when(free, F.col("full_at"))).over(everything))
    target = F.when(free, F.least(F.col("weight") * F.col("level"), cap.cast("double"))).otherwise(
        cap.cast("double"))
    return per.select("source", "weight", "source_size", target.alias("target"))


def _sized(docs: DataFrame, seed: str, *keep: Column) -> DataFrame:
    """Stored rows with a row number, their size and their place in the shuffle order."""
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
                .cast("binary"))
    rows = docs.select(*keep, F.col("doc_id").alias("doc_id"), F.col("source").alias("source"),
                       word_count("text").alias("size"), key.alias("key"))
    return stored(rows.withColumn("range", F.substring("key", 1, RANGE_DIGITS))
                  .withColumn("uid", F.monotonically_increasing_id()), "mix-rows")


def _shares(sizes: DataFrame, weights: Sequence[float], budget: float, max_epochs: int) -> DataFrame:
    """Per row of ``sizes``: the words taken in each pass and the virtual finish time of the first."""
    targets = source_targets(sizes, weights, budget, max_epochs)
    # running words of a source: prefix over its ranges, then inside the range
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (sizes.groupBy("source", "range").agg(F.sum("size").alias("words"))
              .select("source", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset")))
    targets = targets.withColumnRenamed("source", "source_t")
    ranges = (ranges.join(targets, F.col("source").eqNullSafe(F.col("source_t")))
              .select(F.col("source").alias("source_"), F.col("range").alias("range_"), "offset",
                      "weight", "source_size", "target"))
    within = (Window.partitionBy("source", "range").orderBy("key", "doc_id", "size", "uid")
              .rowsBetween(Window.unboundedPreceding, -1))
    q = (sizes.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
         .join(ranges, F.col("source").eqNullSafe(F.col("source_")) & (F.col("range") == F.col("range_"))))
    start = F.col("offset") + F.col("inner")
    parts = [F.greatest(F.lit(0), F.least(
        F.col("size"), F.floor("target") - F.col("source_size") * e - start)).cast("long")
        for e in range(max_epochs)]
    return q.select("uid", "doc_id", "source", "size", "source_size", "target",
                    sum(parts[1:], parts[0]).alias("taken"), F.array(*parts).alias("taken_by_epoch"),
                    ((start + F.col("size")) / F.col("weight")).alias("finish"))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5,
        max_epochs: int = 2, seed: str = "mix") -> DataFrame:
    """Words that the mix takes of every document.

    Input ``doc_id, text, source``; other columns are ignored. Output, one row
    per input row in order of first virtual finish time: ``doc_id, source,
    size, source_size, target, taken, taken_by_epoch (array), finish``. The
    document that crosses its source's target is taken in part, so a source's
    total is its target rounded down. A null or empty text has size 0 and is
    never taken; a null source is a source of its own; rows that repeat a
    doc_id are queued one after another; an empty table gives no rows. The
    order depends on ``seed`` and doc_id only, so reruns agree.
    """
    sizes = _sized(docs.select("doc_id", "text", "source"), seed)
    return _shares(sizes, weights, budget, max_epochs).drop("uid").orderBy("finish", "doc_id")


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5,
                    max_epochs: int = 2, seed: str = "mix") -> DataFrame:
    """The mixed corpus: columns of ``docs``, one row per document and pass that the mix takes.

    A document taken in part (one per source at most) keeps its first words up
    to the target. Every row has its own share, repeated rows included. Extra
    columns pass through whatever their names.
    """
    cols = docs.columns
    rows = _sized(docs, seed, F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"))
    share = (_shares(rows.drop("__row"), weights, budget, max_epochs)
             .select(F.col("uid").alias("u"), F.explode("taken_by_epoch").alias("n")).filter("n > 0"))
    taken = rows.select("__row", "uid", "size").join(share, F.col("uid") == F.col("u"))
    words = F.array_join(F.slice(F.regexp_extract_all("__row.text", F.lit(WORD), F.lit(0)),
                                 F.lit(1), F.col("n").cast("int")), " ")
    text = F.when(F.col("n") < F.col("size"), words).otherwise(F.col("__row.text"))
    return taken.select(*[(text if c == "text" else F.col(f"__row.`{c}`")).alias(c) for c in cols])
