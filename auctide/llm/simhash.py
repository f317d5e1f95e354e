"""SimHash near-duplicates by anchor-point covering.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word
shingles. Distinct fingerprints that differ in at most ``max_bits`` bits are
linked. Two halves of 32 bits each: with ``max_bits`` of 3 at most, one half
differs in one bit at most. 31 bits of each half are covered by the perfect
(31, 26) Hamming code: every half lies within radius 1 of exactly one code
word (its home anchor), and a half within distance 1 of it lies within
radius 2 of that anchor. So a fingerprint goes to its home anchor once and to
all anchors within covering radius plus threshold (16 at most) as a partner,
and an equi-join on the anchor compares all 64 bits.

Copies collapse to one fingerprint before any of this, so a group of equal
texts costs one row; different fingerprints around one point are bounded by
the radius. Components run on fingerprints and come back to documents by join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auctide.llm.common import small_batches, stored
from auctide.llm.components import connected_components

SEED = 42
#: Shingles whose bits are counted at a time; bounds memory for very long texts.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit fingerprint as an unsigned int; 0 for null or a text without words."""
    import xxhash
    if not text:
        return 0
    words = text.encode().lower().split()
    if not words:
        return 0
    h64 = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[:n].tolist(), ends[-n:].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, n, BLOCK):
        h = np.array([h64(joined[a:b], SEED) for a, b in zip(first[i:i + BLOCK], last[i:i + BLOCK])],
                     np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", to: str = "fp") -> DataFrame:
    """``docs`` with a signed 64-bit fingerprint column ``to``."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in s], np.uint64).view(np.int64))

    return docs.withColumn(to, fp(F.col(text)))


def _syndrome(half):
    """Position (1..31) of the bit to flip to reach the home anchor, 0 on an anchor."""
    masks = [sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1) for k in range(5)]
    s = F.lit(0)
    for k, m in enumerate(masks):
        s = s + (F.bit_count(half.bitwiseAND(F.lit(m))) % 2) * (1 << k)
    return s


def _halves(fps: DataFrame) -> DataFrame:
    """Two rows per fingerprint: ``half`` 0/1, its 31 covered bits and their syndrome."""
    low, mask = F.col("fp"), F.lit((1 << 31) - 1)
    bits = F.array(*[F.struct(F.lit(i).alias("half"), v.bitwiseAND(mask).alias("bits"))
                     for i, v in enumerate((low, F.shiftrightunsigned(low, 32)))])
    return (fps.select("fp", F.explode(bits).alias("h")).select("fp", "h.half", "h.bits")
            .withColumn("s", _syndrome(F.col("bits"))))


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs ``x < y`` of distinct fingerprints (column ``fp``) at most ``max_bits`` bits apart."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3: one of two halves then differs in one bit at most")
    h = _halves(fps.select("fp").distinct())
    # anchors within radius 2: flip positions i and i xor s, position 0 standing for no flip
    spread = (h.select("fp", "half", "bits", "s", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("i"))
              .withColumn("j", F.expr("i ^ s"))
              .filter("i < j or (s = 0 and i = 0)"))
    flip = "(case when {0} = 0 then 0L else shiftleft(1L, {0} - 1) end)"
    anchor = F.expr(f"bits ^ {flip.format('i')} ^ {flip.format('j')}")
    key = F.shiftleft(F.col("half").cast("long"), 31).bitwiseOR(anchor)
    at = spread.select(key.alias("anchor"), F.col("fp"), (F.col("i") == 0).alias("home"))
    home = at.filter("home").select("anchor", F.col("fp").alias("x"))
    ball = at.select("anchor", F.col("fp").alias("y"))
    # a fingerprint has 34 rows here, which sizes before an explode do not tell: neither side may be broadcast
    return (home.hint("merge").join(ball, "anchor")
            .filter(f"x < y and bit_count(x ^ y) <= {int(max_bits)}").select("x", "y"))


def classes(marked: DataFrame, max_bits: int = 2) -> DataFrame:
    """``fp_, component, component_id``, one row per distinct fingerprint of ``marked (doc_id, fp)``."""
    smallest = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    comp = connected_components(links(smallest, max_bits), "x", "y")
    of = (smallest.join(comp, smallest.fp == comp.node, "left")
          .select("fp", "first", F.coalesce("component", "fp").alias("component")))
    ids = of.groupBy("component").agg(F.min("first").alias("component_id"))
    return of.join(ids, "component").select(F.col("fp").alias("fp_"), "component", "component_id")


def label(docs: DataFrame, max_bits: int = 2, shingle: int = 3) -> DataFrame:
    """``doc_id, fp, component_id``: one row per input row.

    component_id is the smallest doc_id whose fingerprint is reachable over
    links of at most ``max_bits`` bits. Null, empty and white-space texts have
    fingerprint 0 and are linked like any other; rows with a null doc_id take
    part in links but never name a component (null when no id is reachable);
    equal rows stay equal rows; an empty table gives no rows; other columns
    are ignored.
    """
    marked = stored(fingerprints(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"), "simhash-fp")
    by_fp = classes(marked, max_bits)
    return marked.join(by_fp, F.col("fp") == F.col("fp_")).select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, max_bits: int = 2, shingle: int = 3) -> DataFrame:
    """Rows of ``docs``, one per component: the row of the smallest doc_id.

    Of rows that repeat this id inside a component, any one stays; a component
    of null ids keeps one row. Columns, extra ones included, pass unchanged.
    """
    cols = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"),
                       F.col("doc_id").alias("doc_id"), F.col("text").alias("__text"))
    rows = stored(fingerprints(rows, shingle, "__text").select("__row", "doc_id", "fp")
                  .withColumn("uid", F.monotonically_increasing_id()), "simhash-rows")
    narrow = rows.select("uid", "doc_id", "fp")
    by_fp = classes(narrow, max_bits)
    kept = (narrow.join(by_fp, F.col("fp") == F.col("fp_"))
            .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("component").agg(F.min("uid").alias("uid")).select("uid"))
    return (rows.select("uid", "__row").join(kept, "uid", "left_semi")
            .select(*[F.col(f"__row.`{c}`").alias(c) for c in cols]))
