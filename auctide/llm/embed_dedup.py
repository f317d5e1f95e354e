"""Embedding near-duplicates by random-hyperplane sign hashing.

Equal vectors collapse to one representative. In each of several tables a
representative's code is the signs of its products with random hyperplanes;
representatives of one label that share a code in some table are compared by
exact cosine in double precision. The number of hyperplanes follows the number
of representatives and the number of tables follows from the wanted recall at
the threshold, so buckets stay small at any size.

Nothing emits pairs: a bucket yields, per vector, the weight of its links and
one edge of a spanning forest. A link is counted in the first table where both
codes meet. Buckets above ``BLOCK`` rows are cut into blocks that are compared
two by two in separate groups, so a bucket of any size is done in full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auctide.llm.common import stored
from auctide.llm.components import connected_components

RECALL = 0.9999
#: Representatives of one bucket compared in one piece; rows of one Python group (about).
BLOCK, CELL = 2048, 4096
SEED = 4


def plan(n: int, threshold: float) -> tuple[int, int]:
    """Hyperplanes per table and tables for ``n`` representatives."""
    bits = min(24, max(4, math.ceil(math.log2(max(1, n) / 512)))) if n > 512 else 4
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - meet))


def _codes(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    planes = np.random.default_rng([SEED, x.shape[1], bits]).standard_normal((x.shape[1], bits * tables))
    signs = (x @ planes > 0).reshape(len(x), tables, bits)
    return signs @ (1 << np.arange(bits)).astype(np.int64)


def _unit(rows) -> np.ndarray:
    x = np.stack([np.asarray(r, np.float64) for r in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares of very large or small values finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _bucket(x, weight, codes, t: int, block, left: int, right: int, threshold: float):
    """Link weight of each row and forest edges of one bucket, or of two blocks of it."""
    a, b = np.flatnonzero(block == left), np.flatnonzero(block == right)
    links, root = np.zeros(len(x), np.int64), np.arange(len(x))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for s in range(0, len(a), 256):
        rows = a[s:s + 256]
        i, j = np.nonzero(x[rows] @ x[b].T >= threshold)
        i, j = rows[i], b[j]
        on = i != j if left != right else i < j
        i, j = i[on], j[on]
        if t and len(i):
            new = ~(codes[i, :t] == codes[j, :t]).any(axis=1)
            i, j = i[new], j[new]
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        # one link per row and current root is enough for the forest
        for p, q in zip(i.tolist(), j.tolist()):
            p, q = find(p), find(q)
            if p != q:
                root[max(p, q)] = min(p, q)
    return links, [find(i) for i in range(len(x))]


def _compare(threshold: float):
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (label, dim, t, code, left, right), g in cell.groupby(
                ["label", "dim", "t", "code", "left", "right"], sort=False):
            if len(g) < 2:
                continue
            ids = g["rid"].to_numpy()
            links, roots = _bucket(_unit(g["embedding"]), g["n"].to_numpy(), np.stack(g["codes"].to_numpy()),
                                   t, g["block"].to_numpy(), left, right, threshold)
            hit = np.flatnonzero(links > 0)
            out.append(pd.DataFrame({"rid": ids[hit], "links": links[hit],
                                     "other": ids[[roots[i] for i in hit]] if len(hit) else ids[:0]}))
        return pd.concat(out) if out else pd.DataFrame({"rid": [], "links": [], "other": []}).astype("int64")
    return run


def _vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, embedding, ok``: ok where cosine is defined and the label is known."""
    e = F.col("embedding").cast("array<double>")
    finite = ~F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (embeddings.select("vec_id", "label", "embedding")
            .withColumn("ok", F.coalesce(F.col("label").isNotNull() & finite
                                         & F.exists(e, lambda v: v != 0), F.lit(False))))


def near_duplicates(embeddings: DataFrame, threshold: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per input row.

    Vectors link when their labels are equal and their cosine reaches
    ``threshold``; vectors of different lengths never link. Null, empty, zero
    or non-finite vectors and null labels link with nothing: no links, a
    component of their own, kept. Rows that repeat a vector or an id are
    vectors of their own. A null vec_id never names a component. Other columns
    are ignored; an empty table gives no rows.
    """
    rows = _vectors(embeddings)
    reps = stored(rows.filter("ok").groupBy("label", "embedding")
                  .agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
                  .withColumn("rid", F.monotonically_increasing_id()), "embed-reps")
    bits, tables = plan(reps.count(), threshold)

    def hash_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for dim, g in f.groupby(f["embedding"].map(len)):
                yield g[["rid", "n", "label", "embedding"]].assign(
                    dim=dim, codes=list(_codes(_unit(g["embedding"]), bits, tables)))

    kind = dict(reps.dtypes)
    hashed = reps.select("rid", "n", "label", "embedding").mapInPandas(
        hash_rows, f"rid long, n long, label {kind['label']}, embedding {kind['embedding']}, "
                   "dim long, codes array<long>")
    placed = hashed.select("*", F.posexplode("codes").alias("t", "code"))
    key = ["label", "dim", "t", "code"]
    large = (hashed.select("label", "dim", F.posexplode("codes").alias("t", "code")).groupBy(*key).count()
             .filter(F.col("count") > BLOCK)
             .select(*[F.col(k).alias(f"{k}_") for k in key],
                     F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    on = [F.col(k) == F.col(f"{k}_") for k in key]
    cut = (placed.join(large, on, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
           .withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
           .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .withColumn("left", F.least("block", "with")).withColumn("right", F.greatest("block", "with")))
    cells = max(1, math.ceil(tables * reps.count() / CELL))
    found = stored(cut.withColumn("cell", F.pmod(F.xxhash64(*key, "left", "right"), F.lit(cells)))
                   .select("cell", *key, "left", "right", "block", "rid", "n", "embedding", "codes")
                   .groupBy("cell").applyInPandas(_compare(threshold), "rid long, links long, other long"),
                   "embed-links")
    comp = connected_components(found, "rid", "other")
    per = (reps.select("rid", "label", "embedding", "first", "n")
           .join(found.groupBy("rid").agg(F.sum("links").alias("links")), "rid", "left")
           .join(comp, F.col("rid") == F.col("node"), "left")
           .withColumn("component", F.coalesce("component", "rid")))
    per = per.join(per.groupBy("component").agg(F.min("first").alias("component_id")), "component")
    per = per.select(F.col("label").alias("label_"), F.col("embedding").alias("embedding_"), "component_id",
                     (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    linked = (rows.filter("ok").join(per, (F.col("label") == F.col("label_"))
                                     & (F.col("embedding") == F.col("embedding_")))
              .select("vec_id", "n_links", "component_id"))
    alone = rows.filter(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                              F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
