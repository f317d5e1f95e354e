"""Vector codes (product quantisation) over Hilbert-sorted flat blocks.

Every vector is cut into equal parts; a part position has a codebook of a few
hundred entries that is refined by rounds of exact integer k-means. The parts
of all vectors are sorted along a Hilbert curve, once, and packed into flat
blocks of neighbouring points: one row per block with the points, the smallest
box around them and their sums. A round measures, per block, the smallest and
the largest distance from its box to every entry. An entry farther away than
some other entry at its worst cannot be nearest to any point; what is left is
the block's shortlist. A shortlist of one takes the block's sums as they are;
otherwise the points are measured against the shortlist by an exact integer
kernel.

Spark sorts, shuffles and sums; a task holds a batch of blocks, the codebooks
(``parts * entries`` short vectors) and one sum per entry. The driver sees the
codebooks and their sums, nothing that grows with the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auctide.llm.common import small_batches, stored
from auctide.llm.integer_vectors import floor_means, integer_vectors, matrix, squares, sums_by

#: Points of a block; bits per component of the curve, if the key has room for them.
BLOCK, BITS = 256, 3
KEY_BITS = 62


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of grid cells (rows of coordinates below 2^bits) along a Hilbert curve.

    From the highest bit down, an axis that is in the upper half turns the
    first axis around, one in the lower half swaps its low bits with the first
    axis; the turned coordinates, as a Gray code, spell the place bit by bit.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        low = q - 1
        for i in range(n):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> level) & 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> level) & 1
    return key


def shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Entries, in order, that may be nearest to some point of the box ``low`` to ``high``."""
    below, above = entries - low, entries - high
    outside = np.maximum(0, np.maximum(-below, above))
    corner = np.maximum(np.abs(below), np.abs(above))
    return np.flatnonzero((outside * outside).sum(axis=1) <= (corner * corner).sum(axis=1).min())


def _points(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``part, key, rid, p``: one row per vector and part, with its place on the curve of the part.

    The grid spans the first entries of the part; points outside it count as
    on its edge. The grid only decides who shares a block.
    """
    parts, _, width = books.shape
    used = min(width, KEY_BITS)
    bits = max(1, min(BITS, KEY_BITS // used))
    lo, hi = books.min(axis=1)[:, :used], books.max(axis=1)[:, :used]
    span = np.maximum(1, hi - lo + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("point"), parts * width)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * width)
            for part in range(parts):
                p = np.ascontiguousarray(x[:, part * width:(part + 1) * width])
                cells = np.clip((p[:, :used] - lo[part] << bits) // span[part], 0, (1 << bits) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), part, np.int32)), pa.array(hilbert_keys(cells, bits)), b.column("rid"),
                     pa.ListArray.from_arrays(offsets, pa.array(p.astype(np.int32).ravel()))],
                    names=["part", "key", "rid", "p"])

    return rows.select("rid", "point").mapInArrow(run, "part int, key long, rid long, p array<int>")


def _blocks(points: DataFrame, width: int) -> DataFrame:
    """``part, n, low, high, total, rids, points``: flat blocks of neighbours on the curve.

    Ranges of (part, key, rid) split any number of equal points.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = b.column("part").to_numpy()
            rids = b.column("rid").to_numpy()
            x = matrix(b.column("p"), width)
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
            out = []
            for s, e in zip(starts, [*starts[1:], len(part)]):
                for at in range(s, e, BLOCK):
                    to = min(at + BLOCK, e)
                    p = x[at:to]
                    out.append((int(part[at]), to - at, p.min(0), p.max(0), p.sum(0),
                                rids[at:to].astype("<i8").tobytes(), p.astype("<i4").tobytes()))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                     pa.array(cols[2], pa.list_(pa.int64())), pa.array(cols[3], pa.list_(pa.int64())),
                     pa.array(cols[4], pa.list_(pa.int64())), pa.array(cols[5], pa.binary()),
                     pa.array(cols[6], pa.binary())],
                    names=["part", "n", "low", "high", "total", "rids", "points"])

    return (points.repartitionByRange("part", "key", "rid").sortWithinPartitions("part", "key")
            .mapInArrow(run, "part int, n int, low array<long>, high array<long>, total array<long>, "
                             "rids binary, points binary"))


def _read(batches: Iterator[pa.RecordBatch], books: np.ndarray):
    """Per block: its part, shortlist, sums, row numbers and points."""
    width = books.shape[2]
    for b in batches:
        low, high, total = (matrix(b.column(c), width) for c in ("low", "high", "total"))
        for i, (part, rids, raw) in enumerate(zip(b.column("part").to_pylist(), b.column("rids").to_pylist(),
                                                  b.column("points").to_pylist())):
            yield (part, shortlist(low[i], high[i], books[part]), total[i], np.frombuffer(rids, "<i8"),
                   np.frombuffer(raw, "<i4").astype(np.int64).reshape(-1, width))


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one assignment of all blocks."""
    parts, entries, width = books.shape
    names = [f"s{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(books), np.zeros((parts, entries), np.int64)
        for part, short, total, rids, p in _read(batches, books):
            if len(short) == 1:
                sums[part, short[0]] += total
                counts[part, short[0]] += len(rids)
            else:
                best = squares(p, books[part][short]).argmin(axis=1)
                sums[part, short] += sums_by(best, p, len(short))
                counts[part, short] += np.bincount(best, minlength=len(short))
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(counts[part, entry]),
             *[pa.array(sums[part, entry, i]) for i in range(width)]], names=["part", "entry", "n", *names])

    got = (blocks.mapInArrow(run, "part long, entry long, n long, " + ", ".join(f"{c} long" for c in names))
           .groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)]).collect())
    sums, counts = np.zeros_like(books), np.zeros((parts, entries), np.int64)
    for r in got:
        counts[r.part, r.entry], sums[r.part, r.entry] = r.n, r[3:]
    return floor_means(books, sums, counts)


def _assign(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``rid, code, error`` per vector: entries as bytes of a number, first part highest."""
    parts = books.shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, short, _, rids, p in _read(batches, books):
            d = squares(p, books[part][short])
            best = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids), pa.array(short[best] << 8 * (parts - 1 - part)),
                 pa.array(d[np.arange(len(p)), best])], names=["rid", "code", "error"])

    return (blocks.mapInArrow(run, "rid long, code long, error long")
            .groupBy("rid").agg(F.sum("code").alias("code"), F.sum("error").alias("error")))


def encode_vectors(embeddings: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4,
                   scale: int = 1024) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` per kept vector.

    Vectors that are null or hold a null or non-finite component are dropped;
    component x counts as floor(scale * x). Codebooks start with the parts of
    the ``entries`` smallest vec_ids (null ids last; rows of one id in the
    order of their vectors), fewer vectors give fewer entries. Ties go to the
    lower entry, an unused entry stays. ``label_error`` adds up the errors of
    equal labels, null labels together. Rows that repeat an id or a vector are
    vectors of their own. The length of the vectors is that of the first kept
    row whose length is a positive multiple of ``parts``; rows of another
    length cannot be cut and come back with null code and error. Other columns
    are ignored; no rows, no result. A component of 2^26 or more after scaling
    raises. ``parts`` is at most 7, ``entries`` at most 256.
    """
    spark = embeddings.sparkSession
    small_batches(spark)  # a block is some 20 KB
    rows = stored(integer_vectors(embeddings, scale, "vec_id", "label")
                  .withColumn("rid", F.monotonically_increasing_id()), "code-rows")
    order = [F.col("vec_id").asc_nulls_last(), F.col("point")]
    cuttable = rows.filter(f"size(point) > 0 and size(point) % {parts} = 0")
    head = cuttable.orderBy(*order).select(F.size("point").alias("dim")).first()
    dim = head.dim if head else parts
    of_dim = rows.filter(F.size("point") == dim)
    first = [r.point for r in of_dim.orderBy(*order).select("point").limit(entries).collect()]
    books = np.array(first, np.int64).reshape(-1, parts, dim // parts).transpose(1, 0, 2).copy()
    if first:
        blocks = stored(_blocks(_points(of_dim, books), dim // parts), "code-blocks")
        for _ in range(rounds):
            books = _round(blocks, books)
        found = _assign(blocks, books)
    else:
        found = rows.select("rid", F.lit(0).cast("long").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
    coded = stored(rows.select("rid", "vec_id", "label").join(found, "rid", "left"), "code-found")
    per_label = coded.groupBy(F.col("label").alias("label_")).agg(F.sum("error").alias("label_error"))
    return (coded.join(per_label, F.col("label").eqNullSafe(F.col("label_")))
            .select("vec_id", F.lower(F.lpad(F.hex("code"), 2 * parts, "0")).alias("code"), "error", "label_error",
                    F.lit(hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest())
                    .alias("codebooks_sha256")))
