"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auctide.session import drop_at_exit, scratch_path

#: A word: a longest run without ASCII white space (Java and RE2 spelling).
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of one Arrow batch; texts are long, so batches stay small.
ARROW_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Paths that ``stored`` has written in this process, in order.
written: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors.

    The table goes when the session ends, or with ``drop_tables``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    drop_at_exit(df.sparkSession, path)
    written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables; frames that read them end here."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def crc_mod(doc_id: str, m: int) -> Column:
    """crc32 of the id's decimal text, modulo ``m`` (null ids: crc32 of the empty text, 0)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % m


def bounded_sample(df: DataFrame, n: int, *by: str) -> DataFrame:
    """About ``n`` rows at most, chosen by a hash of ``by``; all rows where there are no more.

    A threshold on the hash keeps a few more than ``n`` rows before the final
    limit, so what tasks send to it does not grow with the table.
    """
    total = df.count()
    if total > n:
        df = df.filter(F.pmod(F.xxhash64(F.lit("sample"), *by), F.lit(1 << 30)) < int(1.2 * n / total * (1 << 30)) + 1)
    return df.orderBy(F.xxhash64(F.lit("sample"), *by), *by).limit(n)


def most_frequent(counts: DataFrame, n: int, count: str = "n") -> DataFrame:
    """The rows of ``counts`` with the largest counts, about ``n`` at most (ties are cut by hash).

    The cut is read off a histogram over the logarithm of the count, a few
    hundred rows at any size; only rows above the cut travel on.
    """
    step = F.floor(F.log2(F.col(count)) * 16)
    hist = counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).orderBy(F.desc("step")).collect()
    above, cut, share = 0, None, 0.0
    for r in hist:
        if above + r.rows > n:
            cut, share = r.step, (n - above) / r.rows
            break
        above += r.rows
    if cut is None:
        return counts
    edge = F.pmod(F.xxhash64(*[c for c in counts.columns if c != count and counts.schema[c].dataType.typeName()
                               in ("string", "binary", "long", "integer")]), F.lit(1 << 30)) < int(share * (1 << 30))
    return counts.filter((step > cut) | ((step == cut) & edge))
