"""Spark session settings used by tests, bench and examples.

On a cluster the session comes from the platform; ``tune`` only adds the
SQL settings this engine relies on (AQE, skew joins, UTC) and never touches
``spark.checkpoint.dir`` when the cluster already names one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: For the panel's queries. The JVM never compiles a method of more than 8,000 bytes, so stages with many
#: columns leave whole-stage code, whose one method they would overflow. Small splits and shuffle
#: partitions bound what a task's maps and sorts hold, whatever the size of the table.
PANEL_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def tune(spark: SparkSession, panel: bool = True) -> SparkSession:
    for k, v in SQL_SETTINGS.items():
        spark.conf.set(k, v)
    for k, v in PANEL_SETTINGS.items():
        if panel:
            spark.conf.set(k, v)
        else:  # back to what the session started with
            spark.conf.unset(k)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "auctide", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": os.environ.get("AUCTIDE_DRIVER_MEMORY", "16g"),
        **SQL_SETTINGS,
        **(extra or {}),
    }
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir``, else the folder set on the context. A
    local session without either gets a fresh folder under the system temp
    dir; on a cluster that folder would not be shared, so it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="auctide-ckpt-")
        sc.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder for one job's tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system delete a scratch path when the session's JVM ends."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back; gone when the session ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    drop_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
