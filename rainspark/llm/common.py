"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: space and the bytes 09 to 0D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, which the cluster names in spark.checkpoint.dir.

    Only a session in one process (local tests), where the setting is empty, gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write df once into the shared folder and read it back: it cuts the lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*tables: DataFrame, sweep: bool = False) -> None:
    """Delete staged tables that nothing needs any more.

    With sweep the driver's JVM is asked to collect its garbage, so that Spark drops the shuffle files of plans that are
    gone as well.
    """
    spark = tables[0].sparkSession
    for df in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if sweep:
        gc.collect()
        spark._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_batches(spark: SparkSession, rows: int = 256) -> None:
    """Texts can be long: unless the session sets its own number, hand them to Python in batches of a few rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":  # Spark's default
        spark.conf.set(name, rows)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the key and the text of a table, under fixed names; a null text is empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers (shift-multiply rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
