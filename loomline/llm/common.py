"""Helpers shared by the training-data operators: scratch tables, keys, word splitting."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = "\t\n\x0b\x0c\r"
#: Stands for a null id in join keys.
NULL_KEY = -(2**63)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, spark.checkpoint.dir. Where it is unset, a local session gets a temporary folder and a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="loomline-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to a table in the shared folder and read it back: lineage ends there, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch_path = path
    return back


def drop_table(df: DataFrame) -> None:
    """Delete a table of materialize() that nothing reads any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        remove_path(df.sparkSession, path)


def remove_path(spark: SparkSession, path: str) -> None:
    jvm, sc = spark._jvm, spark.sparkContext
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512, size: int = 64 << 20):
    """Inside, rows go to Python workers in batches of at most so many rows and about so many bytes; for jobs that run before the block ends."""
    keys = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {k: spark.conf.get(k) for k in keys}
    for k, most in keys.items():
        had = int(before[k].removesuffix("b"))
        spark.conf.set(k, str(min(most, had) if had > 0 else most))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def words(text: Column) -> Column:
    """The words of a text (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \t-\r]+"), "")


def let(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda variable instead of a copied expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def key_of(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NULL_KEY))


def release_memory() -> None:
    """Give memory that this process has freed back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(work):
    """work, a function for mapInArrow, leaving no freed memory behind: Python workers outlive tasks and stages."""

    def run(batches):
        release_memory()
        yield from work(batches)
        release_memory()

    return run
