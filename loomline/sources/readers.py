"""Readers. Every relation carries its order: JSON lines by file and place, batches by file name and position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VALUES = "ord struct<file: string, pos: long>, value variant"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store; a glob if it matches anything."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p))


def _whole(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, pos, line of the lines that aren't blank. A file is taken whole, as the order of its lines counts."""
    files = _whole(spark, path).select("file", F.posexplode(F.split("text", "\r?\n")).alias("pos", "line"))
    return files.filter(F.length(F.trim("line")) > 0)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Strict: a malformed line fails the job."""
    return _lines(spark, path).select(F.struct("file", F.col("pos").cast("long").alias("pos")).alias("ord"), F.parse_json("line").alias("value"))


def read_jsonl_prefix(spark: SparkSession, path: str) -> DataFrame:
    """Tolerant: of each file the lines before the first malformed one; nothing if there is no file."""
    if not exists(spark, path):
        return spark.createDataFrame([], VALUES)
    lines = _lines(spark, path).withColumn("value", F.try_parse_json("line"))
    bad = lines.filter("value is null").groupBy("file").agg(F.min("pos").alias("bad")).withColumnRenamed("file", "f")
    kept = lines.join(bad, F.col("file") == F.col("f"), "left").filter(F.col("bad").isNull() | (F.col("pos") < F.col("bad")))
    return kept.select(F.struct("file", F.col("pos").cast("long").alias("pos")).alias("ord"), "value")


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """file, value: whole documents."""
    return _whole(spark, path).select("file", F.parse_json("text").alias("value"))


def _elements(values: DataFrame) -> DataFrame:
    """The elements of array values, in order."""
    values.createOrReplaceTempView("__loomline_values")
    return values.sparkSession.sql("SELECT struct(file, CAST(e.pos AS LONG) AS pos) AS ord, e.value AS value FROM __loomline_values, LATERAL variant_explode(value) AS e")


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all *.json arrays in a folder, by file name; files that are no array or don't parse are skipped; no folder, no records."""
    if not exists(spark, f"{folder}/*.json"):
        return spark.createDataFrame([], VALUES)
    values = _whole(spark, f"{folder}/*.json").select("file", F.try_parse_json("text").alias("value"))
    return _elements(values.filter(F.schema_of_variant("value").startswith("ARRAY")))


def skipped_batches(spark: SparkSession, folder: str) -> DataFrame:
    """file, reason of the files that read_batches() passes over."""
    values = _whole(spark, f"{folder}/*.json").select("file", F.try_parse_json("text").alias("value"))
    reason = F.when(F.col("value").isNull(), "not JSON").when(~F.schema_of_variant("value").startswith("ARRAY"), "not a list")
    return values.select("file", reason.alias("reason")).filter("reason is not null")


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """By suffix: .jsonl, or .json with a list or an object that has `examples`."""
    if path.endswith(".jsonl"):
        return read_jsonl(spark, path)
    if not path.endswith(".json"):
        raise ValueError(f"unsupported dataset format: {path}")
    value = F.col("value")
    examples = F.when(F.schema_of_variant(value).startswith("ARRAY"), value).otherwise(F.try_variant_get(value, "$.examples", "variant"))
    whole = read_json(spark, path).select("file", examples.alias("value"))
    if whole.filter("value is null").take(1):
        raise ValueError(f"neither a list nor an object with examples: {path}")
    return _elements(whole)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Formatted records; the column `text` must be there, others are pruned from the scan."""
    df = spark.read.json(path)
    if "text" not in df.columns:
        raise ValueError("the dataset has no text column")
    return df.select("text")


def read_state(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A state table of an earlier run; empty if there is none or it can't be read."""
    if exists(spark, path):
        try:
            df = spark.read.schema(schema).parquet(path)
            df.take(1)
            return df
        except Exception:
            pass
    return spark.createDataFrame([], schema)


def default_source(paths: list[str], preferred: str = "") -> str:
    """The first *.pdf by name, one whose name has `preferred` before others."""
    found = sorted(p for p in paths if p.lower().endswith(".pdf"))
    if not found:
        raise FileNotFoundError("no PDF among the sources")
    return next((p for p in found if preferred and preferred.lower() in p.rsplit("/", 1)[-1].lower()), found[0])
