"""Writers. Data goes through Spark's committers; one-row reports become a JSON file by write and rename."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def write_dataset(df: DataFrame, path: str) -> None:
    """Parquet and JSON lines; the second is written from the first, so both hold the same rows."""
    df.write.mode("overwrite").parquet(f"{path}/parquet")
    write_jsonl(df.sparkSession.read.parquet(f"{path}/parquet"), f"{path}/jsonl")


def write_text(df: DataFrame, path: str, column: str = "text") -> None:
    df.select(column).write.mode("overwrite").text(path)


def write_json(spark: SparkSession, value, path: str) -> None:
    """A small value as indented UTF-8 JSON: written beside the target, then renamed onto it in one step."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(json.dumps(value, indent=2, ensure_ascii=False, default=str).encode()))
    finally:
        out.close()
    # One rename that replaces the target: a reader finds the old file or the new one, never none.
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(part), fs.makeQualified(target), how)


def write_report(report: DataFrame, path: str, digits: int = 2, **extra) -> dict:
    """A one-row report; doubles are rounded half to even, a timestamp is added if there is none."""
    row = report.select(*[F.bround(c, digits).alias(c) if t == "double" else F.col(c) for c, t in report.dtypes]).first().asDict(recursive=True) | extra
    row.setdefault("timestamp", datetime.now(UTC).isoformat())
    write_json(report.sparkSession, row, path)
    return row


def run_folder(root: str, now: datetime | None = None) -> dict[str, str]:
    """Paths of a run: run_YYYYMMDD_HHMMSS with adapter, checkpoints, evaluation, logs and metadata.json."""
    base = f"{root}/run_{(now or datetime.now(UTC)):%Y%m%d_%H%M%S}"
    return {"root": base, **{k: f"{base}/{k}" for k in ("adapter", "checkpoints", "evaluation", "logs")}, "metadata": f"{base}/metadata.json"}
