"""Generation as a stream of chunks: each micro-batch's answers are validated, deduplicated against all earlier ones and appended.

The tables `examples` and `status` carry the batch's number, and a batch that runs
again after a failure replaces its own part, so a restart neither loses nor repeats
a chunk.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import by_signature, unseen
from ..operators.records import parse_answers, validate_strict
from ..sources.readers import read_state

EXAMPLES = "chunk_id string, instruction string, response string, concept string, difficulty string, source_book string, chapter string, source_chunk string, batch long"
STATUS = "chunk_id string, status string, batch long"


def take_batch(batch: DataFrame, number: int, root: str, min_response: int = 200) -> None:
    """batch: chunk_id, answer, source_book, chapter, source_chunk."""
    spark = batch.sparkSession
    done = read_state(spark, f"{root}/status", STATUS).filter(F.col("batch") != number)
    old = read_state(spark, f"{root}/examples", EXAMPLES).filter(F.col("batch") != number)
    todo = batch.join(done.select("chunk_id"), "chunk_id", "left_anti").dropDuplicates(["chunk_id"])
    judged = validate_strict(parse_answers(todo), min_response=min_response).drop("value")
    ok = unseen(by_signature(judged.filter("status = 'ok'"), "instruction", "chunk_id"), old)
    names = [x.split()[0] for x in EXAMPLES.split(", ")][:-1]
    part = f"batch={number}"
    ok.select(*names).write.mode("overwrite").parquet(f"{root}/examples/{part}")
    kept = spark.read.parquet(f"{root}/examples/{part}").select("chunk_id", F.lit(True).alias("kept"))
    status = judged.join(kept, "chunk_id", "left").select("chunk_id", F.when((F.col("status") == "ok") & F.col("kept").isNull(), "duplicate").otherwise(F.col("status")).alias("status"))
    status.write.mode("overwrite").parquet(f"{root}/status/{part}")


def run_stream(answers: DataFrame, root: str, min_response: int = 200, trigger: dict | None = None):
    """A streaming table of answered chunks -> the started query."""
    step: Callable[[DataFrame, int], None] = lambda batch, number: take_batch(batch, number, root, min_response)
    return answers.writeStream.foreachBatch(step).option("checkpointLocation", f"{root}/checkpoint").trigger(**(trigger or {"availableNow": True})).start()


def example_table(spark: SparkSession, root: str) -> DataFrame:
    return read_state(spark, f"{root}/examples", EXAMPLES)


def status_table(spark: SparkSession, root: str) -> DataFrame:
    return read_state(spark, f"{root}/status", STATUS)
