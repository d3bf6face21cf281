"""State of a resumable run: which chunks are left, which failed and why."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import first_by


def pending(chunks: DataFrame, completed: DataFrame, failed: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Chunks that are neither completed nor failed (failed ones are not tried again)."""
    return chunks.join(completed.select(key), key, "left_anti").join(failed.select(key), key, "left_anti")


def upsert_failed(known: DataFrame, new: DataFrame, key: str = "chunk_id", order: str = "timestamp") -> DataFrame:
    """known with the new failures of chunks that it lacks; a chunk's first reason stays."""
    fresh = first_by(new.select(*known.columns), F.col(key), order).join(known.select(key), key, "left_anti")
    return known.unionByName(fresh.select(*known.columns))


def checkpoint(completed: DataFrame, key: str = "chunk_id") -> DataFrame:
    """completed_chunks and generated_examples, which counts every completed chunk, failed and duplicate ones too."""
    return completed.agg(F.array_sort(F.collect_set(key)).alias("completed_chunks"), F.count("*").alias("generated_examples"), F.current_timestamp().cast("string").alias("timestamp"))
