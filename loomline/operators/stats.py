"""Statistics and reports: one-row aggregates. Averages are unrounded; the writers round half to even."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

MIN_ANSWER = 20


def dataset_statistics(df: DataFrame) -> DataFrame:
    """Examples, examples by level, mean response length and distinct concepts (without case and outer whitespace; only an empty concept doesn't count)."""
    level = {n: F.count_if(F.col("difficulty") == n).alias(f"{n.lower()}_count") for n in ("Beginner", "Intermediate", "Advanced")}
    concept = F.when(F.col("concept") != "", F.lower(strip(F.col("concept"))))
    return df.agg(F.count("*").alias("total_examples"), *level.values(), F.coalesce(F.avg(F.length(F.coalesce(F.col("response"), F.lit("")))), F.lit(0.0)).alias("average_response_length"), F.countDistinct(concept).alias("unique_concepts"))


def evaluation_summary(df: DataFrame, answer: str = "generated_response") -> DataFrame:
    """Answers, those longer than 20 characters, and their mean length."""
    n = F.length(F.coalesce(F.col(answer), F.lit("")))
    return df.agg(F.count("*").alias("total_evaluated"), F.count_if(n > MIN_ANSWER).alias("valid_responses"), (F.coalesce(F.sum(n), F.lit(0)) / F.greatest(F.lit(1), F.count("*"))).alias("average_response_length"))


def generation_report(chunks: DataFrame, status: str = "status", existing: int = 0, failed_before: int = 0) -> DataFrame:
    """chunks with a status (ok, duplicate, invalid, generation_failed, pending) -> the run's counters."""
    count = lambda *names: F.count_if(F.col(status).isin(*names))
    return chunks.agg(
        F.count("*").alias("total_chunks"), (F.lit(existing) + count("ok", "duplicate")).cast("long").alias("processed_chunks"), (F.lit(failed_before) + count("invalid", "generation_failed", "not_an_object")).cast("long").alias("failed_chunks"),
        (F.lit(existing) + count("ok", "duplicate")).cast("long").alias("generated_examples"), count("duplicate").alias("duplicates_removed"), (F.lit(existing) + count("ok")).cast("long").alias("final_examples"),
    )
