"""Evaluation leakage: questions whose hash is that of a training text or instruction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import text_hash


def training_hashes(train: DataFrame) -> DataFrame:
    parts = [train.select(text_hash(F.col(c)).alias("hash")).filter("hash is not null") for c in ("text", "instruction") if c in train.columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


def leaked(questions: DataFrame, train: DataFrame) -> DataFrame:
    """The question rows that leak; a missing instruction counts as an empty one. The side that is broadcast, if any, is Spark's choice by size."""
    hashes = training_hashes(train)
    return questions.join(hashes, text_hash(F.coalesce(questions["instruction"], F.lit(""))) == hashes["hash"], "left_semi")
