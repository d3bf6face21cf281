"""First-wins deduplication. One aggregate with map-side combine: a key that a third of the rows share reaches its task as one row per map task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import signature, strip, text_hash


def first_by(df: DataFrame, key: Column, *order: str) -> DataFrame:
    """Of each key the row that comes first; rows of a null key are dropped. order: columns that tell rows apart."""
    row = F.struct(*[F.col(c) for c in df.columns])
    keyed = df.select(key.alias("__key"), F.struct(*order).alias("__order"), row.alias("__row")).filter(F.col("__key").isNotNull())
    return keyed.groupBy("__key").agg(F.min_by("__row", "__order").alias("r")).select("r.*")


def by_signature(df: DataFrame, instruction: str = "instruction", *order: str) -> DataFrame:
    """By the instruction without case and whitespace; an empty one counts as a duplicate."""
    key = signature(F.col(instruction))
    return first_by(df, F.when(key != "", key), *(order or ("ord",)))


def pair_hash(instruction: Column, response: Column) -> Column:
    return text_hash(F.concat(instruction, F.lit(" || "), response))


def by_pair_hash(df: DataFrame, *order: str) -> DataFrame:
    """By instruction and response together; adds example_hash."""
    hashed = df.withColumn("example_hash", pair_hash(F.col("instruction"), F.col("response")))
    return first_by(hashed, F.col("example_hash"), *(order or ("ord",)))


def unseen(df: DataFrame, existing: DataFrame, instruction: str = "instruction") -> DataFrame:
    """Rows whose signature no existing row has (the seeding of a later run)."""
    seen = existing.select(signature(F.col(instruction)).alias("__sig")).distinct()
    return df.join(seen, signature(df[instruction]) == F.col("__sig"), "left_anti")


def stripped_pair_hash(instruction: Column, response: Column) -> Column:
    return pair_hash(strip(instruction), strip(response))
