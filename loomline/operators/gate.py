"""The validation gate: the first reason that a row fails for, in the order of a stateful scan.

Only acceptable rows count as seen. So a hash's first acceptable row decides: rows
behind it are duplicates, over-long rows before it are over-long.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import approx_tokens, strip, text_hash
from .dedup import stripped_pair_hash

MIN_LENGTH, MAX_TOKENS, MAX_ISSUES = 50, 4096, 20
DUPLICATE = "Duplicate example found"
NOT_A_RECORD = "Record is not a valid JSON dictionary"


def _gated(df: DataFrame, early: Column, key: Column, size: Column, order: str, max_tokens: int, keep: Sequence[str] | None, hashed: str | None = None) -> DataFrame:
    """df with `reason` (null: valid).

    keep: the columns to return besides order, all by default. If given, texts are read and hashed once: what the gate
    needs of a row is dealt by its order, and the aggregate and the join read that one exchange (so keep no large column,
    and use reason). hashed: a name for the key's column, null where a row fails early.
    """
    # Early failures have keys of their own: null keys would be one partition of the join, and a filter on one side of it.
    own = F.xxhash64(order).cast("string")
    rows = df.withColumn("__early", early).withColumn("__key", F.coalesce(F.when(F.col("__early").isNull(), key), own)).withColumn("__size", size)
    if keep is not None:
        rows = rows.select(*dict.fromkeys((order, *keep, "__early", "__key", "__size"))).repartition(order)
    big = F.col("__size") > max_tokens * 4
    # A condition in the aggregate: a filter would move down to the scan, with a copy of all that it stands on.
    acceptable = F.when(F.col("__early").isNull() & ~big, F.col(order))
    first = rows.groupBy(F.col("__key").alias("__k")).agg(F.min(acceptable).alias("__first")).filter(F.col("__first").isNotNull())
    joined = rows.join(first, F.col("__key") == F.col("__k"), "left")
    if hashed:
        joined = joined.withColumn(hashed, F.when(F.col("__early").isNull(), F.col("__key")))
    too_long = F.concat(F.lit("Excessive sequence length (~"), F.floor(F.col("__size") / 4).cast("string"), F.lit(" tokens)"))
    reason = F.when(F.col("__early").isNotNull(), F.col("__early")).when(F.col(order) > F.col("__first"), DUPLICATE).when(big, too_long)
    return joined.withColumn("reason", reason).drop("__early", "__key", "__k", "__first", "__size")


def gate_texts(df: DataFrame, text: str = "text", order: str = "ord", min_length: int = MIN_LENGTH, max_tokens: int = MAX_TOKENS, keep: Sequence[str] | None = None, hashed: str | None = None) -> DataFrame:
    """Formatted rows. A null text is not a string; over-length counts the text as it stands. keep, hashed: as in _gated."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.length(strip(t))
    early = F.when(n == 0, "Field 'text' is empty or not a string").when(n < min_length, F.concat(F.lit("Formatted text too short ("), n.cast("string"), F.lit(f" chars < {min_length})")))
    return _gated(df, early, text_hash(t), F.length(t), order, max_tokens, keep, hashed)


def gate_pairs(df: DataFrame, order: str = "ord", min_length: int = MIN_LENGTH, max_tokens: int = MAX_TOKENS, missing: dict[str, Column] | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """Instruction and response rows. missing: for a field, the condition that its key is absent (a table's null is an explicit null). keep: as in _gated."""
    early = None
    for field in ("instruction", "response"):
        absent = (missing or {}).get(field, F.lit(False))
        blank = F.length(strip(F.coalesce(F.col(field), F.lit("")))) == 0
        said = F.lit(f"Missing required field: '{field}' (or 'text' for formatted datasets)")
        early = F.when(absent, said) if early is None else early.when(absent, said)
        early = early.when(blank, f"Field '{field}' is empty or not a string")
    n = F.length(strip(F.col("response")))
    early = early.when(n < min_length, F.concat(F.lit("Response too short ("), n.cast("string"), F.lit(f" chars < {min_length})")))
    size = F.length("instruction") + F.length("response")
    return _gated(df, early, stripped_pair_hash(F.col("instruction"), F.col("response")), size, order, max_tokens, keep)


def gate_report(gated: DataFrame) -> DataFrame:
    """Counts and the verdict over gated rows; an empty dataset fails."""
    invalid = F.count("reason")
    return gated.agg(
        F.count("*").alias("total_count"), (F.count("*") - invalid).alias("valid_count"), invalid.alias("invalid_count"),
        F.count_if(F.col("reason") == DUPLICATE).alias("duplicate_count"),
        F.when((invalid == 0) & (F.count("*") > 0), "PASS").otherwise("FAIL").alias("status"),
    )


def gate_issues(gated: DataFrame, order: str = "ord", limit: int = MAX_ISSUES) -> DataFrame:
    """The first failures, with a sample of the record (JSON, 150 characters)."""
    record = F.struct(*[F.col(c) for c in gated.columns if c not in ("reason",)])
    failed = gated.filter(F.col("reason").isNotNull())
    return failed.orderBy(order).limit(limit).select(F.col(order).alias("index"), "reason", F.substring(F.to_json(record), 1, 150).alias("record_sample"))


def tokens_of(text: Column) -> Column:
    return approx_tokens(text)
