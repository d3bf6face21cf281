"""Records: strict validation of generated JSON, merge validation, cleaning, merging of two sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fenced_json, lenient_difficulty, let, strict_difficulty, strip, strip_greetings
from .dedup import by_pair_hash

STRICT_FIELDS = ("instruction", "response", "concept", "difficulty")
MERGE_FIELDS = (*STRICT_FIELDS, "chapter", "source_book")
MIN_RESPONSE = 100


def field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def is_string(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def as_string(value: Column) -> Column:
    """The text of a JSON string, as str() has it for other values (null: None)."""
    plain = F.try_variant_get(value, "$", "string")
    return F.when(value.isNull(), F.lit(None).cast("string")).when(F.is_variant_null(value), "None").otherwise(F.coalesce(plain, F.to_json(value)))


def parse_answers(df: DataFrame, answer: str = "answer", out: str = "value") -> DataFrame:
    """df with the answer's JSON as a VARIANT, null where there is none."""
    return df.withColumn(out, fenced_json(F.col(answer)))


def validate_strict(df: DataFrame, value: str = "value", min_response: int = MIN_RESPONSE) -> DataFrame:
    """df with `status` (ok, generation_failed, not_an_object, invalid) and the four fields, stripped; they are null unless ok."""

    def judged(v: Column) -> Column:
        text = F.struct(*[strip(F.try_variant_get(v, f"$.{n}", "string")).alias(n) for n in STRICT_FIELDS], strict_difficulty(F.try_variant_get(v, "$.difficulty", "string")).alias("level"), F.to_json(v).alias("json"), F.schema_of_variant(v).alias("kind"))
        strings = F.lit(True)
        for n in STRICT_FIELDS:
            strings = strings & is_string(field(v, n))

        def of(t: Column) -> Column:
            good = strings & (F.length(t["response"]) >= min_response) & t["level"].isNotNull()
            for n in STRICT_FIELDS:
                good = good & (F.length(t[n]) > 0)
            # What Python takes for false is a failed generation.
            falsy = v.isNull() | F.is_variant_null(v) | t["json"].isin("{}", "[]", "0", "false", '""', "0.0")
            status = F.when(falsy, "generation_failed").when(~t["kind"].startswith("OBJECT"), "not_an_object").when(good, "ok").otherwise("invalid")
            return F.struct(status.alias("status"), *[(t["level"] if n == "difficulty" else t[n]).alias(n) for n in STRICT_FIELDS])

        return let(text, of)

    out = df.withColumn("__judged", let(F.col(value), judged)).withColumn("status", F.col("__judged.status"))
    return out.withColumns({n: F.when(F.col("status") == "ok", F.col(f"__judged.{n}")) for n in STRICT_FIELDS}).drop("__judged")


def merge_reason(value: Column) -> Column:
    """Why a JSON record can't be merged, or null. An explicit null passes as the text None, a missing key doesn't; text fields must be strings."""

    def of(keys: Column) -> Column:
        reason = None
        for n in MERGE_FIELDS:
            absent = ~F.coalesce(F.array_contains(keys, n), F.lit(False)) | (F.length(strip(as_string(field(value, n)))) == 0)
            reason = F.when(absent, f"missing_{n}") if reason is None else reason.when(absent, f"missing_{n}")
        for n in ("instruction", "response", "concept"):
            reason = reason.when(~is_string(field(value, n)), "non_string_field")
        return reason

    return let(F.json_object_keys(F.to_json(value)), of)


def clean_records(df: DataFrame) -> DataFrame:
    """Instruction and concept stripped, the response's greetings taken off, difficulty made one of three."""
    return df.withColumns({"instruction": strip(F.col("instruction")), "concept": strip(F.col("concept")), "response": strip_greetings(F.col("response")), "difficulty": lenient_difficulty(F.col("difficulty"))})


def merge(generated: DataFrame, batches: DataFrame, order: str = "ord") -> DataFrame:
    """Two sources of JSON records (value VARIANT, ord): valid ones cleaned, the generated ones first, duplicates dropped; adds example_hash."""
    both = generated.select(F.lit(0).alias("source_rank"), F.col(order).alias("ord"), "value").unionByName(batches.select(F.lit(1).alias("source_rank"), F.col(order).alias("ord"), "value"))
    valid = both.filter(merge_reason(F.col("value")).isNull())
    fields = valid.select("source_rank", "ord", *[F.try_variant_get("value", f"$.{n}", "string").alias(n) for n in MERGE_FIELDS])
    return by_pair_hash(clean_records(fields), "source_rank", "ord")


def with_defaults(value: Column, defaults: dict[str, str]) -> dict[str, Column]:
    """Fields of a JSON record; a missing key takes its default, an explicit null stays null."""
    keys = F.json_object_keys(F.to_json(value))
    return {n: F.when(~F.coalesce(F.array_contains(keys, n), F.lit(False)), d).otherwise(F.try_variant_get(value, f"$.{n}", "string")) for n, d in defaults.items()}
