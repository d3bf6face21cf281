"""A corpus pipeline in five stages: quality rules, near-duplicates, secrets, mixing, tokens.

Each stage takes all that the one before kept, as a table, and returns the columns
of documents (the last one: every document's tokens). run() writes each stage's
result into the shared folder and reads it back.

Defined results, stage by stage:

- quality rules: null, empty and short texts are rejected; repeated rows are judged each.
- near-duplicates: of repeated rows and near copies one stays, the row of least id (a null id
  last); rows that share an id, or have none, stand for their own texts.
- secret scans: no row goes; a null source counts as an empty path; very long texts are read whole.
- mixing: a null source is one of its own; repeated rows are taken each; a row of size 0 isn't taken.
- tokens: a row for each copy, in no order; ties and repeated rows are rows of their own.

Columns besides those of documents, whatever their names, pass through all but the last
stage; an empty table gives an empty table at every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm.bpe import digests
from loomline.llm.common import drop_table, materialize
from loomline.llm.minhash_dedup import representatives
from loomline.llm.mixing import mix
from loomline.llm.quality_rules import keep
from loomline.llm.secret_scans import redact

#: Words of a chunk in the tokens stage, fewer than by the operator's own default: executors still hold what earlier stages left in memory.
CHUNK_WORDS = 4 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no quality rule rejects."""
    return keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return representatives(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets in its text replaced; n_chars counts the new text."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: documents as often as their source's target takes them."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text, a row for each copy."""
    return digests(docs, chunk_words=CHUNK_WORDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("near-duplicates", near_dedup),
    ("secret scans", secrets),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: Near-duplicates, the forest and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        after = materialize(made, name.replace(" ", "-"))
        drop_table(made)
        if before is not None:
            drop_table(before)
        docs = before = after
    return docs
