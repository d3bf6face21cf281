"""Mixing sources to target weights with a time-varying curriculum, in DataFrame functions only.

Every source has a weight; together the targets are the size of all sources, a
target stops at `max_repeats` times its source's size and the excess goes to the
others by weight (water filling). Over training time t in [0, 1] a source is
drawn at the rate target * (1 + slope * (2t - 1)); its integral, the cumulative
token demand, is target * (t + slope * (t^2 - t)). A source's documents stand in a
seeded hash order, pass after pass; the inverse of the demand at the place where
a copy begins is the time at which it is drawn. All sources' demand up to that time, as a
share of all targets, is the copy's training position, its place in the mixed token
stream (for one source alone, rates of all sources don't add up to a constant); documents are range-sorted
by position.

A copy is taken when its middle lies before the target, so a source's words are
within half a document of it. Running sums are made in two levels (blocks of the
hash order, then rows of a block), so a source that holds a third of all rows is
spread over as many tasks as its rows need.

Defined results: a null text has size 0; documents of size 0 are taken 0 words;
a null source is a source of its own, last in order; repeated rows are separate
documents and stand side by side; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, words

#: Rows of a source that one block of the hash order holds, about.
BLOCK_ROWS = 2048


def default_weight(rank: Column) -> Column:
    """1, 2, 3, repeating, over sources by code point, null last."""
    return (rank - 1) % 3 + 1


def default_slope(rank: Column) -> Column:
    """Early, even and late sources in turn."""
    return ((rank - 1) % 3 - 1) * F.lit(0.5)


def source_targets(sizes: DataFrame, max_repeats: int = 3, weight=default_weight, slope=default_slope) -> DataFrame:
    """sizes (source, n_rows, source_size) -> with weight, slope and target. One row per source goes through the windows, not the documents.

    With sources by rising cap per weight the capped ones come first: source i is
    capped if sharing what the earlier caps leave among i and the later ones would exceed its cap.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    s = ranked.select("source", "n_rows", "source_size", weight(F.col("rank")).cast("double").alias("weight"), slope(F.col("rank")).cast("double").alias("slope"))
    s = s.withColumn("cap", F.col("source_size") * float(max_repeats))
    by = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward, everything = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing), by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    s = s.withColumn("level", left / F.sum("weight").over(onward)).withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    level = F.first(F.when(~F.col("capped"), F.col("level")), ignorenulls=True).over(everything)
    s = s.withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(level * F.col("weight")))
    return s.select("source", "n_rows", "source_size", "weight", "slope", "target", F.sum("target").over(everything).alias("total"), F.sum(F.col("target") * F.col("slope")).over(everything).alias("bend"))


def position(begin: Column, target: Column, slope: Column) -> Column:
    """t where the cumulative demand target * (t + slope * (t^2 - t)) reaches begin."""
    share = F.coalesce(F.least(F.try_divide(begin, target), F.lit(1.0)), F.lit(0.0))
    linear = 1 - slope
    root = F.sqrt(linear * linear + 4 * slope * share)
    return F.when(slope == 0, share).otherwise(F.coalesce(F.try_divide(2 * share, linear + root), F.lit(0.0)))


def stream_place(t: Column, total: Column, bend: Column) -> Column:
    """The share of all demand up to time t: total * t + bend * (t^2 - t) over total, for bend the sum of target * slope."""
    return t + F.coalesce(F.try_divide(bend, total), F.lit(0.0)) * (t * t - t)


def plan(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", max_repeats: int = 3, seed: int = 42, weight=default_weight, slope=default_slope, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, source, taken, n_copies, positions (of its copies), and the columns of `extra`."""
    slim = df.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.size(words(F.col(text))).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("h"), *extra,
    )
    slim = materialize(slim, "mix-sizes")
    targets = source_targets(slim.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("size").alias("source_size")), max_repeats, weight, slope)
    t = materialize(targets.withColumnRenamed("source", "s").withColumn("n_blocks", F.greatest(F.lit(1), F.col("n_rows") / BLOCK_ROWS).cast("long")), "mix-targets")
    # The block is the hash's rank as a fraction of the hash range, so blocks follow the hash order.
    block = F.floor((F.shiftrightunsigned("h", 33) / F.lit(float(2**31))) * F.col("n_blocks")).cast("long")
    rows = slim.join(t, slim["source"].eqNullSafe(t["s"])).drop("s").withColumn("block", block)
    sums = rows.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    starts = sums.select(F.col("source").alias("s"), F.col("block").alias("b"), F.coalesce(F.sum("block_size").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("block_start"))
    rows = rows.join(starts, rows["source"].eqNullSafe(starts["s"]) & (rows["block"] == starts["b"])).drop("s", "b")
    within = Window.partitionBy("source", "block").orderBy(F.shiftrightunsigned("h", 1), "h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("block_start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    rows = rows.withColumn("begin", begin)
    places = F.filter(F.transform(F.sequence(F.lit(0), F.lit(max_repeats - 1)), lambda k: k * F.col("source_size") + F.col("begin")), lambda b: (F.col("size") > 0) & (b + F.col("size") / 2.0 < F.col("target")))
    rows = rows.withColumn("places", places)
    return rows.select(
        "doc_id", "size", "source_size", "target", "source", (F.size("places") * F.col("size")).cast("long").alias("taken"), F.size("places").alias("n_copies"),
        F.transform("places", lambda b: stream_place(position(b, F.col("target"), F.col("slope")), F.col("total"), F.col("bend"))).alias("positions"), *extra,
    )


def in_order(planned: DataFrame) -> DataFrame:
    """plan()'s rows, range-sorted by their first position; documents that aren't taken last."""
    first = F.get("positions", F.lit(0))
    return planned.repartitionByRange(first.asc_nulls_last(), F.col("doc_id")).sortWithinPartitions(first.asc_nulls_last(), "doc_id")


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The training order: every taken copy of every document with its columns, range-sorted by position.

    Rows are numbered in a table in the shared folder, so that repeated rows are rows of their own.
    """
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "mix-rows")
    p = plan(rows, doc_id, text, source, extra=("__row",), **options)
    copies = p.filter("n_copies > 0").select("__row", F.explode("positions").alias("__position"))
    placed = rows.join(copies, "__row").repartitionByRange(F.col("__position"), F.col(doc_id))
    out = placed.sortWithinPartitions("__position", doc_id, "__row").select(*df.columns)
    out._scratch_path = rows._scratch_path  # for drop_table() once the result is written
    return out
