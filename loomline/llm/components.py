"""Connected components of an edge table, by alternating large-star and small-star steps, a written table between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, materialize


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _star(both: DataFrame, large: bool) -> DataFrame:
    """both: (a, b) neighbours of a. Each a hands its (larger, for large) neighbours to the least of all that it sees."""
    if not large:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    met = both.join(least, F.col("a") == F.col("u"))
    if large:
        return met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of any orderable type -> (node, comp): every node of an edge with the least node of its component.

    Nothing is collected; the steps are a logarithm of the longest path in number. A star of any size is an aggregate and a join that Spark can split.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        # Large-star: both directions; what comes out points from larger to smaller nodes.
        wide = _star(now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b"))), True)
        step = _star(wide.filter("a <> b").distinct(), False).filter("a <> b").distinct()
        after = materialize(step, "edges")
        was, now = now, after
        drop_table(was)
        before, mark = mark, _mark(now)
        if tuple(before) == tuple(mark):
            break
    out = now.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
    out._scratch_path = now._scratch_path
    return out
