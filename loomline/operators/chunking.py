"""Overlapping word-count chunks of a book's segments.

Segments are taken in order until `size` words are reached; the next chunk begins
with as many whole segments from the end as `overlap` words allow, one at least and
never all. The fold runs inside Catalyst over word counts, one row per book.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import chunk_id, let, word_count

SIZE, OVERLAP = 750, 75
_SPAN = "array<struct<st: int, en: int>>"


def spans(counts: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """array<int> of segments' words -> the chunks' first and last segments, from 0."""
    return let(counts, lambda c: _fold(c, size, overlap))


def _fold(counts: Column, size: int, overlap: int) -> Column:
    n = F.size(counts)
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("st"), F.lit(0).alias("held"), F.array().cast(_SPAN).alias("out"))

    def kept(acc: Column, last: Column) -> Column:
        """Words and number of the segments that the next chunk begins with."""
        back = F.reverse(F.slice(counts, acc["st"] + 2, last - acc["st"]))
        zero = F.struct(F.lit(0).alias("c"), F.lit(0).alias("t"), F.lit(False).alias("over"))

        def walk(a: Column, w: Column) -> Column:
            over = a["over"] | ((a["c"] > 0) & (a["t"] + w > overlap))
            return F.struct(F.when(over, a["c"]).otherwise(a["c"] + 1).alias("c"), F.when(over, a["t"]).otherwise(a["t"] + w).alias("t"), over.alias("over"))

        return F.aggregate(back, zero, walk)

    def step(acc: Column, w: Column) -> Column:
        held, i = acc["held"] + w, acc["i"]
        full = (held >= size) | (i == n - 1)
        out = F.array_append(acc["out"], F.struct(acc["st"].alias("st"), i.alias("en")))
        after = F.transform(F.array(kept(acc, i)), lambda k: F.struct((i + 1).alias("i"), (i - k["c"] + 1).alias("st"), k["t"].alias("held"), out.alias("out")))
        return F.when(full, F.element_at(after, 1)).otherwise(F.struct((i + 1).alias("i"), acc["st"].alias("st"), held.alias("held"), acc["out"].alias("out")))

    return F.aggregate(counts, start, step, lambda a: a["out"])


def chunk_arrays(df: DataFrame, segments: str, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """df with an array column of segment structs that have `text`; a row per chunk: number (from 1), st, en, and the slice `segs`."""
    counts = F.transform(F.col(segments), lambda s: word_count(s["text"]))
    made = df.withColumn("__spans", spans(counts, size, overlap)).select("*", F.posexplode("__spans").alias("__k", "__s"))
    return made.withColumns({"number": F.col("__k") + 1, "st": F.col("__s.st"), "en": F.col("__s.en"), "segs": F.slice(F.col(segments), F.col("__s.st") + 1, F.col("__s.en") - F.col("__s.st") + 1)}).drop("__spans", "__k", "__s", segments)


def chunks(segments: DataFrame, size: int = SIZE, overlap: int = OVERLAP, order: str = "ord") -> DataFrame:
    """segments (source_book, ord, text, chapter, page) -> chunk_id, source_chunk, source_book, chapter (the last segment's), start_page, end_page."""
    row = F.struct(F.col(order).alias("ord"), "text", "chapter", "page")
    books = segments.groupBy("source_book").agg(F.array_sort(F.collect_list(row)).alias("all"))
    made = chunk_arrays(books, "all", size, overlap)
    last = F.element_at("segs", -1)
    return made.select(
        "source_book", F.col("number").alias("ord"), chunk_id(F.col("number")).alias("chunk_id"), F.array_join(F.transform("segs", lambda s: s["text"]), "\n\n").alias("source_chunk"),
        last["chapter"].alias("chapter"), F.element_at("segs", 1)["page"].alias("start_page"), last["page"].alias("end_page"),
    )


def first_chunks(df: DataFrame, n: int | None, order: str = "ord") -> DataFrame:
    """The first n chunks in order; all if n is None."""
    return df if n is None else df.orderBy("source_book", order).limit(n)
