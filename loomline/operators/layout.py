"""From page blocks to segments: margins, watermarks, headings, chapters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_segment, is_heading, without_watermarks

MARGIN_TOP, MARGIN_BOTTOM, FIRST_CHAPTER = 50.0, 55.0, "Preface"


def body_blocks(blocks: DataFrame, top: float = MARGIN_TOP, bottom: float = MARGIN_BOTTOM) -> DataFrame:
    """Blocks outside the header and footer margins, watermarks removed, empty ones dropped."""
    inside = blocks.filter((F.col("y1") >= top) & (F.col("y0") <= F.col("page_height") - bottom))
    return inside.withColumn("text", without_watermarks(F.col("text"))).filter(F.length("text") > 0)


def with_chapters(blocks: DataFrame, *order: str) -> DataFrame:
    """Each block's chapter: the last heading at or before it in its book. Blocks of a page stand by y0, equal ones as they came."""
    by = Window.partitionBy("source_book").orderBy(*(order or ("page", "y0", "block_ord"))).rowsBetween(Window.unboundedPreceding, 0)
    heading = F.when(is_heading(F.col("text")), F.col("text"))
    return blocks.withColumn("chapter", F.coalesce(F.last(heading, ignorenulls=True).over(by), F.lit(FIRST_CHAPTER)))


def segments(blocks: DataFrame, top: float = MARGIN_TOP, bottom: float = MARGIN_BOTTOM) -> DataFrame:
    """blocks (source_book, page, block_ord, x0, y0, x1, y1, page_height, text) -> source_book, ord, text, chapter, page."""
    found = with_chapters(body_blocks(blocks, top, bottom))
    order = F.struct("page", "y0", "block_ord")
    return found.select("source_book", order.alias("ord"), "text", "chapter", "page")


def cleaned(found: DataFrame) -> DataFrame:
    """Segments with clean texts, those that end up empty dropped."""
    return found.withColumn("text", clean_segment(F.col("text"))).filter(F.length("text") > 0)


def flat_text(found: DataFrame) -> DataFrame:
    """source_book, text: a book's segments joined by blank lines."""
    return found.groupBy("source_book").agg(F.array_sort(F.collect_list(F.struct("ord", "text"))).alias("s")).select("source_book", F.array_join(F.transform("s", lambda s: s["text"]), "\n\n").alias("text"))
