"""PDF blocks as a table. The parser is a parameter: a function from a file's bytes to its pages' blocks.

PyMuPDF is used if it is installed and no parser is given. Everything behind this
reader takes a table of blocks, so the library is optional.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import book_name

BLOCKS = "source_book string, page int, block_ord int, x0 double, y0 double, x1 double, y1 double, page_height double, text string"
Block = tuple[int, int, float, float, float, float, float, str]


def installed_parser(content: bytes) -> Iterable[Block]:
    """(page, block_ord, x0, y0, x1, y1, page_height, text), pages from 1."""
    import fitz

    with fitz.open(stream=content, filetype="pdf") as book:
        for number, page in enumerate(book, 1):
            for k, b in enumerate(page.get_text("blocks")):
                yield number, k, b[0], b[1], b[2], b[3], page.rect.height, b[4]


def read_blocks(spark: SparkSession, path: str, parser: Callable[[bytes], Iterable[Block]] = installed_parser) -> DataFrame:
    """A row per block of the files at path."""
    import pandas as pd

    names = [x.split()[0] for x in BLOCKS.split(", ")]

    def parse(frames):
        for frame in frames:
            for book, content in zip(frame["source_book"], frame["content"], strict=True):
                rows = [(book, *b) for b in parser(bytes(content))]
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").load(path).select(book_name(F.col("path")).alias("source_book"), "content")
    return files.mapInPandas(parse, BLOCKS)
