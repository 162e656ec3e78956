"""A source of book pages whose partitions are ranges of pages, so that one large file is read by many tasks.

How a file is opened is the caller's: an opener has count(path), the number of pages, and texts(path, first, end), the texts of a range.
Both open the path themselves, on the driver (the count) and on the executors (the texts), so the files must be in reach of
both. Files that only Spark can open are read whole by read_pdf_pages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..operators.pages import printed_page_number
from ..schemas import PAGE
from ..shipping import ship_session

PAGES_EACH = 50


class Opener(Protocol):
    def count(self, path: str) -> int: ...

    def texts(self, path: str, first: int, end: int) -> Iterator[str]: ...


class PdfOpener:
    """Pages of PDF files by a library that driver and executors must have."""

    def count(self, path: str) -> int:
        import fitz

        with fitz.open(path) as book:
            return book.page_count

    def texts(self, path: str, first: int, end: int) -> Iterator[str]:
        import fitz

        with fitz.open(path) as book:
            for i in range(first, end):
                yield book[i].get_text("text")


@dataclass
class PageRange(InputPartition):
    path: str
    first: int
    end: int


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], each: int, opener: Opener):
        self.paths, self.each, self.opener = paths, each, opener

    def partitions(self) -> list[PageRange]:
        counts = [(p, self.opener.count(p)) for p in self.paths]
        return [PageRange(p, lo, min(lo + self.each, n)) for p, n in counts for lo in range(0, n, self.each)]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        for i, text in enumerate(self.opener.texts(partition.path, partition.first, partition.end), partition.first):
            yield i, None, text, "pymupdf", partition.path


def _source(opener: Opener) -> type[DataSource]:
    class BookPages(DataSource):
        @classmethod
        def name(cls) -> str:
            return "book_pages"

        def schema(self) -> str:
            return f"{PAGE}, path string"

        def reader(self, schema: StructType) -> DataSourceReader:
            return _Reader(self.options["paths"].split("\n"), int(self.options["each"]), opener)

    return BookPages


def read_pages(spark: SparkSession, paths: list[str], opener: Opener | None = None, each: int = PAGES_EACH) -> DataFrame:
    """Pages of files, each with its file's path, in partitions of so many pages. A file without pages has no rows."""
    ship_session(spark)
    spark.dataSource.register(_source(opener or PdfOpener()))
    rows = spark.read.format("book_pages").option("paths", "\n".join(paths)).option("each", str(each)).load()
    return rows.withColumn("printed_page_number", printed_page_number(F.col("raw_text")))
