"""Page-level operators: printed page number and text cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import DIGIT, filled_lines, let, lines, single_spaced, strip


def printed_page_number(text: Column) -> Column:
    """First wholly numeric line of 1 to 4 digits among the first five, then the last five, filled lines."""
    near_edges = let(filled_lines(text), lambda own: F.concat(F.slice(own, 1, 5), F.slice(own, F.greatest(F.size(own) - 4, F.lit(1)), F.lit(5))))
    return F.get(F.filter(near_edges, lambda x: F.regexp_like(x, F.lit(rf"\A{DIGIT}{{1,4}}\z"))), 0)


#: Lines that go: a page number, up to eight roman letters of either case, a row of at least five separators.
_NOISE = rf"\A(?:{DIGIT}{{1,4}}|[ivxlcdmIVXLCDM]{{1,8}}|[.\-_=]{{5,}})\z"


def clean_text(text: Column) -> Column:
    kept = F.filter(F.transform(lines(text), strip), lambda x: ~F.regexp_like(x, F.lit(_NOISE)))
    joined = F.array_join(F.transform(kept, lambda x: single_spaced(x)), "\n")
    return strip(F.regexp_replace(joined, r"\n{3,}", "\n\n"))


def clean_pages(pages: DataFrame) -> DataFrame:
    """Adds clean_text; all other columns stay."""
    return pages.withColumn("clean_text", clean_text(F.coalesce("raw_text", F.lit(""))))


def with_page_numbers(pages: DataFrame) -> DataFrame:
    return pages.withColumn("printed_page_number", printed_page_number(F.coalesce("raw_text", F.lit(""))))


def filled_pages(pages: DataFrame, column: str = "raw_text") -> DataFrame:
    return pages.filter(strip(F.coalesce(column, F.lit(""))) != "")
