"""Table of contents and chapter assembly.

`by` names columns that tell books apart: all windows and folds are per book, so a corpus of books runs in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import DIGIT, SPACE, filled_lines, let, lower_bound, or_else, strip

# The six sections with their chapter ranges, order, and id prefix; where content starts; the sarga word.
SECTIONS = (
    ("Bala Kanda", 1, 13, 1, "bala"),
    ("Ayodhya Kanda", 14, 32, 2, "ayodhya"),
    ("Aranya Kanda", 33, 46, 3, "aranya"),
    ("Kishkindha Kanda", 47, 58, 4, "kishkindha"),
    ("Sundara Kanda", 59, 73, 5, "sundara"),
    ("Yuddha Kanda", 74, 99, 6, "yuddha"),
)
CONTENT_START = 7
TOC_PAGES = 8
LOOK_AHEAD = 4
LAST_CHAPTER = 99
SARGA_WORD = "సర్గలు"
TELUGU_DIGITS = "౦౧౨౩౪౫౬౭౮౯"


def to_int(c: Column) -> Column:
    return F.translate(c, TELUGU_DIGITS, "0123456789").cast("int")


def toc_entries(pages: DataFrame, by: Sequence[str] = (), order: str = "pdf_page_index") -> DataFrame:
    """Entries of the first pages, first of each chapter number, with the page number found on the next lines."""
    place = Window.partitionBy(*by).orderBy(order)
    head = pages.withColumn("__page", F.row_number().over(place)).filter(F.col("__page") <= TOC_PAGES)
    text = or_else(F.col("raw_text"), F.col("clean_text") if "clean_text" in pages.columns else F.lit(""), F.lit(""))
    rows = head.select(*by, "__page", F.posexplode(filled_lines(text)).alias("__line", "line"))
    ahead = Window.partitionBy(*by).orderBy("__page", "__line")
    entry = rf"\A({DIGIT}{{1,3}})\.{SPACE}*(.+?){SPACE}*-{SPACE}*(.+?)\z"
    part = lambda k: F.regexp_extract("line", entry, k)
    number = F.when(F.regexp_like("line", F.lit(rf"\A{DIGIT}{{1,3}}\z")), F.col("line"))
    rows = rows.withColumn("printed_page_number", F.first(number, ignorenulls=True).over(ahead.rowsBetween(1, LOOK_AHEAD)))
    rows = rows.filter(F.regexp_like("line", F.lit(entry))).withColumn("chapter_number", to_int(part(1))).filter(F.col("chapter_number").between(1, LAST_CHAPTER))
    first = Window.partitionBy(*by, "chapter_number").orderBy("__page", "__line")
    rows = rows.withColumn("__n", F.row_number().over(first)).filter("__n = 1")
    return rows.select(*by, "chapter_number", strip(part(2)).alias("kanda_telugu"), strip(part(3)).alias("chapter_title_telugu"), "printed_page_number")


def section_table(spark) -> DataFrame:
    """The sections as a fixed dimension table of six rows."""
    return spark.createDataFrame(SECTIONS, "kanda_english string, first_chapter int, last_chapter int, kanda_order int, prefix string")


def with_section(rows: DataFrame, number: str = "chapter_number") -> DataFrame:
    """Adds kanda_english, kanda_order and chapter_id by a range join; a number in no section raises."""
    sections = F.broadcast(section_table(rows.sparkSession))
    inside = F.col(number).between(F.col("first_chapter"), F.col("last_chapter"))
    joined = rows.join(sections, inside, "left")
    outside = F.raise_error(F.concat(F.lit("Chapter number outside expected range: "), F.col(number).cast("string"))).cast("string")
    return (
        joined.withColumn("kanda_english", F.when(F.col("kanda_order").isNull(), outside).otherwise(F.col("kanda_english")))
        .withColumn("chapter_id", F.format_string("%s_%03d", "prefix", number))
        .drop("first_chapter", "last_chapter", "prefix")
    )


def sarga_range(text: Column) -> Column:
    """first-last number of the first line that is numbers and the sarga word."""
    line = F.get(F.filter(filled_lines(text), lambda x: F.regexp_like(x, F.lit(rf"\A(?:[\p{{Nd}},]|{SPACE})*{DIGIT}(?:[\p{{Nd}},]|{SPACE})*{SARGA_WORD}\z"))), 0)
    numbers = F.regexp_extract_all(line, F.lit(rf"({DIGIT}+)"), 1)
    return let(numbers, lambda n: F.concat(F.get(n, 0), F.lit("-"), F.try_element_at(n, F.lit(-1))))


def _starts(entries: Column, pages: Column, last: Column) -> Column:
    """Fold over a book's entries in chapter order: each start is searched from the start before it.

    pages are sorted by printed number, then place: an index that is searched by halving.
    """

    def found(printed: Column, least: Column) -> Column:
        before = lambda p: (p["printed"] < printed) | ((p["printed"] == printed) & (p["index"] < least))
        hit = let(F.get(pages, lower_bound(pages, before)), lambda p: F.when(p["printed"] == printed, p["index"]))
        return F.when(F.coalesce(printed, F.lit("")) != "", hit)

    def step(acc: Column, e: Column) -> Column:
        start = found(e["printed"], acc["at"])
        first = F.coalesce(start, acc["at"])
        end = F.coalesce(found(e["next_printed"], first) + 1, last + 1)
        row = F.struct(
            e["chapter_number"].alias("chapter_number"), first.alias("first"), F.greatest(end, F.when(end < first, first + 1).otherwise(end)).alias("end"),
            F.filter(F.array(
                F.when(start.isNull(), F.concat(F.lit("Could not map TOC printed page "), F.coalesce(e["printed"], F.lit("None")), F.lit(" to PDF page."))),
                F.when(end < first, F.concat(F.lit("Invalid page range: start="), first.cast("string"), F.lit(", end="), end.cast("string"), F.lit("."))),
            ), lambda w: w.isNotNull()).alias("warnings"),
        )
        return F.struct(first.alias("at"), F.concat(acc["rows"], F.array(row)).alias("rows"))

    none = F.array().cast("array<struct<chapter_number:int,first:int,end:int,warnings:array<string>>>")
    return F.aggregate(entries, F.struct(F.lit(CONTENT_START).alias("at"), none.alias("rows")), step, lambda acc: acc["rows"])


def build_chapters(pages: DataFrame, entries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Source chapters: page spans that share their boundary page, joined text, sarga range, warnings.

    A span that names a page which the book doesn't have raises.
    """
    by = list(by)
    key = by or [F.lit(1).alias("__book")]
    names = by or ["__book"]
    page = F.struct(F.coalesce(F.col("printed_page_number"), F.lit("None")).alias("printed"), F.col("pdf_page_index").cast("int").alias("index"))
    books = pages.groupBy(*key).agg(F.array_sort(F.collect_list(page)).alias("pages"), F.max("pdf_page_index").cast("int").alias("last"))
    order = Window.partitionBy(*(by or [F.lit(1)])).orderBy("chapter_number")
    listed = entries.withColumn("next_printed", F.lead("printed_page_number").over(order))
    toc = listed.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("chapter_number", F.col("printed_page_number").alias("printed"), "next_printed"))).alias("entries"))
    spans = toc.join(books, names).select(*names, F.explode(_starts(F.col("entries"), F.col("pages"), F.col("last"))).alias("s"))
    spans = spans.select(*names, "s.chapter_number", "s.first", "s.end", "s.warnings")
    wanted = spans.select(*names, "chapter_number", F.explode(F.sequence(F.col("first"), F.col("end") - 1)).alias("pdf_page_index"))
    text = or_else(F.col("clean_text") if "clean_text" in pages.columns else F.lit(None).cast("string"), F.col("raw_text"), F.lit(""))
    own = pages.select(*key, F.col("pdf_page_index").cast("int").alias("pdf_page_index"), text.alias("text"), "printed_page_number", F.lit(True).alias("there"))
    joined = wanted.join(own, [*names, "pdf_page_index"], "left").groupBy(*names, "chapter_number").agg(
        F.array_sort(F.collect_list(F.struct("pdf_page_index", "text", "printed_page_number"))).alias("p"), F.count("*").alias("want"), F.count("there").alias("have"))
    missing = F.raise_error(F.lit("a chapter spans a page that the book doesn't have")).cast("string")
    out = joined.join(spans, [*names, "chapter_number"]).join(entries, [*by, "chapter_number"])
    out = out.withColumn("raw_telugu_text", F.when(F.col("have") < F.col("want"), missing).otherwise(strip(F.array_join(F.transform("p", lambda x: x["text"]), "\n\n"))))
    out = with_section(out.withColumn("sarga_range", sarga_range(F.col("raw_telugu_text"))))
    no_sarga = F.when(F.col("sarga_range").isNull(), F.array(F.lit("Could not detect Sarga range."))).otherwise(F.array().cast("array<string>"))
    out = out.withColumn("parser_warnings", F.concat("warnings", no_sarga))
    return out.select(
        *by, "chapter_number", "chapter_id", "kanda_telugu", "kanda_english", "kanda_order", "sarga_range", "chapter_title_telugu",
        F.transform("p", lambda x: x["pdf_page_index"]).alias("source_pdf_pages"),
        F.filter(F.transform("p", lambda x: x["printed_page_number"]), lambda x: x.isNotNull()).alias("printed_page_numbers"),
        "raw_telugu_text", "parser_warnings", (F.size("parser_warnings") > 0).alias("needs_review"),
    )


