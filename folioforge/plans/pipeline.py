"""Stages wired to files: what a run of one book reads and writes, as lazy DataFrames until the sinks."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.chapters import build_chapters, toc_entries
from ..operators.chunks import BookProfile, build_chunks, chapter_index
from ..operators.entities import audit_document, normalize_chapters
from ..operators.pages import clean_pages, filled_pages
from ..operators.quality import missing_numbers, quality_report
from ..operators.questions import attach_questions
from ..operators.report import markdown, preview_sections
from ..operators.translate import Model, require_success, select_chapters, translate
from ..schemas import REPORT
from ..sources import readers, writers
from ..storage import stored


@dataclass(frozen=True)
class Workspace:
    """Folders of one book; any Hadoop path."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def parse_book(pages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pages to source chapters with questions."""
    own = clean_pages(pages)
    return attach_questions(build_chapters(own, toc_entries(own, by), by))


def normalize_file(spark: SparkSession, ws: Workspace, aliases: list[tuple]) -> DataFrame:
    chapters = readers.read_json_array(spark, ws.path("chapters_english.json"), schemas.TRANSLATED_CHAPTER)
    out = normalize_chapters(chapters, aliases).cache()
    writers.write_json_array(out, ws.path("chapters_english_normalized.json"), ["chapter_number"])
    writers.write_json_object(audit_document(out), ws.path("entity_normalization_audit.json"))
    return out


def chunk_file(spark: SparkSession, ws: Workspace, book: BookProfile | None = None) -> DataFrame:
    chapters = readers.read_json_array(spark, ws.path("chapters_english_normalized.json"), schemas.NORMALIZED_CHAPTER)
    chunks = build_chunks(chapters, book)
    writers.write_chunks(chunks, chapter_index(chapters, chunks), ws.path("processed"))
    return chunks


def report_file(spark: SparkSession, ws: Workspace, default_model: str = BookProfile.translation_model, model_variable: str | None = None) -> DataFrame:
    """Checks of all files as they are written; model_variable names the environment variable whose model counts before the default."""
    out = ws.path("processed")
    default_model = os.environ.get(model_variable, default_model) if model_variable else default_model
    files = {"final_chunks_json": f"{out}/final_chunks.json", "final_chunks_jsonl": f"{out}/final_chunks.jsonl", "chapter_index_csv": f"{out}/chapter_index.csv"}
    read = lambda name, s: readers.read_records(spark, ws.path(name), s)
    row = quality_report(
        read("chapters_telugu.json", schemas.SOURCE_CHAPTER), read("chapters_english_normalized.json", schemas.NORMALIZED_CHAPTER), read("processed/final_chunks.json", schemas.CHUNK),
        readers.read_jsonl_or_empty(spark, ws.path("translation_audit.jsonl"), schemas.AUDIT), jsonl_lines=readers.count_jsonl_lines(spark, files["final_chunks_jsonl"]),
        index_rows=readers.read_csv_rows(spark, files["chapter_index_csv"], schemas.INDEX_COLUMNS).count(), files={k: readers.exists(spark, p) for k, p in files.items()}, default_model=default_model).cache()
    writers.write_json_object(row, f"{out}/validation_report.json")
    return row


def preview_file(spark: SparkSession, ws: Workspace, report: DataFrame | None = None, refresh: bool = False) -> str:
    """The preview from the given report, else from the one on file; that is made anew if it is missing or is to be refreshed."""
    if report is None:
        path = ws.path("processed/validation_report.json")
        if refresh or not readers.exists(spark, path):
            report_file(spark, ws)
        report = readers.read_json(spark, path, REPORT)
    chapters = readers.read_records(spark, ws.path("chapters_english_normalized.json"), schemas.NORMALIZED_CHAPTER)
    text = markdown(preview_sections(chapters, report))
    writers.write_text(spark, ws.path("processed/final_chunks_preview.md"), [text])
    return text


def translate_file(spark: SparkSession, ws: Workspace, make_model: Callable[[], Model], numbers: Sequence[int] | None = None, force: bool = False, max_retries: int = 3,
                   at_once: int = 1, per_second: float | None = None, wave: int | None = None) -> DataFrame:
    """Translates, writes audit, cache and the successes, then raises if a chapter failed.

    Chapters are asked for in waves of so many (all at once if it isn't given), in order of request; what a wave has is in the cache
    before the next begins. A run that was broken off goes on where it was: what is in the cache is not asked for again.
    """
    chapters = readers.read_json_array(spark, ws.path("chapters_telugu.json"), schemas.SOURCE_CHAPTER)
    cache_path = ws.path("translated_chapters")
    cached = "chapter_number int, translated string"
    selected = stored(select_chapters(chapters, numbers), "selected")
    total = selected.count()
    waves = []
    for begin in range(0, max(total, 1), wave or max(total, 1)):
        cache = spark.read.schema(cached).parquet(cache_path) if readers.exists(spark, cache_path) else spark.createDataFrame([], cached)
        own = selected.filter(F.col("request_no").between(begin, begin + (wave or total) - 1))
        # Stored once: a lost executor must not ask the model again, nor find a cache that this run has changed.
        done = stored(translate(own, cache, make_model, max_retries=max_retries, force=force, cache_path=cache_path, at_once=at_once, per_second=per_second), "translated")
        fresh = done.filter("status = 'translated'").select("translated", "chapter_number")
        if not fresh.isEmpty():
            writers.write_cache(fresh, cache_path)
        waves.append(done)
    done = reduce(DataFrame.unionByName, waves)
    writers.write_jsonl_file(done, ws.path("translation_audit.jsonl"), ["request_no"], ["request_no", "translated"])
    good = done.filter("status <> 'failed'").select("request_no", F.from_json("translated", schemas.TRANSLATED_CHAPTER).alias("c")).select("request_no", "c.*")
    writers.write_json_array(good, ws.path("chapters_english.json"), ["request_no"], ["request_no"])
    require_success(done)
    return done


def run_book(spark: SparkSession, ws: Workspace, aliases: list[tuple], make_model: Callable[[], Model], numbers: Sequence[int] | None = None, force: bool = False) -> str:
    """Translate, normalize, chunk, report, preview."""
    translate_file(spark, ws, make_model, numbers, force)
    normalize_file(spark, ws, aliases)
    chunk_file(spark, ws)
    return preview_file(spark, ws, report_file(spark, ws))


# Looks at a book's stages, as the command line offers them.

def page_counts(pages: DataFrame) -> DataFrame:
    return pages.agg(F.count("*").alias("pages")).crossJoin(filled_pages(pages).agg(F.count("*").alias("filled_pages")))


def page_preview(pages: DataFrame, chars: int = 500, column: str = "raw_text") -> DataFrame:
    """First and last page, shortened."""
    ends = pages.agg(F.min("pdf_page_index").alias("a"), F.max("pdf_page_index").alias("b"))
    own = pages.join(F.broadcast(ends), (F.col("pdf_page_index") == F.col("a")) | (F.col("pdf_page_index") == F.col("b")))
    return own.select("pdf_page_index", F.substring(F.replace(F.trim(column), F.lit("\n"), F.lit(" ")), 1, chars).alias("preview"))


def toc_view(entries: DataFrame, n: int = 10) -> DataFrame:
    """First and last n entries, each with its end: head, tail or both. Each task keeps n of its own, however many there are."""
    ends = [entries.orderBy(order).limit(n).withColumn("end", F.lit(end)) for order, end in ((F.asc("chapter_number"), "head"), (F.desc("chapter_number"), "tail"))]
    both = F.when(F.count("*") > 1, F.lit("both")).otherwise(F.first("end"))
    return ends[0].unionByName(ends[1]).groupBy(*entries.columns).agg(both.alias("end"))


def first_page_with(pages: DataFrame, marker: str) -> DataFrame:
    return pages.filter(F.contains("clean_text", F.lit(marker))).orderBy("pdf_page_index").limit(1)


def missing_chapters(rows: DataFrame, last: int = 99) -> DataFrame:
    return missing_numbers(rows, "chapter_number", 1, last)


def needing_review(chapters: DataFrame) -> DataFrame:
    return chapters.filter("needs_review").select("chapter_number")


def answer_types(chapters: DataFrame) -> DataFrame:
    return chapters.select(F.explode("questions.answer_type").alias("answer_type")).groupBy("answer_type").agg(F.count("*").alias("n"))


def inspect_chapter(chapters: DataFrame, number: int, chars: int = 2500) -> DataFrame:
    """Head and tail of one chapter's text; an unknown number raises."""
    own = chapters.filter(F.col("chapter_number") == number)
    if own.isEmpty():
        raise ValueError(f"chapter not found: {number}")
    return own.select("chapter_number", "chapter_id", F.length("raw_telugu_text").alias("text_chars"), F.left("raw_telugu_text", F.lit(chars)).alias("head"), F.right("raw_telugu_text", F.lit(chars)).alias("tail"))


