"""The Markdown preview, as ordered lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import listed, or_else, shown

TITLE = "# Sri Ramayanamu - Prashnavali RAG Preview"
INTRO = ("This preview summarizes the currently processed English, entity-normalized sample chapters and their question-answer content for reviewer inspection.")


def _join(*lines: Column | str) -> Column:
    return F.concat_ws("\n", *[F.lit(x) if isinstance(x, str) else x for x in lines])


def question_preview(q: Column) -> Column:
    choices = F.transform(F.coalesce(q["options"], F.array().cast("array<struct<label:string,text:string>>")), lambda o: F.concat(F.lit("- "), shown(o["label"]), F.lit(". "), shown(o["text"])))
    told = F.when(q["answer_type"] == "multiple_choice", F.concat_ws("\n", F.lit("**Options:**"), choices, F.lit(""), F.concat(F.lit("**Correct answer:** "), or_else(q["correct_answer"], q["answer"], F.lit("")))))
    told = told.otherwise(F.concat(F.lit("**Answer:** "), or_else(q["answer"], q["correct_answer"], F.lit(""))))
    return _join(F.concat(F.lit("#### Q"), shown(q["question_number"])), "", F.concat(F.lit("**Question:** "), shown(q["question"])), "", told, "",
                 F.concat(F.lit("**Key entities:** "), listed(q["key_entities"])), "")


def chapter_preview() -> Column:
    c = F.col
    bullet = lambda label, v: F.concat(F.lit(f"- {label}: "), v)
    asked = F.array_sort(F.transform(c("questions"), lambda q: F.struct(q["question_number"].alias("n"), question_preview(q).alias("text"))))
    head = _join(
        F.concat(F.lit("### Chapter "), shown(c("chapter_number")), F.lit(": "), shown(c("chapter_title"))), "",
        bullet("Kanda", shown(c("kanda"))), bullet("Sarga range", shown(c("sarga_range"))), bullet("Source PDF pages", listed(c("source_pdf_pages"))),
        bullet("Printed page numbers", listed(c("printed_page_numbers"))), bullet("Key entities", listed(c("canonical_entities"))), bullet("Places", listed(c("places"))),
        "", F.concat(F.lit("**Summary:** "), shown(c("chapter_summary"))), "")
    return F.concat_ws("\n", head, F.transform(asked, lambda x: x["text"]))


def preview_sections(chapters: DataFrame, report: DataFrame) -> DataFrame:
    """(place, text): the head at -1 and every chapter at its number; joined in order by line ends they are the preview."""
    p, t, k, e = (F.col(n) for n in ("parsing", "translation", "chunking", "entity_normalization"))
    text = lambda x: x.cast("string")
    kinds = F.transform(F.array_sort(F.map_entries(k["chunk_counts_by_type"])), lambda x: F.concat(F.lit("- "), x["key"], F.lit(": "), text(x["value"])))
    kinds = F.when(F.size(kinds) > 0, kinds).otherwise(F.array(F.lit("- No chunk counts available.")))
    warned = F.when(F.size("warnings") > 0, F.concat(F.array(F.lit(""), F.lit("## Warnings"), F.lit("")), F.transform("warnings", lambda w: F.concat(F.lit("- "), w)))).otherwise(F.array().cast("array<string>"))
    head = _join(
        TITLE, "", "## Document Summary", "", INTRO, "", "## Validation Summary", "",
        F.concat(F.lit("- Pipeline version: "), F.col("pipeline_version")), F.concat(F.lit("- Translation model: "), F.col("translation_model")),
        F.concat(F.lit("- Parsed chapters: "), text(p["detected_chapters"]), F.lit(" / "), text(p["expected_chapters"])),
        F.concat(F.lit("- Parsed questions: "), text(p["detected_questions"]), F.lit(" / "), text(p["expected_questions"])),
        F.concat(F.lit("- Translated/normalized chapters: "), text(t["translated_chapters"])), F.concat(F.lit("- Total chunks: "), text(k["total_chunks"])),
        F.concat(F.lit("- Chunks with canonical entities: "), text(e["chunks_with_canonical_entities"])), "", "## Chunk Count Summary", "", kinds, warned, "", "## Processed Chapters", "")
    return report.select(F.lit(-1).alias("place"), head.alias("text")).unionByName(chapters.select(F.col("chapter_number").alias("place"), chapter_preview().alias("text")))


def markdown(sections: DataFrame) -> str:
    """The whole preview; its size is one book's, sections are streamed in order."""
    text = "\n".join(r["text"] for r in sections.orderBy("place").toLocalIterator())
    return text.rstrip() + "\n"
