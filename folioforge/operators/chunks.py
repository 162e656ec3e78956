"""Retrieval chunks: one summary per chapter, one or more per question, and the chapter index."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import count_words, json_list, listed, or_else, pack_sentences, shown, strip
from ..schemas import METADATA, OPTION

MAX_CHUNK_WORDS = 1100
LEAST_PART_WORDS = 100
PART_RESERVE = 30


@dataclass(frozen=True)
class BookProfile:
    """What every chunk says of its book. The defaults are fixed values of the published chunks."""

    id_prefix: str = "ramayana"
    document_title: str = "Sri Ramayanamu - Prashnavali"
    source_file: str = "ramayana.pdf"
    language_original: str = "Telugu"
    language_output: str = "English"
    pipeline_version: str = "1.0.0"
    translation_model: str = "deepseek-chat"


def section_slug(section: Column) -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(section, F.lit(""))), "[^a-z0-9]+", "_"), r"\A_+|_+\z", "")
    return F.coalesce(F.nullif(F.regexp_replace(slug, r"_kanda\z", ""), F.lit("")), F.lit("unknown"))


def answer_text(q: Column) -> Column:
    return strip(or_else(q["answer"], q["correct_answer"], F.lit("")))


def chunk_type(answer_type: Column) -> Column:
    return (F.when(answer_type == "multiple_choice", F.lit("qa_multiple_choice")).when(answer_type == "direct_answer", F.lit("qa_direct_answer")).otherwise(F.lit("qa_narrative")))


def _head() -> list[Column]:
    return [
        F.concat(F.lit("Kanda: "), shown(F.col("kanda"))),
        F.concat(F.lit("Chapter "), F.col("chapter_number").cast("string"), F.lit(": "), shown(F.col("chapter_title"))),
        F.concat(F.lit("Sarga range: "), shown(F.col("sarga_range"))),
    ]


def _filled(first: Column, other: Column) -> Column:
    return F.when(F.coalesce(F.size(first), F.lit(0)) > 0, first).otherwise(F.coalesce(other, F.array().cast("array<string>")))


def summary_text() -> Column:
    lines = [*_head(), listed(F.col("canonical_entities"), "Primary entities"), listed(F.col("places"), "Places"), listed(F.col("themes"), "Themes"),
             F.lit(""), F.concat(F.lit("Summary: "), shown(F.col("chapter_summary")))]
    return strip(F.concat_ws("\n", *lines))


def question_text(q: Column, answer: Column, label: str, part: Column | None = None) -> Column:
    """A question's chunk text; part is its 'Part i of n.' line."""
    choices = F.transform(F.coalesce(q["options"], F.array().cast(f"array<{OPTION}>")), lambda o: F.concat(shown(o["label"]), F.lit(". "), shown(o["text"])))
    told = F.when(q["answer_type"] == "multiple_choice", F.concat_ws("\n", F.lit("Options:"), choices, F.concat(F.lit("Correct answer: "), or_else(q["correct_answer"], answer))))
    told = told.otherwise(F.concat(F.lit(f"{label}: "), answer))
    lines = [*_head(), listed(_filled(q["key_entities"], F.col("canonical_entities")), "Primary entities"),
             F.concat(F.lit("Question "), q["question_number"].cast("string"), F.lit(": "), shown(q["question"]))]
    return strip(F.concat_ws("\n", *lines, *([part] if part is not None else []), told))


def _metadata(book: BookProfile, kind: Column, q: Column) -> Column:
    """A chunk's metadata; of a summary, whose question is null, what belongs to a question is the chapter's or null."""
    mentions = F.coalesce("entity_mentions", F.array().cast(_type("entity_mentions")))
    many = lambda c, t="array<string>": F.coalesce(c, F.array().cast(t)).alias(c)
    return F.struct(
        F.lit(book.document_title).alias("document_title"), F.lit(book.source_file).alias("source_file"),
        F.lit(book.language_original).alias("language_original"), F.lit(book.language_output).alias("language_output"),
        F.col("kanda"), F.col("kanda_order"), F.col("chapter_number"), F.col("chapter_title"), F.col("sarga_range"),
        q["question_number"].alias("question_number"), kind.alias("chunk_type"), q["answer_type"].alias("answer_type"),
        _filled(q["key_entities"], F.col("canonical_entities")).alias("canonical_entities"),
        F.when(F.coalesce(F.size(q["entity_mentions"]), F.lit(0)) > 0, q["entity_mentions"]).otherwise(mentions).alias("entity_mentions"),
        many("places"), many("themes"), many("source_pdf_pages", "array<int>"), many("printed_page_numbers"),
        F.lit(book.translation_model).alias("translation_model"), F.lit(book.pipeline_version).alias("pipeline_version"),
    ).cast(METADATA)


def _type(name: str) -> str:
    from ..schemas import MENTION

    return f"array<{MENTION}>" if name == "entity_mentions" else "array<string>"


def question_parts(q: Column) -> Column:
    """The parts of a narrative answer whose chunk would be too long; null for any other question."""
    long_ = (q["answer_type"] == "narrative") & (count_words(question_text(q, answer_text(q), "Answer")) > MAX_CHUNK_WORDS)
    head_words = count_words(question_text(q, F.lit(""), "Answer part"))
    limit = F.greatest(F.lit(LEAST_PART_WORDS), F.lit(MAX_CHUNK_WORDS - PART_RESERVE) - head_words)
    return F.when(long_, pack_sentences(answer_text(q), limit))


def build_chunks(chapters: DataFrame, book: BookProfile | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """(chapter_number, chunk_no, chunk_id, text, metadata): chunk_no orders the chunks of a chapter, from 0.

    Chapters are independent rows that are read once: each becomes its summary (a question that is null) and its questions, and
    these become their parts. Nothing shuffles.
    """
    book = book or BookProfile()
    base = F.concat(F.lit(f"{book.id_prefix}_"), section_slug(F.col("kanda")), F.lit("_"), F.format_string("%03d", F.col("chapter_number")))
    kind = chapters.schema["questions"].dataType
    asked = F.concat(F.array(F.lit(None).cast(kind.elementType)), F.coalesce("questions", F.array().cast(kind)))
    rows = chapters.select("*", F.posexplode(asked).alias("__no", "q")).withColumn("__parts", question_parts(F.col("q")))
    rows = rows.withColumn("__parts", F.when(F.size("__parts") == 0, F.array(answer_text(F.col("q")))).otherwise(F.col("__parts")))
    rows = rows.select("*", F.posexplode_outer("__parts").alias("__part", "answer_part"))
    q, part = F.col("q"), F.col("__part")
    summary, cut = F.col("__no") == 0, F.col("__part").isNotNull()
    qid = F.concat(base, F.lit("_q"), F.format_string("%03d", q["question_number"]))
    name = F.when(summary, F.concat(base, F.lit("_summary"))).when(cut, F.concat(qid, F.lit("_part"), F.format_string("%02d", part + 1))).otherwise(qid)
    line = F.concat(F.lit("Part "), (part + 1).cast("string"), F.lit(" of "), F.size("__parts").cast("string"), F.lit("."))
    text = F.when(summary, summary_text()).when(cut, question_text(q, F.col("answer_part"), "Answer part", line)).otherwise(question_text(q, answer_text(q), "Answer"))
    said = F.when(summary, F.lit("chapter_summary")).when(cut, F.lit("qa_narrative_part")).otherwise(chunk_type(q["answer_type"]))
    place = F.col("__no").cast("long") * 1_000_000 + F.coalesce(part, F.lit(0))
    return rows.select(*by, "chapter_number", place.alias("chunk_no"), name.alias("chunk_id"), text.alias("text"), _metadata(book, said, q).alias("metadata"))


def chapter_index(chapters: DataFrame, chunks: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One flat row per chapter; list cells are JSON."""
    own = chunks.groupBy(*by, "chapter_number").agg(F.array_sort(F.collect_list(F.struct("chunk_no", "chunk_id"))).alias("c"))
    joined = chapters.join(own, [*by, "chapter_number"], "left")
    ids = F.transform(F.coalesce("c", F.array().cast("array<struct<chunk_no:long,chunk_id:string>>")), lambda x: x["chunk_id"])
    numbers = F.concat(F.lit("["), F.array_join(F.coalesce("source_pdf_pages", F.array().cast("array<int>")).cast("array<string>"), ", "), F.lit("]"))
    return joined.select(
        *by, "chapter_number", "chapter_id", "kanda", "kanda_order", "chapter_title", "sarga_range", numbers.alias("source_pdf_pages"),
        json_list(F.coalesce("printed_page_numbers", F.array().cast("array<string>"))).alias("printed_page_numbers"),
        F.coalesce(F.size("questions"), F.lit(0)).alias("question_count"), F.size(ids).alias("chunk_count"), json_list(ids).alias("chunk_ids"))


def counts_by_type(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy(F.col("metadata.chunk_type").alias("chunk_type")).agg(F.count("*").alias("n"))
