"""The engine's operators applied to the driver's tables, over whole tables and whole texts."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schemas
from ..functions.text import count_words, let, pack_sentences, sentences
from ..operators.chapters import build_chapters, section_table, toc_entries, with_section
from ..operators.chunks import BookProfile, build_chunks, chapter_index, counts_by_type
from ..operators.entities import alias_rows, mention_finder, normalize_chapters, unmapped_candidates
from ..operators.pages import clean_pages, clean_text, printed_page_number
from ..operators.quality import chapter_errors, chunk_counts as counted_chunks, chunk_errors, missing_numbers, parsing_counts, parsing_report, quality_report, translation_report
from ..operators.questions import attach_questions, parse_questions
from ..operators.report import chapter_preview
from ..operators.translate import prompts, select_chapters, translate
from ..shipping import ship
from ..sources import readers, writers
from ..storage import shared_dir, spread, stored
from .pipeline import answer_types as answer_type_counts
from .pipeline import page_counts as counted_pages
from .pipeline import toc_view

Query = Callable[[SparkSession, str], DataFrame]
PART_WORDS = 1070
#: Chapter numbers of a request, with a repeat.
REQUEST = [9, 4, 9, 1]


def _read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_read(spark, sf_dir, "documents", "doc_id", "text"))


def word_count_by_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", count_words(F.col("text")).cast("long").alias("words"))


def size_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by size against the ideal and the largest chunk."""
    words = count_words(F.col("text"))
    kind = F.when(words < 350, "short").when(words <= 750, "ideal").when(words <= 1100, "long").otherwise("oversize")
    return _documents(spark, sf_dir).select(kind.alias("size_class")).groupBy("size_class").agg(F.count("*").alias("n"))


def sentences_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _documents(spark, sf_dir).select("doc_id", F.posexplode(sentences(F.col("text"))).alias("sentence_no", "sentence"))
    return own.select("doc_id", "sentence_no", "sentence", count_words(F.col("sentence")).cast("long").alias("words"))


def narrative_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed sentence by sentence into parts of at most PART_WORDS words."""
    own = _documents(spark, sf_dir).select("doc_id", F.posexplode(pack_sentences(F.col("text"), PART_WORDS)).alias("part_no", "part"))
    return own.select("doc_id", "part_no", F.md5(F.encode("part", "UTF-8")).alias("part_md5"), F.length("part").cast("long").alias("part_chars"))


def _page(doc_id: Column, text: Column) -> Column:
    """A document as a printed page: a number at one end, separators, roman numbers, ragged space."""
    number = (doc_id % 1200).cast("string")
    top = F.when(doc_id % 3 == 0, F.concat(F.lit(" "), number, F.lit("\n"))).otherwise(F.lit(""))
    foot = F.when(doc_id % 3 == 1, F.concat(F.lit("\n"), number, F.lit(" \n"))).otherwise(F.lit("\n"))
    return F.concat(top, F.lit("=====\n"), F.replace(text, F.lit(". "), F.lit(".  \n\n\n\n  ")), F.lit("\n\n\n-.-.-\nxiv\n...."), foot)


def clean_page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _documents(spark, sf_dir).select("doc_id", clean_text(_page(F.col("doc_id"), F.coalesce("text", F.lit("")))).alias("t"))
    return own.select("doc_id", F.md5(F.encode("t", "UTF-8")).alias("clean_md5"), F.length("t").cast("long").alias("clean_chars"))


def printed_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", printed_page_number(_page(F.col("doc_id"), F.coalesce("text", F.lit("")))).alias("printed_page_number"))


def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted_pages(_documents(spark, sf_dir).withColumnRenamed("text", "raw_text"))


def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn that follows."""
    turns = _read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    ahead = Window.partitionBy("conv_id").orderBy("turn")
    paired = turns.withColumns({"next_role": F.lead("role").over(ahead), "answer": F.lead("text").over(ahead)})
    return paired.filter("role = 'user' AND next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("question"), "answer")


def _chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in the shape of normalized chapters."""
    kind = F.expr("CASE (turn div 2) % 3 WHEN 0 THEN 'narrative' WHEN 1 THEN 'direct_answer' ELSE 'multiple_choice' END")
    pair = qa_pairs(spark, sf_dir).withColumn("answer_type", kind)
    options = F.when(F.col("answer_type") == "multiple_choice", F.array(
        F.struct(F.lit("1").alias("label"), F.left("answer", F.lit(20)).alias("text")), F.struct(F.lit("2").alias("label"), F.left("question", F.lit(20)).alias("text"))))
    none = F.array().cast("array<string>")
    question = F.struct(
        F.col("turn").cast("int").alias("question_number"), "question", "answer_type", F.coalesce(options, F.array().cast(f"array<{schemas.OPTION}>")).alias("options"),
        F.when(F.col("answer_type") == "multiple_choice", F.left("answer", F.lit(20))).alias("correct_answer"), "answer",
        F.when(F.col("turn") % 4 == 0, F.array(F.lit("user"), F.lit("assistant"))).otherwise(none).alias("key_entities"), F.array().cast(f"array<{schemas.MENTION}>").alias("entity_mentions"))
    asked = pair.groupBy("conv_id").agg(F.array_sort(F.collect_list(question)).alias("questions"))
    number = F.col("conv_id").cast("int")
    return asked.select(
        number.alias("chapter_number"), F.format_string("conv_%03d", "conv_id").alias("chapter_id"), F.concat(F.lit("Group "), (number % 6).cast("string"), F.lit(" Kanda")).alias("kanda"),
        (number % 6).alias("kanda_order"), F.when(number % 5 != 0, F.concat((number + 1).cast("string"), F.lit("-"), (number + 2).cast("string"))).alias("sarga_range"),
        F.concat(F.lit("Conversation "), number.cast("string")).alias("chapter_title"), F.when(number % 7 != 0, F.concat(F.lit("About "), number.cast("string"))).alias("chapter_summary"), "questions",
        F.when(number % 2 == 1, F.array(F.lit("assistant"))).otherwise(none).alias("canonical_entities"), F.when(number % 3 == 0, F.array(F.lit("Here"), F.lit("There"))).otherwise(none).alias("places"), none.alias("themes"),
        F.array(number, number + 1).alias("source_pdf_pages"), F.array(number.cast("string")).alias("printed_page_numbers"), F.array().cast(f"array<{schemas.MENTION}>").alias("entity_mentions"),
        F.when(number % 4 == 0, F.array(F.lit("Nobody"))).otherwise(none).alias("unmapped_entity_candidates"), none.alias("parser_warnings"))


_BOOK = BookProfile(id_prefix="chat")


def qa_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = build_chunks(_chapters(spark, sf_dir), _BOOK)
    return out.select("chunk_id", F.col("metadata.chunk_type").alias("chunk_type"), F.array_join("metadata.canonical_entities", ",").alias("entities"), F.md5(F.encode("text", "UTF-8")).alias("text_md5"), F.length("text").cast("long").alias("chars"))


def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_by_type(build_chunks(_chapters(spark, sf_dir), _BOOK))


def conversation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    chapters = _chapters(spark, sf_dir)
    return chapter_index(chapters, build_chunks(chapters, _BOOK))


def answer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answer_type_counts(_chapters(spark, sf_dir))


def chapter_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chapters(spark, sf_dir).select("chapter_number", F.md5(F.encode(chapter_preview(), "UTF-8")).alias("preview_md5"))


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: parsing, chunk and entity checks of the conversations' chapters."""
    chapters = _chapters(spark, sf_dir)
    return parsing_counts(chapters).crossJoin(counted_chunks(build_chunks(chapters, _BOOK)))  # one row each


def report_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warnings of the whole quality report, over conversations as chapters and labels as the audit of their translation."""
    chapters = _chapters(spark, sf_dir)
    labels = _read(spark, sf_dir, "labels", "doc_id", "quality")
    audit = labels.select(F.col("doc_id").cast("int").alias("chapter_number"), F.lit(None).cast("string").alias("chapter_id"), F.when(F.col("quality") == 0, "failed").otherwise("cached").alias("status"), F.lit("e").alias("error"))
    row = quality_report(chapters, chapters.filter("chapter_number % 2 = 0"), build_chunks(chapters, _BOOK), audit, jsonl_lines=1, index_rows=0, files={"final_chunks_json": True}, default_model="none", most=20)
    return row.select("translation_model", F.posexplode("warnings").alias("place", "warning"))


def report_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounded lists of parsing and translation reports: every document as a chapter, labels as the audit; counts and first entries."""
    d = F.col("doc_id")
    none = F.array().cast("array<string>")
    chapters = _documents(spark, sf_dir).select(
        d.cast("int").alias("chapter_number"), F.concat(F.lit("c"), d.cast("string")).alias("chapter_id"), F.array_repeat(F.left(F.coalesce("text", F.lit("")), F.lit(5)), (d % 7).cast("int")).alias("questions"),
        none.alias("parser_warnings"), *[F.lit(1).alias(c) for c in ("canonical_entities", "chapter_summary", "chapter_title", "entity_mentions", "kanda", "kanda_order", "places", "printed_page_numbers", "sarga_range", "source_pdf_pages")])
    labels = _read(spark, sf_dir, "labels", "doc_id", "quality")
    audit = labels.select(F.col("doc_id").cast("int").alias("chapter_number"), F.lit("c").alias("chapter_id"), F.when(F.col("quality") == 0, "failed").otherwise("cached").alias("status"), F.lit("e").alias("error"))
    parsed, told = parsing_report(chapters, 20), translation_report(chapters, audit, 20)
    shown = lambda c, at: F.array_join(F.transform(c, lambda x: (x["chapter_number"] if at else x).cast("string")), ",")
    return parsed.crossJoin(told).select(  # one row each
        "detected_chapters", "detected_questions", F.size("missing_chapters").alias("missing"), "chapters_with_question_count_issues_count", shown(F.col("chapters_with_question_count_issues"), True).alias("issues"),
        "translated_chapters", "failed_chapters_count", shown(F.col("failed_chapters"), True).alias("failed"), "chapters_missing_required_fields_count",
        F.array_join(F.transform("chapters_missing_required_fields", lambda x: F.array_join(x["missing_or_invalid_fields"], "+")), ",").alias("fields"),
        "chapters_missing_questions_count", shown(F.col("chapters_missing_questions"), False).alias("without_questions"), "question_count_by_chapter_count",
        F.array_join(F.transform(F.map_entries("question_count_by_chapter"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("counts"))


def requested_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters asked for by number, in the order of the request, repeats once."""
    return select_chapters(_source_chapters(spark, sf_dir), REQUEST).select("request_no", "chapter_number", "chapter_title_telugu")


def fallback_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer keys found after a section title, where no key header stands; each document's text is an answer before it."""
    s, t = F.trim(F.left("t", F.lit(30))), F.col("t")
    text = F.concat(F.lit("1. ప్రశ్న: a?\nజవాబు: 1. x 2. y\n2. ప్రశ్న: b?\n1) x 2) z\n3. ప్రశ్న: c?\n4. ప్రశ్న: d?\nజవాబు: so "), t, F.lit(".\nబాల కాండ 1వ అధ్యాయము\n1. 2. y "), s, F.lit(" q\n2. 1. x\n3. k "), s, F.lit(" k"))
    own = parse_questions(_letters(spark, sf_dir).select("doc_id", text.alias("raw_telugu_text"))).select("doc_id", F.explode_outer("questions").alias("q")).filter("q IS NOT NULL")
    return own.select("doc_id", "q.question_number", "q.answer_type", "q.answer_key_telugu", F.md5(F.encode("q.answer_telugu", "UTF-8")).alias("answer_md5"))


def qa_warnings_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings of chapters from which questions are missing, others in every document; texts without a word are unlabelled answers."""
    d, s = F.col("doc_id"), F.trim(F.left("t", F.lit(30)))
    asked = [F.when(d % (i + 1) != 0, F.concat(F.lit(f"\n{i}. ప్రశ్న: q{i}?\nజవాబు: "), F.when(d % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("so "), s)))).otherwise(F.lit("")) for i in range(1, 6)]
    chapters = _letters(spark, sf_dir).select("doc_id", F.concat(*asked).alias("raw_telugu_text"), F.array().cast("array<string>").alias("parser_warnings"), F.lit(False).alias("needs_review"))
    return attach_questions(chapters).select("doc_id", F.size("questions").alias("questions"), F.array_join("parser_warnings", " ").alias("warnings"), "needs_review")


def chapter_schema_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that each document, written as a chapter's JSON, lacks."""
    d, text = F.col("doc_id"), F.get(F.split(F.to_json(F.array(F.coalesce("text", F.lit("")))), "\\A\\["), 1)
    questions = F.when(d % 3 == 0, F.lit("null")).when(d % 3 == 1, F.lit("[]")).otherwise(F.lit('{"a":[]}'))
    body = F.concat(F.lit('{"chapter_title":'), F.left(text, F.length(text) - 1), F.when(d % 4 != 0, F.concat(F.lit(',"questions":'), questions)).otherwise(F.lit("")), F.when(d % 2 == 0, F.lit(',"places":null')).otherwise(F.lit("")), F.lit(',"kanda":1}'))
    e = chapter_errors(body)
    return _documents(spark, sf_dir).select("doc_id", F.array_join(e, ",").alias("gaps"))


#: Aliases that occur in conversations, one of them a place.
WORDS = {"entities": {"The": {"category": "sage", "aliases": ["the"]}, "And": {"category": "place", "aliases": ["and"]}, "Group": {"category": "deity", "aliases": ["conversation"]}}}


def entities_by_chapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as chapters, with their entities resolved."""
    chapters = _chapters(spark, sf_dir).withColumn("translation_notes", F.array(F.lit("The note"), F.lit(None).cast("string"), F.lit("nothing")))
    own = normalize_chapters(chapters, alias_rows(WORDS))
    names = lambda c: F.array_join(F.array_sort(c), ",")
    keys = F.flatten(F.transform("questions", lambda q: F.transform(q["key_entities"], lambda k: F.concat(q["question_number"].cast("string"), F.lit(":"), k))))
    return own.select(
        "chapter_number", names(F.col("canonical_entities")).alias("entities"), names(F.col("places")).alias("places"), names(keys).alias("keys"),
        F.size("entity_mentions").cast("long").alias("mentions"), F.size("note_entity_mentions").cast("long").alias("note_mentions"),
        F.aggregate(F.transform("questions", lambda q: F.size(q["entity_mentions"])), F.lit(0), lambda a, x: a + x).cast("long").alias("question_mentions"))


def long_narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as the narrative answer of a chapter's only question: split where the chunk would be too long."""
    none = F.array().cast("array<string>")
    question = F.struct(
        F.lit(1).alias("question_number"), F.lit("Tell it?").alias("question"), F.lit("narrative").alias("answer_type"), F.array().cast(f"array<{schemas.OPTION}>").alias("options"),
        F.lit(None).cast("string").alias("correct_answer"), F.col("text").alias("answer"), none.alias("key_entities"), F.array().cast(f"array<{schemas.MENTION}>").alias("entity_mentions"))
    chapters = _documents(spark, sf_dir).select(
        "doc_id", F.lit(7).alias("chapter_number"), F.lit("c").alias("chapter_id"), F.lit("Long Kanda").alias("kanda"), F.lit(1).alias("kanda_order"), F.lit(None).cast("string").alias("sarga_range"), F.lit("One").alias("chapter_title"),
        F.lit("s").alias("chapter_summary"), F.array(question).alias("questions"), none.alias("canonical_entities"), none.alias("places"), none.alias("themes"),
        F.array().cast("array<int>").alias("source_pdf_pages"), none.alias("printed_page_numbers"), F.array().cast(f"array<{schemas.MENTION}>").alias("entity_mentions"))
    out = build_chunks(chapters, _BOOK, ("doc_id",)).filter("metadata.chunk_type <> 'chapter_summary'")
    return out.select("doc_id", "chunk_id", F.col("metadata.chunk_type").alias("chunk_type"), F.md5(F.encode("text", "UTF-8")).alias("text_md5"))


def chunk_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each chunk says of its chapter and book."""
    join = lambda c: F.array_join(F.col(f"metadata.{c}").cast("array<string>"), ",").alias(c)
    out = build_chunks(_chapters(spark, sf_dir), _BOOK)
    same = ("document_title", "source_file", "language_original", "language_output", "kanda", "kanda_order", "chapter_number", "chapter_title", "sarga_range", "question_number", "answer_type", "translation_model", "pipeline_version")
    return out.select("chunk_id", *[F.col(f"metadata.{c}").alias(c) for c in same], *map(join, ("places", "themes", "source_pdf_pages", "printed_page_numbers")), F.size("metadata.entity_mentions").alias("entity_mentions"))


def sinks_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that one book's three sinks give when they are read again: by index, line and row."""
    folder = shared_dir(spark)
    chapters = _chapters(spark, sf_dir)
    chunks = build_chunks(chapters, _BOOK)
    writers.write_chunks(chunks, chapter_index(chapters, chunks), folder)
    writers.write_jsonl(chunks.select("chunk_id", "text", "metadata"), f"{folder}/lines")
    digest = lambda c: F.md5(F.encode(c, "UTF-8")).alias("digest")
    array = readers.read_records(spark, f"{folder}/final_chunks.json", schemas.CHUNK).select(F.lit("array").alias("sink"), F.concat(F.col("index").cast("string"), F.lit(" "), "chunk_id").alias("id"), digest("text"))
    lines = readers.read_jsonl(spark, f"{folder}/final_chunks.jsonl", schemas.CHUNK).select(F.lit("file").alias("sink"), F.col("chunk_id").alias("id"), digest("text"))
    parts = readers.read_jsonl(spark, f"{folder}/lines", schemas.CHUNK).select(F.lit("folder").alias("sink"), F.col("chunk_id").alias("id"), digest("text"))
    rows = readers.read_csv_rows(spark, f"{folder}/chapter_index.csv").select(F.lit("index").alias("sink"), F.col("chapter_id").alias("id"), digest(F.concat_ws("|", "kanda", "sarga_range", "question_count", "chunk_count")))
    count = readers.count_jsonl_lines(spark, f"{folder}/final_chunks.jsonl")
    return array.unionByName(lines).unionByName(parts).unionByName(rows).withColumn("lines", F.lit(count).cast("long"))


#: Overlapping phrases of the corpus, so that the longest-first claim matters.
PHRASES = {"entities": {
    "Of": {"category": "primary", "aliases": ["of"]}, "The": {"category": "sage", "aliases": ["the"]}, "OfThe": {"category": "place", "aliases": ["of the"]},
    "And": {"category": "deity", "aliases": ["and"]}, "AndThe": {"category": "supporting", "aliases": ["and the"]}, "InThe": {"category": "place", "aliases": ["in the"]}, "On": {"category": "vanara", "aliases": ["ón"]}}}
SINGLE = {"entities": {"The": {"category": "sage", "aliases": ["the"]}, "And": {"category": "deity", "aliases": ["and"]}}}


def _mentions(spark: SparkSession, sf_dir: str, config: dict) -> DataFrame:
    find = mention_finder(alias_rows(config))
    fields = F.transform(sentences(F.col("text")), lambda s, i: F.struct(F.concat(F.lit("s"), i.cast("string")).alias("field"), s.alias("text")))
    return ship(_documents(spark, sf_dir)).select("doc_id", F.explode(F.get(find(F.array(fields)), 0)).alias("m")).select("doc_id", "m.*")


def alias_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of overlapping phrases, sentence by sentence."""
    return _mentions(spark, sf_dir, PHRASES).groupBy("doc_id", "canonical", "category").agg(F.count("*").alias("n"))


def mention_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences that mention each of two single words, by document."""
    return _mentions(spark, sf_dir, SINGLE).groupBy("doc_id", "canonical").agg(F.countDistinct("field").alias("n"))


def unmapped_candidate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = F.array(F.coalesce("text", F.lit("")))
    own = _documents(spark, sf_dir).select("doc_id", F.posexplode(unmapped_candidates(texts, alias_rows(PHRASES))).alias("place", "candidate"))
    return own.select("doc_id", "place", "candidate")


def range_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select((F.col("p_partkey") % 99 + 1).cast("int").alias("chapter_number"))
    return with_section(part).groupBy("kanda_english", "kanda_order", "chapter_id").agg(F.count("*").alias("n"))


def missing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label."""
    return _read(spark, sf_dir, "documents", "doc_id").join(_read(spark, sf_dir, "labels", "doc_id"), "doc_id", "left_anti")


def missing_chapter_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _read(spark, sf_dir, "labels", "doc_id").select(F.col("doc_id").alias("chapter_number"))
    return missing_numbers(own, "chapter_number", 1, 99)


def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First turn of each role in a conversation."""
    turns = _read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return turns.groupBy("conv_id", "role").agg(F.min_by(F.struct("turn", "text"), "turn").alias("x")).select("conv_id", "role", "x.turn", "x.text")


def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last turn of each role in a conversation."""
    turns = _read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return turns.groupBy("conv_id", "role").agg(F.max_by(F.struct("turn", "text"), "turn").alias("x")).select("conv_id", "role", "x.turn", "x.text")


def chunk_schema_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that each document, written as a chunk's JSON, lacks."""
    d, text = F.col("doc_id"), F.get(F.split(F.to_json(F.array(F.coalesce("text", F.lit("")))), "\\A\\["), 1)
    body = F.concat(
        F.lit("{"), F.when(d % 3 != 0, F.lit('"chunk_id":"c",')).otherwise(F.lit("")), F.when(d % 5 != 0, F.concat(F.lit('"text":'), F.left(text, F.length(text) - 1), F.lit(","))).otherwise(F.lit("")),
        F.when(d % 7 == 0, F.lit('"metadata":[]}')).when(d % 2 == 0, F.lit('"metadata":{"kanda":1,"themes":[],"places":null}}')).otherwise(F.lit('"other":0}')))
    e = chunk_errors(body)
    return _documents(spark, sf_dir).select("doc_id", F.array_join(e["root_missing"], ",").alias("root_missing"), F.array_join(e["metadata_missing"], ",").alias("metadata_missing"))


def _source_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in the shape of parsed source chapters."""
    asked = F.transform("questions", lambda q: F.struct(
        q["question_number"].alias("question_number"), q["question"].alias("question_telugu"), q["answer_type"].alias("answer_type"), q["options"].alias("options_telugu"),
        q["correct_answer"].alias("answer_key_telugu"), q["answer"].alias("answer_telugu"), F.array().cast("array<string>").alias("parser_warnings")))
    said = F.array_join(F.transform("questions", lambda q: q["answer"]), "\n")
    return _chapters(spark, sf_dir).select(
        "chapter_number", "chapter_id", F.lit("k").alias("kanda_telugu"), F.col("kanda").alias("kanda_english"), "kanda_order", "sarga_range", F.col("chapter_title").alias("chapter_title_telugu"),
        "source_pdf_pages", "printed_page_numbers", asked.alias("questions"), said.alias("raw_telugu_text"), "parser_warnings", F.lit(False).alias("needs_review"))


def prompt_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the prompts hold of each chapter, read back from their JSON."""
    payload = F.substring_index("user_prompt", "\nChapter:\n", -1)
    own = prompts(_source_chapters(spark, sf_dir)).select(payload.alias("p"))
    get = lambda k: F.get_json_object("p", f"$.{k}")
    return own.select(get("chapter_number").cast("int").alias("chapter_number"), F.array_join(F.array_sort(F.json_object_keys("p")), ",").alias("keys"), get("sarga_range").alias("sarga_range"),
                      F.md5(F.encode(get("raw_telugu_text"), "UTF-8")).alias("text_md5"), F.json_array_length(get("questions")).alias("questions"))


def replayed() -> Callable[[str, str], str]:
    """A model without a network: by its number a chapter is translated, needs a second attempt, or gets no usable reply."""
    tried: set[int] = set()

    def ask(system: str, user: str) -> str:
        c = json.loads(user.split("Chapter:\n", 1)[1])
        n = c["chapter_number"]
        if n % 7 == 3 and n not in tried:
            tried.add(n)
            raise OSError("no connection")
        if n % 7 == 4:
            return "sorry"
        out = {k: [] for k in ("canonical_entities", "places", "themes", "translation_notes")} | {
            "chapter_id": c["chapter_id"], "chapter_number": n, "chapter_summary": "s", "chapter_title": "t", "kanda": c["kanda_english"], "kanda_order": c["kanda_order"], "sarga_range": None,
            "questions": [{"answer": q["answer_telugu"], "answer_type": q["answer_type"], "correct_answer": None, "key_entities": [], "options": None if n % 7 == 5 else [], "question": "q", "question_number": q["question_number"]} for q in c["questions"]]}
        text = json.dumps(out, ensure_ascii=False)
        return f"```json\n{text}\n```" if n % 7 == 6 else text

    return ask


def _at_once(seconds: float) -> None:
    """No wait between the attempts of a replay."""


def translate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as chapters through the translation, by a replayed model; every fifth is in the cache, every fifth wrongly."""
    chapters = _source_chapters(spark, sf_dir)
    none = F.array().cast("array<string>")
    whole = F.to_json(F.struct(
        "chapter_id", "chapter_number", F.lit("s").alias("chapter_summary"), F.lit("t").alias("chapter_title"), F.lit("k").alias("kanda"), "kanda_order", "sarga_range", F.array().cast("array<int>").alias("questions"),
        *[none.alias(k) for k in ("canonical_entities", "places", "themes", "translation_notes")]), {"ignoreNullFields": "false"})
    cache = chapters.filter("chapter_number % 5 < 2").select("chapter_number", F.when(F.col("chapter_number") % 5 == 0, whole).otherwise(F.lit("{}")).alias("translated"))
    done = translate(select_chapters(chapters, None), cache, replayed, sleep=_at_once)
    return done.select("request_no", "chapter_number", "status", "attempts", "error_type", "error", F.json_array_length(F.get_json_object("translated", "$.questions")).alias("questions"))


def _letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' letters, with single spaces."""
    t = F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]+", " ")
    return _documents(spark, sf_dir).select("doc_id", F.trim(t).alias("t"))


def _books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a book: a contents page, six pages in front, and its text on pages 7 to 9 of 11.

    Of some books the second chapter's page number is on no page, or the third has none.
    """
    d, k = F.col("doc_id"), F.floor(F.length("t") / 3).cast("int")
    contents = F.concat(F.lit("Contents\n1. A - T"), d.cast("string"), F.lit("\n3\n2. B - U - V\nsee\n4\n3. C - W\n"), F.when(d % 5 == 0, F.lit("a\nb\nc\nd\n")).otherwise(F.lit("5\n")), F.lit("100. Z - far\n7\n2. dup - x\n9"))
    sarga = F.when(d % 3 == 0, F.lit("12, 14 సర్గలు\n")).otherwise(F.lit(""))
    texts = [contents, *[F.lit("front")] * 6, F.substring("t", F.lit(1), k), F.substring("t", k + 1, k), F.concat(sarga, F.substring("t", 2 * k + 1, F.length("t"))), F.lit("end of it")]
    printed = {7: F.lit("3"), 8: F.when(d % 4 != 0, F.lit("4")), 9: F.lit("5"), 10: F.lit("6")}
    pages = F.array(*[F.struct(F.lit(i).alias("pdf_page_index"), printed.get(i, F.lit(None)).cast("string").alias("printed_page_number"), t.alias("raw_text")) for i, t in enumerate(texts)])
    return _letters(spark, sf_dir).select("doc_id", F.explode(pages).alias("p")).select("doc_id", "p.*")


def toc_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters of every document's book: contents, page spans, texts, warnings."""
    # Pages are used three times, entries twice: both are made once.
    pages = stored(clean_pages(_books(spark, sf_dir)), "pages")
    entries = stored(toc_entries(pages, ["doc_id"]), "entries")
    own = build_chapters(pages, entries, ["doc_id"]).join(entries.select("doc_id", "chapter_number", F.col("printed_page_number").alias("toc_page")), ["doc_id", "chapter_number"])
    return own.select(
        "doc_id", "chapter_number", "chapter_id", "kanda_telugu", "kanda_english", "chapter_title_telugu", "toc_page", "sarga_range", F.array_join(F.col("source_pdf_pages").cast("array<string>"), ",").alias("pages"),
        F.array_join("printed_page_numbers", ",").alias("printed"), F.md5(F.encode("raw_telugu_text", "UTF-8")).alias("text_md5"), F.array_join("parser_warnings", " ").alias("warnings"), "needs_review")


def toc_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last entries of a long table of contents, made of all parts' numbers."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").cast("int").alias("chapter_number"))
    return toc_view(part)


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a chapter's text with five questions: without a number, without a label, direct, told, empty; and a key section."""
    s, t = F.trim(F.left("t", F.lit(30))), F.col("t")
    text = F.concat(
        F.lit("front line\nప్రశ్న: x "), s, F.lit(" one?\nజవాబు: 1. x "), s, F.lit(" 2. b 3. c 4. d\n2. ప్రశ్న: two?\n1) x "), s, F.lit(" 2) no\n3. ప్రశ్న : three "), s,
        F.lit(" x?\n4వ ప్రశ్న\nfour?\nజవాబు\n: so "), t, F.lit(".\n5. పశ్న: five?\nజవాబు: \nజవాబులు:\n1. 2. b 2. 1. x "), s, F.lit(" 3. old 3. key "), s, F.lit(" x"))
    return _letters(spark, sf_dir).select("doc_id", text.alias("raw_telugu_text"), F.array(F.lit("Q9: old"), F.lit("Missing question numbers: [4]"), F.lit("kept")).alias("parser_warnings"), F.lit(False).alias("needs_review"))


def qa_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions of every document's chapter."""
    own = parse_questions(_asked(spark, sf_dir)).select("doc_id", F.explode_outer("questions").alias("q")).filter("q IS NOT NULL")
    options = F.array_join(F.transform("q.options_telugu", lambda o: F.concat(o["label"], F.lit("="), o["text"])), ";")
    return own.select("doc_id", "q.question_number", "q.question_telugu", "q.answer_type", options.alias("options"), "q.answer_key_telugu", F.md5(F.encode("q.answer_telugu", "UTF-8")).alias("answer_md5"), F.array_join("q.parser_warnings", " ").alias("warnings"))


def qa_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings after questions are attached to chapters that had warnings of an earlier parse."""
    return attach_questions(_asked(spark, sf_dir)).select("doc_id", F.size("questions").alias("questions"), F.array_join("parser_warnings", " ").alias("warnings"), "needs_review")


def question_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's text as the answers of five marked questions, parsed back."""
    t = F.regexp_replace(F.coalesce("text", F.lit("")), r"[^a-z ]+", " ")
    body = let(t, lambda x: F.concat(*[F.concat(F.lit(f"\n{i}. ప్రశ్న: q{i}?\nజవాబు: "), x) for i in range(1, 6)]))
    own = parse_questions(_documents(spark, sf_dir).select("doc_id", body.alias("raw_telugu_text")))
    return own.select("doc_id", F.explode_outer("questions").alias("q")).filter("q IS NOT NULL").select("doc_id", "q.question_number", "q.question_telugu", "q.answer_type", F.length("q.answer_telugu").cast("long").alias("answer_chars"))


def section_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sections that documents fall into, numbered as chapters, with their bounds and documents."""
    docs = with_section(_documents(spark, sf_dir).select((F.col("doc_id") % 99 + 1).cast("int").alias("chapter_number")))
    counts = docs.groupBy("kanda_order").agg(F.count("*").alias("documents"))
    return section_table(spark).join(counts, "kanda_order")


def queries() -> dict[str, Query]:
    own = [
        word_count_by_doc, size_class, sentences_exploded, narrative_parts, clean_page_lines, printed_page, page_counts, qa_pairs, qa_chunks, chunk_counts, conversation_index,
        answer_types, chapter_previews, quality_summary, alias_mentions, mention_counts, unmapped_candidate_rows, range_bucket, missing_labels, missing_chapter_numbers, first_wins,
        last_wins, chunk_schema_gaps, chapter_schema_gaps, report_warnings, entities_by_chapter, long_narratives, chunk_metadata, sinks_read_back, prompt_payload, translate_audit, toc_spans,
        toc_ends, qa_parse, qa_warnings, question_markers, section_dimension, report_heads, requested_chapters, fallback_keys, qa_warnings_by_row]
    return {f.__name__: f for f in own}
