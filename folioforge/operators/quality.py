"""Schema checks, the quality report and its warnings. Every check is an aggregate; only its result is one row.

The lists of a book's report are whole. For tables of any size `most` bounds them: each is then a count and its first entries, which every
task picks of its own rows before they meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_wins, shown

# Required fields, chunk types of questions, and the expected size of a full run.
CHAPTER_FIELDS = ("canonical_entities", "chapter_id", "chapter_number", "chapter_summary", "chapter_title", "entity_mentions", "kanda", "kanda_order",
                  "places", "printed_page_numbers", "questions", "sarga_range", "source_pdf_pages", "themes")
CHUNK_FIELDS = ("chunk_id", "metadata", "text")
METADATA_FIELDS = ("answer_type", "canonical_entities", "chapter_number", "chapter_title", "chunk_type", "document_title", "entity_mentions", "kanda",
                   "kanda_order", "language_original", "language_output", "pipeline_version", "places", "printed_page_numbers", "question_number",
                   "sarga_range", "source_file", "source_pdf_pages", "themes", "translation_model")
QA_TYPES = ("qa_multiple_choice", "qa_direct_answer", "qa_narrative", "qa_narrative_part")
EXPECTED_CHAPTERS, EXPECTED_QUESTIONS, QUESTIONS_EACH = 99, 495, 5
PIPELINE_VERSION = "1.0.0"


def missing_fields(json: Column, required: Sequence[str]) -> Column:
    """Required keys that a JSON object lacks, sorted. A key whose value is null is present."""
    return F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.coalesce(F.json_object_keys(json), F.array().cast("array<string>"))))


def _starts_with(json: Column, sign: str) -> Column:
    return F.startswith(F.ltrim(json), F.lit(sign))


def chapter_errors(json: Column) -> Column:
    questions = F.get_json_object(json, "$.questions")
    has = F.array_contains(F.json_object_keys(json), "questions")
    bad = has & ~F.coalesce(_starts_with(questions, "["), F.lit(False))
    return F.concat(missing_fields(json, CHAPTER_FIELDS), F.when(bad, F.array(F.lit("questions must be a list"))).otherwise(F.array().cast("array<string>")))


def chunk_errors(json: Column) -> Column:
    """struct(root_missing, metadata_missing)"""
    root = missing_fields(json, CHUNK_FIELDS)
    metadata = F.get_json_object(json, "$.metadata")
    own = F.when(F.coalesce(_starts_with(metadata, "{"), F.lit(False)), missing_fields(metadata, METADATA_FIELDS))
    own = own.when(~F.array_contains(root, "metadata"), F.array(F.lit("metadata must be an object"))).otherwise(F.array().cast("array<string>"))
    return F.struct(root.alias("root_missing"), own.alias("metadata_missing"))


def is_qa(chunk_type: Column) -> Column:
    return F.coalesce(chunk_type.isin(*QA_TYPES), F.lit(False))


def _list(rows: Column, when: Column | None = None) -> Column:
    """Ordered list of struct(order, value) rows, values only."""
    own = F.when(when, rows) if when is not None else rows
    return F.transform(F.array_sort(F.collect_list(own)), lambda x: x["value"])


def _map(order: Column, key: Column, value: Column, when: Column | None = None) -> Column:
    """Map of the rows' keys to values in order; the last value of a key counts."""
    rows = _list(F.struct(order.alias("order"), F.struct(key.alias("key"), value.alias("value")).alias("value")), when)
    return F.map_from_entries(F.reverse(first_wins(F.reverse(rows), lambda e: e["key"])))


def _lists(df: DataFrame, order: Column, lists: dict[str, tuple[Column, Column]], most: int | None, maps: dict[str, tuple[Column, Column, Column]] | None = None) -> DataFrame:
    """One row of lists of values where a condition holds, and of maps of keys to values, in order; with most, the first of each and NAME_count."""
    item = lambda v: F.struct(order.alias("order"), v.alias("value"))
    maps = maps or {}
    if most is None:
        return df.agg(*[_list(item(v), when).alias(n) for n, (v, when) in lists.items()], *[_map(order, k, v, when).alias(n) for n, (k, v, when) in maps.items()])
    out = df.agg(*[F.count_if(x[-1]).alias(f"{n}_count") for n, x in {**lists, **maps}.items()])
    for n, x in {**lists, **maps}.items():
        first = df.filter(x[-1]).orderBy(order).limit(most)
        out = out.crossJoin(first.agg((_list(item(x[0])) if len(x) == 2 else _map(order, x[0], x[1])).alias(n)))  # one row each
    return out


def _n(c: str) -> Column:
    return F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))


def _order(df: DataFrame, *others: str) -> Column:
    """A record's place: its index in the file it was read from, else these columns."""
    return F.struct("index") if "index" in df.columns else F.struct(*others)


def _json(df: DataFrame, columns: Sequence[str]) -> Column:
    """A record as it was written, if it was read with its JSON, else its columns, of which none is missing."""
    return F.col("json") if "json" in df.columns else F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def parsing_counts(chapters: DataFrame) -> DataFrame:
    """One row of numbers, for chapters of any number of books."""
    numbers = F.array_size(F.array_except(F.sequence(F.lit(1), F.lit(EXPECTED_CHAPTERS)), F.collect_set(F.when(F.col("chapter_number").between(1, EXPECTED_CHAPTERS), F.col("chapter_number")))))
    return chapters.agg(
        F.count("*").alias("detected_chapters"), F.coalesce(F.sum(_n("questions")), F.lit(0)).alias("detected_questions"),
        numbers.cast("long").alias("missing_chapters"), F.count_if(_n("questions") != QUESTIONS_EACH).alias("count_issues"),
        F.count_if(_n("unmapped_entity_candidates") > 0).alias("chapters_with_candidates"))


def parsing_report(chapters: DataFrame, most: int | None = None) -> DataFrame:
    found = chapters.agg(
        F.lit(EXPECTED_CHAPTERS).alias("expected_chapters"), F.count("*").alias("detected_chapters"), F.lit(EXPECTED_QUESTIONS).alias("expected_questions"),
        F.coalesce(F.sum(_n("questions")), F.lit(0)).alias("detected_questions"),
        F.array_except(F.sequence(F.lit(1), F.lit(EXPECTED_CHAPTERS)), F.collect_set(F.when(F.col("chapter_number").between(1, EXPECTED_CHAPTERS), F.col("chapter_number")))).alias("missing_chapters"))
    issue = F.struct("chapter_number", _n("questions").alias("question_count"), "parser_warnings")
    return found.crossJoin(_lists(chapters, _order(chapters, "chapter_number"), {"chapters_with_question_count_issues": (issue, _n("questions") != QUESTIONS_EACH)}, most))  # one row each


def translation_report(chapters: DataFrame, audit: DataFrame, most: int | None = None) -> DataFrame:
    """Of chapters read with their JSON, keys that a record lacks are found; rows without it lack none."""
    own = chapters.withColumn("__errors", chapter_errors(_json(chapters, chapters.columns)))
    found = _lists(own, _order(chapters, "chapter_number"), {
        "chapters_missing_required_fields": (F.struct("chapter_number", "chapter_id", F.col("__errors").alias("missing_or_invalid_fields")), F.size("__errors") > 0),
        "chapters_missing_questions": (F.col("chapter_number"), _n("questions") == 0),
    }, most, {"question_count_by_chapter": (shown(F.col("chapter_number")), _n("questions"), F.lit(True))})
    failed = _lists(audit, F.struct("chapter_number"), {"failed_chapters": (F.struct("chapter_number", "chapter_id", "error"), F.col("status") == "failed")}, most)
    names = [n + c for n in ("failed_chapters", "chapters_missing_required_fields", "chapters_missing_questions", "question_count_by_chapter") for c in (("", "_count") if most else ("",))]
    return own.agg(F.count("*").alias("translated_chapters")).crossJoin(failed).crossJoin(found).select("translated_chapters", *names)  # one row each


def _without(text: Column, *labels: str) -> Column:
    found = F.lit(False)
    for label in labels:
        found = found | F.contains(F.coalesce(text, F.lit("")), F.lit(label))
    return ~found


ANSWER_LABELS = ("Answer:", "Answer part:", "Correct answer:")


def chunk_counts(chunks: DataFrame) -> DataFrame:
    """One row of numbers, for chunks of any number of books."""
    errors = chunk_errors(_json(chunks, ["chunk_id", "text", "metadata"]))
    own = chunks.withColumns({"__gaps": F.size(errors["root_missing"]) + F.size(errors["metadata_missing"]), "__qa": is_qa(F.col("metadata.chunk_type"))})
    return own.agg(
        F.count("*").alias("total_chunks"), F.count_if(F.col("__gaps") > 0).alias("incomplete_chunks"),
        F.count_if(F.col("__qa") & _without(F.col("text"), "Question ")).alias("without_question"), F.count_if(F.col("__qa") & _without(F.col("text"), *ANSWER_LABELS)).alias("without_answer"),
        F.count_if(_n("metadata.canonical_entities") > 0).alias("chunks_with_canonical_entities"), F.count_if(_n("metadata.canonical_entities") <= 0).alias("chunks_without_entities"))


def chunk_report(chunks: DataFrame, jsonl_lines: int, most: int | None = None) -> DataFrame:
    """Of chunks read with their index and JSON, missing keys are found, and chunks without an id are named by their index."""
    order = _order(chunks, *(["chapter_number", "chunk_no"] if {"chapter_number", "chunk_no"} <= set(chunks.columns) else ["chunk_id"]))
    index = F.col("index") if "index" in chunks.columns else F.lit(None).cast("long")
    own = chunks.withColumn("__e", chunk_errors(_json(chunks, ["chunk_id", "text", "metadata"])))
    qa = is_qa(F.col("metadata.chunk_type"))
    named = F.coalesce(F.nullif("chunk_id", F.lit("")), F.concat(F.lit("index_"), shown(index)))
    found = own.agg(F.count("*").alias("total_chunks")).crossJoin(_lists(own, order, {
        "empty_chunk_ids": (F.struct(index.alias("index"), "chunk_id"), F.coalesce("chunk_id", F.lit("")) == ""),
        "chunks_missing_required_metadata": (F.struct("chunk_id", "__e.root_missing", "__e.metadata_missing"), (F.size("__e.root_missing") > 0) | (F.size("__e.metadata_missing") > 0)),
        "chunks_missing_question_text": (named, qa & _without(F.col("text"), "Question ")),
        "chunks_missing_answer_text": (named, qa & _without(F.col("text"), *ANSWER_LABELS)),
    }, most))  # one row each
    kinds = own.filter("metadata IS NOT NULL").groupBy(F.coalesce("metadata.chunk_type", F.lit("unknown")).alias("key")).agg(F.count("*").alias("value"), F.min(order).alias("order"))
    kinds = kinds.agg(F.map_from_entries(_list(F.struct("order", F.struct("key", "value").alias("value")))).alias("chunk_counts_by_type"))
    both = found.crossJoin(kinds).withColumns({
        "json_jsonl_count_match": F.col("total_chunks") == jsonl_lines, "json_chunk_count": F.col("total_chunks"), "jsonl_line_count": F.lit(jsonl_lines).cast("long")})
    lists = [c for c in found.columns if c != "total_chunks"]
    return both.select("total_chunks", "chunk_counts_by_type", *lists, "json_jsonl_count_match", "json_chunk_count", "jsonl_line_count")


def entity_report(chapters: DataFrame, chunks: DataFrame, most: int | None = None) -> DataFrame:
    has = _n("metadata.canonical_entities") > 0
    order = _order(chunks, *(["chapter_number", "chunk_no"] if {"chapter_number", "chunk_no"} <= set(chunks.columns) else ["chunk_id"]))
    found = chunks.agg(F.count_if(has).alias("chunks_with_canonical_entities"), F.coalesce(F.sum(_n("metadata.entity_mentions")), F.lit(0)).alias("total_entity_mentions"))
    without = _lists(chunks, order, {"chunks_with_missing_canonical_entities": (F.col("chunk_id"), ~has)}, most)
    open_ = _lists(chapters, _order(chapters, "chapter_number"), {}, most, {
        "unmapped_entity_candidates": (shown(F.col("chapter_number")), F.col("unmapped_entity_candidates"), _n("unmapped_entity_candidates") > 0)})
    both = found.crossJoin(without).crossJoin(open_)  # one row each
    return both.select("chunks_with_canonical_entities", *without.columns, "total_entity_mentions", *open_.columns)


def translation_model(chunks: DataFrame, default: str) -> DataFrame:
    """The first chunk's model that isn't empty, else the default."""
    order = _order(chunks, *(["chapter_number", "chunk_no"] if {"chapter_number", "chunk_no"} <= set(chunks.columns) else ["chunk_id"]))
    own = F.nullif("metadata.translation_model", F.lit(""))
    return chunks.agg(F.coalesce(F.min_by(own, F.when(own.isNotNull(), order)), F.lit(default)).alias("translation_model"))


def warnings(report: DataFrame) -> DataFrame:
    """Adds warnings to a report row, in a fixed order; their wording is a fixed value of reports."""
    p, t, c, o = (F.col(n) for n in ("parsing", "translation", "chunking", "output_file_checks"))
    text = lambda x: x.cast("string")
    kinds = {n: report.schema[n].dataType.fieldNames() for n in ("translation", "chunking", "entity_normalization")}
    amount = lambda part, n: F.col(part)[f"{n}_count"] if f"{n}_count" in kinds[part] else F.size(F.col(part)[n])
    some = lambda part, n: amount(part, n) > 0
    rules = [
        F.when(p["detected_chapters"] != p["expected_chapters"], F.concat(F.lit("Parsed chapter count is "), text(p["detected_chapters"]), F.lit(" of expected "), text(p["expected_chapters"]), F.lit("."))),
        F.when(p["detected_questions"] != p["expected_questions"], F.concat(F.lit("Parsed question count is "), text(p["detected_questions"]), F.lit(" of expected "), text(p["expected_questions"]), F.lit("."))),
        F.when(t["translated_chapters"] != p["expected_chapters"], F.concat(F.lit("Only "), text(t["translated_chapters"]), F.lit(" translated/normalized chapters are present; this is acceptable for the current sample run."))),
        F.when(some("translation", "failed_chapters"), F.concat(F.lit("Translation failures detected: "), text(amount("translation", "failed_chapters")), F.lit("."))),
        F.when(some("chunking", "chunks_missing_required_metadata"), F.lit("Some chunks are missing required metadata.")),
        F.when(some("chunking", "chunks_missing_question_text"), F.lit("Some QA chunks are missing question text.")),
        F.when(some("chunking", "chunks_missing_answer_text"), F.lit("Some QA chunks are missing answer text.")),
        F.when(~c["json_jsonl_count_match"], F.lit("final_chunks.json and final_chunks.jsonl counts do not match.")),
        F.when(some("entity_normalization", "chunks_with_missing_canonical_entities"), F.lit("Some chunks have no canonical entities in metadata.")),
        *[F.when(~o[k], F.lit(f"Missing output file: {k}.")) for k in ("final_chunks_json_exists", "final_chunks_jsonl_exists", "chapter_index_csv_exists")],
    ]
    return report.withColumn("warnings", F.filter(F.array(*rules), lambda w: w.isNotNull()))


def quality_report(source_chapters: DataFrame, chapters: DataFrame, chunks: DataFrame, audit: DataFrame, *, jsonl_lines: int, index_rows: int,
                   files: dict[str, bool], default_model: str, most: int | None = None) -> DataFrame:
    """One row of structs. files: existence of final_chunks_json, final_chunks_jsonl and chapter_index_csv. most: entries of a list, all if not given."""
    one = lambda df, name: df.select(F.struct("*").alias(name))
    checks = F.struct(*[F.lit(files.get(k, False)).alias(f"{k}_exists") for k in ("final_chunks_json", "final_chunks_jsonl", "chapter_index_csv")], F.lit(index_rows).cast("long").alias("chapter_index_rows"))
    row = translation_model(chunks, default_model).select(F.lit(PIPELINE_VERSION).alias("pipeline_version"), "translation_model")
    for df, name in ((parsing_report(source_chapters, most), "parsing"), (translation_report(chapters, audit, most), "translation"),
                     (chunk_report(chunks, jsonl_lines, most), "chunking"), (entity_report(chapters, chunks, most), "entity_normalization")):
        row = row.crossJoin(one(df, name))  # aggregates of one row each
    return warnings(row.withColumn("output_file_checks", checks))


def missing_numbers(rows: DataFrame, number: str, first: int, last: int) -> DataFrame:
    """Numbers of a range that no row has."""
    wanted = rows.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias(number))
    return wanted.join(rows.select(F.col(number).cast("int").alias(number)), number, "left_anti")


