import json
import sys

import pytest
from pyspark import cloudpickle

from folioforge import schemas
from folioforge.operators.entities import alias_rows
from folioforge.operators.translate import ModelSettings, TranslationError, ask_json, contract_error, select_chapters, unfenced, unfenced_column
from folioforge.plans import pipeline as P
from small_book import BOOK_PAGES
from folioforge.sources import readers, writers
from folioforge.streaming.incremental import keep_latest, stream_pages

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import tests

ALIASES = alias_rows({"entities": {"Valmiki": {"category": "sage", "aliases": ["Valmiki"]}, "Ayodhya": {"category": "place", "aliases": ["Ayodhya"]}}})


def reply(system, user):
    c = json.loads(user.split("Chapter:\n", 1)[1])
    return "```json\n" + json.dumps({
        "chapter_number": c["chapter_number"], "chapter_id": c["chapter_id"], "kanda": c["kanda_english"], "kanda_order": c["kanda_order"], "sarga_range": c["sarga_range"], "chapter_title": f"Title {c['chapter_number']}",
        "chapter_summary": "Valmiki in Ayodhya.", "canonical_entities": [], "places": [], "themes": [], "translation_notes": [], "source_pdf_pages": c["source_pdf_pages"], "printed_page_numbers": c["printed_page_numbers"],
        "questions": [{"question_number": q["question_number"], "question": "Who?", "answer_type": q["answer_type"], "options": [{"label": o["label"], "text": "x"} for o in q["options_telugu"]], "correct_answer": None, "answer": "Valmiki", "key_entities": []} for q in c["questions"]],
    }) + "\n```"


def make_model():
    return reply


def broken():
    def ask(system, user):
        raise OSError("no network")
    return ask


@pytest.fixture()
def book(spark, tmp_path):
    ws = P.Workspace(f"file://{tmp_path}")
    pages = spark.createDataFrame([(*p, "given") for p in BOOK_PAGES], schemas.PAGE)
    writers.write_json_array(P.parse_book(pages), ws.path("chapters_telugu.json"), ["chapter_number"], end="")
    return ws


def test_whole_run(spark, book, tmp_path):
    text = P.run_book(spark, book, ALIASES, make_model)
    out = tmp_path / "processed"
    array = json.loads((out / "final_chunks.json").read_text())
    lines = [json.loads(x) for x in (out / "final_chunks.jsonl").read_text().splitlines()]
    assert array == lines and len(array) == 2 + 5 + 2 and array[0]["chunk_id"] == "ramayana_bala_001_summary" and array[0]["metadata"]["question_number"] is None
    report = json.loads((out / "validation_report.json").read_text())
    assert report["chunking"]["chunk_counts_by_type"] == {"chapter_summary": 2, "qa_multiple_choice": 3, "qa_direct_answer": 1, "qa_narrative": 3} and report["translation"]["question_count_by_chapter"] == {"1": 5, "2": 2}
    audit = json.loads((tmp_path / "entity_normalization_audit.json").read_text())
    assert audit["chapter_count"] == 2 and [c["chapter_number"] for c in audit["chapters"]] == [1, 2] and audit["total_entity_mentions"] == sum(c["entity_mentions"] for c in audit["chapters"])
    assert report["chunking"]["json_jsonl_count_match"] and report["output_file_checks"]["chapter_index_rows"] == 2 and report["parsing"]["detected_questions"] == 7
    assert (out / "chapter_index.csv").read_text().splitlines()[0].startswith("chapter_number,chapter_id") and "﻿" not in text
    assert (out / "final_chunks_preview.md").read_text() == text and "- Key entities: Valmiki" in text and "- Places: Ayodhya" in text
    audit = [json.loads(x) for x in (tmp_path / "translation_audit.jsonl").read_text().splitlines()]
    assert [(a["chapter_number"], a["status"], a["attempts"]) for a in audit] == [(1, "translated", 1), (2, "translated", 1)]
    # A second run is served from the cache, without any model; force asks again.
    again = P.translate_file(spark, book, broken, [2, 1, 2])
    assert [(r.chapter_number, r.status, r.attempts) for r in again.orderBy("request_no").collect()] == [(2, "cached", 0), (1, "cached", 0)]
    with pytest.raises(TranslationError, match="chapters 1, 2"):
        P.translate_file(spark, book, broken, force=True, max_retries=1)
    assert json.loads((tmp_path / "chapters_english.json").read_text()) == []
    bad = spark.createDataFrame([("{}", 1)], "translated string, chapter_number int")
    writers.write_cache(bad, book.path("translated_chapters"))
    with pytest.raises(TranslationError, match="chapters 1"):
        P.translate_file(spark, book, make_model)
    audit = [json.loads(x) for x in (tmp_path / "translation_audit.jsonl").read_text().splitlines()]
    assert audit[0]["error"].startswith("Cached translation is invalid: Translated chapter missing fields") and audit[1]["status"] == "cached"
    with pytest.raises(ValueError, match="not found"):
        select_chapters(readers.read_json_array(spark, book.path("chapters_telugu.json"), schemas.SOURCE_CHAPTER), [1, 77])


def test_report_of_files_as_written(spark, tmp_path, monkeypatch):
    """Keys that records lack, chunks without an id, a chapter that comes twice, and a model from the environment."""
    ws = P.Workspace(f"file://{tmp_path}")
    (tmp_path / "processed").mkdir()
    whole = {k: [] for k in ("canonical_entities", "entity_mentions", "places", "themes", "printed_page_numbers", "source_pdf_pages")} | {"chapter_id": "a", "chapter_summary": None, "chapter_title": "t", "kanda": "k", "kanda_order": 1, "sarga_range": None}
    chapters = [whole | {"chapter_number": 2, "questions": []}, whole | {"chapter_number": 1, "questions": [{"question_number": 1}], "unmapped_entity_candidates": ["X"]}, {"chapter_number": 2, "questions": {}}]
    (tmp_path / "chapters_english_normalized.json").write_text(json.dumps(chapters))
    chunks = [{"chunk_id": "", "text": "Question 1: a Answer: b", "metadata": {"chunk_type": "qa_narrative"}}, {"text": None, "metadata": {"chunk_type": "qa_narrative", "translation_model": ""}}, {"chunk_id": "c", "text": "", "metadata": 7}]
    (tmp_path / "processed" / "final_chunks.json").write_text("\n" + json.dumps(chunks, indent=1))
    monkeypatch.setenv("SOME_MODEL", "own")
    P.report_file(spark, ws, model_variable="SOME_MODEL")
    r = json.loads((tmp_path / "processed" / "validation_report.json").read_text())
    assert list(r) == ["pipeline_version", "translation_model", "parsing", "translation", "chunking", "entity_normalization", "output_file_checks", "warnings"] and r["translation_model"] == "own"
    assert r["parsing"]["detected_chapters"] == 0 and r["translation"]["question_count_by_chapter"] == {"2": 0, "1": 1} and r["entity_normalization"]["unmapped_entity_candidates"] == {"1": ["X"]}
    bad = r["translation"]["chapters_missing_required_fields"]
    assert len(bad) == 1 and bad[0]["chapter_number"] == 2 and bad[0]["missing_or_invalid_fields"][0] == "canonical_entities" and bad[0]["missing_or_invalid_fields"][-1] == "questions must be a list"
    c = r["chunking"]
    assert c["empty_chunk_ids"] == [{"index": 0, "chunk_id": ""}, {"index": 1, "chunk_id": None}] and c["chunks_missing_question_text"] == c["chunks_missing_answer_text"] == ["index_1"]
    assert c["chunk_counts_by_type"] == {"qa_narrative": 2} and [x["root_missing"] for x in c["chunks_missing_required_metadata"]] == [[], ["chunk_id"], []]
    assert c["chunks_missing_required_metadata"][2]["metadata_missing"] == ["metadata must be an object"] and not c["json_jsonl_count_match"]
    text = P.preview_file(spark, ws)
    assert "- qa_narrative: 2" in text and "- Translation model: own" in text and P.preview_file(spark, ws, refresh=True) == text.replace("model: own", "model: deepseek-chat")


def test_pdf_pages_by_a_given_reader(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"12\none\x00two")
    rows = readers.read_pdf_pages(spark, f"file://{tmp_path}/a.pdf", lambda data: data.decode().split("\x00")).orderBy("pdf_page_index").collect()
    assert [tuple(r) for r in rows] == [(0, "12", "12\none", "pymupdf"), (1, None, "two", "pymupdf")]


def test_toc_view(spark):
    entries = spark.createDataFrame([(i,) for i in range(1, 26)], "chapter_number int")
    ends = {r.chapter_number: r.end for r in P.toc_view(entries).collect()}
    assert len(ends) == 20 and ends[10] == "head" and ends[16] == "tail" and 12 not in ends


def test_looks_at_stages(spark, book):
    chapters = readers.read_json_array(spark, book.path("chapters_telugu.json"), schemas.SOURCE_CHAPTER)
    assert {r.answer_type: r.n for r in P.answer_types(chapters).collect()} == {"multiple_choice": 3, "direct_answer": 1, "narrative": 3}
    assert P.missing_chapters(chapters).count() == 97 and [r[0] for r in P.needing_review(chapters).orderBy("chapter_number").collect()] == [1, 2]
    assert P.inspect_chapter(chapters, 2, 3).first().tail == "end"
    with pytest.raises(ValueError, match="not found"):
        P.inspect_chapter(chapters, 50)
    pages = P.clean_pages(spark.createDataFrame([(*p, "given") for p in BOOK_PAGES], schemas.PAGE))
    assert tuple(P.page_counts(pages).first()) == (11, 10) and P.page_preview(pages).count() == 2
    assert P.first_page_with(pages, "ప్రశ్న").first().pdf_page_index == 7


def test_retries_wait_and_give_up():
    waits, replies = [], iter(["nothing", "[]", '{"a": 1}'])
    assert ask_json(lambda s, u: next(replies), "", "", 3, waits.append) == ({"a": 1}, 3) and waits == [1, 2]
    waits.clear()
    with pytest.raises(TranslationError, match="after 2 attempts"):
        ask_json(lambda s, u: "x", "", "", 2, waits.append)
    assert waits == [1]


def test_fences(spark):
    texts = ["```json\n{}\n```", " ``` a ``` ", "a ``` b", "\n x "]
    assert [unfenced(t) for t in texts] == ["{}", "a", "a ``` b", "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r.x for r in df.orderBy("i").select(unfenced_column(df.t).alias("x")).collect()] == ["{}", "a", "a ``` b", "x"]


def test_contract(spark):
    good = json.loads(unfenced(reply("", "Chapter:\n" + json.dumps({"chapter_number": 1, "chapter_id": "x", "kanda_english": "k", "kanda_order": 1, "sarga_range": None, "source_pdf_pages": [], "printed_page_numbers": [], "questions": [{"question_number": 1, "answer_type": "narrative", "options_telugu": []}]}))))
    cases = [
        (good, None), ([], "Translated chapter must be a JSON object."),
        ({k: v for k, v in good.items() if k not in ("themes", "kanda")}, "Translated chapter missing fields: ['kanda', 'themes']"),
        (good | {"questions": None}, "Translated chapter questions must be a list."), (good | {"places": None}, "Translated chapter field must be a list: places"),
        (good | {"questions": [good["questions"][0], 1]}, "Question 2 must be a JSON object."),
        (good | {"questions": [{"question": 1}]}, "Question 1 missing fields: ['answer', 'answer_type', 'correct_answer', 'key_entities', 'options', 'question_number']"),
        (good | {"questions": [good["questions"][0] | {"options": 0}]}, "Question 1 options must be a list."), (None, "Translated chapter must be a JSON object.")]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(cases)] + [(len(cases), "{")], "i int, j string")
    got = [r.e for r in df.orderBy("i").select(contract_error(df.j).alias("e")).collect()]
    assert got == [said for _, said in cases] + ["not JSON"]


def test_settings():
    env = {"M_API_KEY": "k", "M_BASE_URL": "http://h/", "M_MODEL": "m", "M_TEMPERATURE": "0.5", "M_MAX_RETRIES": "2", "M_TIMEOUT_SECONDS": "3"}
    assert ModelSettings.from_env("M", env).url == "http://h/chat/completions"
    for key, value, said in (("M_MODEL", "", "M_MODEL is missing"), ("M_TEMPERATURE", "x", "numeric"), ("M_MAX_RETRIES", "0", "at least 1"), ("M_TIMEOUT_SECONDS", "0", "greater than 0")):
        with pytest.raises(ValueError, match=said):
            ModelSettings.from_env("M", env | {key: value})


def test_readers(spark, tmp_path):
    base = f"file://{tmp_path}"
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\n  \n{"x": null}\n')
    assert [r.x for r in readers.read_jsonl(spark, f"{base}/a.jsonl", "x int").collect()] == [1, None]
    assert readers.count_jsonl_lines(spark, f"{base}/a.jsonl") == 2 and readers.count_jsonl_lines(spark, f"{base}/none") == 0
    assert readers.read_jsonl_or_empty(spark, f"{base}/none", "x int").count() == 0
    (tmp_path / "bad.jsonl").write_text('{"x": 1}\n{"x"\n')
    with pytest.raises(Exception, match="Malformed|MALFORMED"):
        readers.read_jsonl(spark, f"{base}/bad.jsonl", "x int").collect()
    (tmp_path / "o.json").write_text('{"x": 1}')
    with pytest.raises(ValueError, match="JSON array"):
        readers.read_json_array(spark, f"{base}/o.json", "x int")
    with pytest.raises(FileNotFoundError):
        readers.read_json_array(spark, f"{base}/none.json", "x int")
    assert readers.read_json(spark, f"{base}/o.json", "x int").first().x == 1 and readers.read_json(spark, f"{base}/none.json", "x int") is None
    (tmp_path / "c.csv").write_text('a,b\n1,"x ""y""\nz"\n,\n')
    assert [tuple(r) for r in readers.read_csv_rows(spark, f"{base}/c.csv").collect()] == [("1", 'x "y"\nz'), ("", "")]
    assert readers.read_csv_rows(spark, f"{base}/none.csv").count() == 0
    (tmp_path / "al.yaml").write_text("entities:\n  Rama:\n    category: primary\n    aliases: [Rama, Sri Rama]\n")
    assert [r[1] for r in readers.read_aliases(str(tmp_path / "al.yaml"))] == ["Sri Rama", "Rama"]
    with pytest.raises(FileNotFoundError):
        readers.read_pdf_pages(spark, f"{base}/none.pdf")


def test_stream_keeps_the_latest_page(spark, tmp_path):
    (tmp_path / "in").mkdir()
    page = lambda i, t, n: json.dumps({"pdf_page_index": i, "raw_text": t, "extraction_method": "given", "batch": n}) + "\n"
    for turn, text in enumerate([page(0, "12\na", 0) + page(1, "later", 1) + page(1, "b", 0), page(1, "13\nbb", 2), page(1, "old", 1)]):
        (tmp_path / "in" / f"{turn}.json").write_text(text)
        keep_latest(stream_pages(spark, f"file://{tmp_path}/in", schemas.PAGE + ", batch int"), f"file://{tmp_path}/out", f"file://{tmp_path}/cp", "pdf_page_index", "batch").awaitTermination()
    got = spark.read.parquet(f"file://{tmp_path}/out").orderBy("pdf_page_index").collect()
    assert [(r.pdf_page_index, r.printed_page_number, r.clean_text) for r in got] == [(0, "12", "a"), (1, "13", "bb")]


def test_commands(spark, book, tmp_path, capsys):
    """What the commands print, write and end with."""
    from folioforge.cli import main

    (tmp_path / "al.yaml").write_text("entities:\n  Valmiki:\n    category: sage\n    aliases: [Valmiki]\n")
    run = ["run", book.root, "--aliases", str(tmp_path / "al.yaml")]
    assert main([*run, "--chapters", "2"], spark, broken) == 1
    said = capsys.readouterr()
    assert "chapters 2" in said.err and "translation_audit.jsonl" in said.err and said.out == ""
    assert main(run, spark, make_model) == 0
    said = capsys.readouterr().out
    assert "translated: 2\nfrom the cache: 0" in said and "normalized chapters: 2" in said and "chunks: 9" in said and "'qa_narrative': 3" in said
    (tmp_path / "processed" / "validation_report.json").unlink()
    assert main(["preview", book.root], spark) == 0 and (tmp_path / "processed" / "validation_report.json").exists()
    assert "preview characters: " in capsys.readouterr().out
    assert main(["validate", book.root], spark) == 0
    assert "parsed chapters: 2\ntranslated chapters: 2\nchunks: 9\nwarnings: " in capsys.readouterr().out
    with pytest.raises(SystemExit) as e:
        main(["run", book.root], spark)
    assert e.value.code == 2
