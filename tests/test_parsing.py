import pytest
from pyspark.sql import functions as F

from folioforge import schemas
from folioforge.operators.chapters import build_chapters, sarga_range, toc_entries, with_section
from folioforge.operators.pages import clean_text, printed_page_number
from folioforge.operators.questions import answer_keys, attach_questions, options, parse_questions


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


@pytest.mark.parametrize("text, want", [
    ("12\nabc", "12"), ("a\nb\nc\nd\ne\nf\n 007 \n", "007"), ("a\nb\nc\nd\ne\n5\nf\ng\nh\ni\nj", None), ("12345", None), ("", None), ("x\n\n\n9", "9"),
    ("a\nb\n3\nc\nd\ne\n4", "3"), ("౧౨\nx", "౧౨")])
def test_printed_page(spark, text, want):
    assert one(spark, printed_page_number(F.lit(text))) == want


@pytest.mark.parametrize("text, want", [
    ("a\n12\nb", "a\nb"), ("mild\nI\nok", "ok"), ("....\n.....\n-=-=-\nwhy", "....\nwhy"), ("a \t b\n\n\n\n\nk", "a b\n\nk"), ("\x0ca b\n", "a\nb"), ("xiv", ""), (" \n", "")])
def test_clean_text(spark, text, want):
    assert one(spark, clean_text(F.lit(text))) == want


def pages(spark, rows):
    return spark.createDataFrame([(i, n, t, "given") for i, n, t in rows], schemas.PAGE)


def test_toc_lookahead_dedupe_and_range(spark):
    text = "1. s - a - b\nx\ny\nz\n11\n2. s - c\nx\ny\nz\nw\n12\n1. s - later\n0. s - none\n100. s - none\n3. s-d\n4. s - e\n7"
    own = toc_entries(pages(spark, [(0, None, text)])).orderBy("chapter_number").collect()
    assert [(r.chapter_number, r.kanda_telugu, r.chapter_title_telugu, r.printed_page_number) for r in own] == [
        (1, "s", "a - b", "11"), (2, "s", "c", None), (3, "s", "d", "7"), (4, "s", "e", "7")]


def test_toc_reads_only_the_first_pages(spark):
    rows = [(i, None, "x") for i in range(8)] + [(8, None, "5. s - late")]
    assert toc_entries(pages(spark, rows)).count() == 0


def test_chapters_search_from_the_start_before(spark):
    rows = [(i, None, f"t{i}") for i in range(7)] + [(7, "1", "1, 2 సర్గలు\nA"), (8, "2", "B"), (9, "1", "C"), (10, "3", "D")]
    entries = spark.createDataFrame([(1, "k", "one", "1"), (2, "k", "two", "2"), (3, "k", "three", "9"), (4, "k", "four", "3")], schemas.TOC_ENTRY)
    own = {r.chapter_number: r for r in build_chapters(pages(spark, rows), entries).collect()}
    assert own[1].source_pdf_pages == [7, 8] and own[1].sarga_range == "1-2" and own[1].printed_page_numbers == ["1", "2"]
    assert own[1].raw_telugu_text == "1, 2 సర్గలు\nA\n\nB" and own[1].chapter_id == "bala_001" and not own[1].needs_review
    assert own[2].source_pdf_pages == [8, 9, 10]  # the next page number isn't found
    assert own[3].source_pdf_pages == [8, 9, 10] and own[3].parser_warnings == ["Could not map TOC printed page 9 to PDF page.", "Could not detect Sarga range."]
    assert own[4].source_pdf_pages == [10]


def test_chapter_over_a_gap_raises(spark):
    rows = [(7, "1", "A"), (9, "2", "B")]
    entries = spark.createDataFrame([(1, "k", "one", "1"), (2, "k", "two", "2")], schemas.TOC_ENTRY)
    with pytest.raises(Exception, match="doesn't have"):
        build_chapters(pages(spark, rows), entries).collect()


def test_section_bounds(spark):
    df = spark.createDataFrame([(n,) for n in (1, 13, 14, 99)], "chapter_number int")
    assert [r.chapter_id for r in with_section(df).orderBy("chapter_number").collect()] == ["bala_001", "bala_013", "ayodhya_014", "yuddha_099"]
    with pytest.raises(Exception, match="outside expected range: 100"):
        with_section(spark.createDataFrame([(100,)], "chapter_number int")).collect()


def test_sarga(spark):
    assert one(spark, sarga_range(F.lit("x\n 12, 13,14 సర్గలు \n"))) == "12-14"
    assert one(spark, sarga_range(F.lit("సర్గలు 3"))) is None


def test_options(spark):
    get = lambda t: [tuple(o) for o in one(spark, options(F.lit(t)))]
    assert get("1. a 2) b\n3. c 4. d 1. e") == [("1", "a"), ("2", "b"), ("3", "c"), ("4", "d"), ("1", "e")]
    assert get("1. only") == [] and get("2. a 1. b") == [] and get("11. a 22. b") == [] and get("1. 2. b 3. c") == []


def test_answer_keys(spark):
    own = [tuple(x) for x in one(spark, answer_keys(F.lit("జవాబులు: 1. 2. x y 2. z\n1. last 4."))) ]
    assert own == [(1, "2. x y"), (2, "z"), (1, "last")]


TEXT = "ముందు\nప్రశ్న: మొదటి?\nజవాబు: 1. అ 2. ఆ 3. ఇ 4. ఈ\n2వ ప్రశ్న రెండు?\n1) క 2) గ\n3. ప్రశ్న మూడు?\n4. పశ్న నాలుగు?\nజవాబు\n: కథ\n4. ప్రశ్న మళ్ళీ?\n5. ప్రశ్న\nజవాబు:\nజవాబులు 1. 2. ఆ 3. రాముడు"


def test_questions(spark):
    r = parse_questions(spark.createDataFrame([(TEXT,), ("",), ("ఏమీ లేదు",)], "raw_telugu_text string")).collect()
    q = {x.question_number: x for x in r[0].questions}
    assert list(q) == [1, 2, 3, 4, 5]
    assert (q[1].question_telugu, q[1].answer_type, len(q[1].options_telugu), q[1].answer_key_telugu, q[1].answer_telugu) == ("మొదటి?", "multiple_choice", 4, "2. ఆ", None)
    assert (q[2].question_telugu, q[2].answer_type, q[2].parser_warnings) == ("రెండు?", "multiple_choice", ["Expected 4 options, detected 2.", "Missing answer key."])
    assert (q[3].answer_type, q[3].answer_telugu) == ("direct_answer", "రాముడు")
    assert (q[4].question_telugu, q[4].answer_telugu) == ("నాలుగు?", "కథ")
    assert q[5].parser_warnings == ["Empty question text.", "Missing narrative answer."]
    assert r[0].question_warnings == ["Q2: Expected 4 options, detected 2.", "Q2: Missing answer key.", "Q5: Empty question text.", "Q5: Missing narrative answer."]
    assert r[1].questions == [] and r[2].question_warnings == ["No question starts detected."]


def test_attach_is_idempotent(spark):
    own = spark.createDataFrame([(1, "1. ప్రశ్న ఎవరు?\nజవాబు: అతడు", ["Could not detect Sarga range."], False)], "chapter_number int, raw_telugu_text string, parser_warnings array<string>, needs_review boolean")
    once = attach_questions(own)
    twice = attach_questions(once)
    want = ["Could not detect Sarga range.", "Expected 5 questions, detected 1.", "Missing question numbers: [2, 3, 4, 5]"]
    assert once.first().parser_warnings == want == twice.first().parser_warnings and twice.first().needs_review


def test_fallback_key_section(spark):
    text = "1. ప్రశ్న ఎ?\nజవాబు: 1. అ 2. ఆ\n3. ప్రశ్న ఓ?\nబాల కాండ 1వ అధ్యాయము\n1. 2. ఆ\n2. 1. క\n3. సీత"
    q = {x.question_number: x for x in parse_questions(spark.createDataFrame([(text,)], "raw_telugu_text string")).first().questions}
    assert q[1].answer_key_telugu == "2. ఆ" and q[3].answer_telugu == "సీత"


def test_page_index_of_a_long_book(spark):
    """A book of 100,000 pages whose printed numbers repeat: the same starts as a search through all pages gives."""
    n = 100_000
    printed = lambda i: str(i % 997) if i % 5 else None
    toc = [(k + 1, "k", "t", str((k * 131) % 997)) for k in range(99)]
    book = spark.range(n).select(F.col("id").cast("int").alias("pdf_page_index"), F.when(F.col("id") % 5 != 0, (F.col("id") % 997).cast("string")).alias("printed_page_number"), F.lit("x").alias("raw_text"), F.lit("g").alias("extraction_method"))
    got = {r.chapter_number: r.source_pdf_pages[0] for r in build_chapters(book, spark.createDataFrame(toc, schemas.TOC_ENTRY)).select("chapter_number", "source_pdf_pages").collect()}
    at, want = 7, {}
    for number, _, _, page in toc:
        at = next((i for i in range(at, n) if printed(i) == page), at)
        want[number] = at
    assert got == want


@pytest.mark.parametrize("text, first", [("ప్రశ్న: a?\n2. ప్రశ్న: b?", 1), ("x\nప్రశ్న : : a?\nప్రశ్న b\n 2 వ ) ప్రశ్న c", 1), ("1. ప్రశ్న a\nప్రశ్న b\n2. ప్రశ్న c", 1), ("2. ప్రశ్న a", 2), ("ప్రశ్న a\n3. ప్రశ్న b", 3)])
def test_promotion_and_unnumbered_markers(spark, text, first):
    q = parse_questions(spark.createDataFrame([(text,)], "raw_telugu_text string")).first().questions
    assert q[0].question_number == first
    if "ప్రశ్న b\n2" in text:  # an unnumbered marker after the first numbered one is text
        assert q[0].question_telugu == "a\nప్రశ్న b"
    if ": :" in text:
        assert q[0].question_telugu == "b"


def test_patterns_start_with_a_character(spark):
    """White space of all kinds, single spaces untouched, markers at the start, after white space, and after another marker."""
    from folioforge.functions.text import SPACE, SPACES, lines, single_spaced
    from folioforge.operators import questions

    every = [(i, chr(i)) for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000]
    got = spark.createDataFrame(every, "i int, c string").filter(F.regexp_like("c", F.lit(SPACE))).select("c").collect()
    assert sorted(r.c for r in got) == sorted(SPACES)
    odd = "a b  c\t d\u3000e \u00a0 f\u2028g\r\nh\x1ci\x85j"
    row = spark.createDataFrame([(odd,)], "t string").select(single_spaced(F.col("t")).alias("s"), lines(F.col("t")).alias("l")).first()
    assert row.s == "a b c d e f g h i j" and len(row.l) == 5
    assert not questions._TOKEN.startswith("(?:")
    text = "1. ప్రశ్న\n2 ప్రశ్న\n3వ) ప్రశ్న :x\n\n 4. ప్రశ్న: y\tz  w 11. no 1. a ౧1. b 2) c\nప్రశ్న q"
    got = spark.createDataFrame([(text,)], "raw_telugu_text string").select(questions._tokens(questions.normalized(F.col("raw_telugu_text"))).alias("t")).first().t
    assert [(t.number, t.text.strip()) for t in got] == [("1", ""), ("2", ""), ("3", "x"), ("4", "y z w 11. no 1. a ౧1. b 2) c"), ("", "q")]
    cut = spark.createDataFrame([("11. no 1. a ౧1. b 2) c",)], "t string").select(questions._marked(F.col("t")).alias("m")).first().m
    assert cut == ["11. no ", "1\x02a ౧1. b ", "2\x02c"]


@pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
def test_queries_make_texts_once(spark):
    from folioforge.plans import queries

    assert not [f for f in queries.toc_spans(spark, "/root/testdata/sf0.001").inputFiles() if "documents" in f]
    made = queries.question_markers(spark, "/root/testdata/sf0.001")._jdf.queryExecution().analyzed().toString()
    assert made.count("[^a-z ]+") == 1
