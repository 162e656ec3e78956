import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioforge.functions import text as T

WORDS = re.compile(r"\b[\w'-]+\b")
CHARS = st.sampled_from(list("ab1_'-.!? \n\t\x1céకా \xa0"))


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def rows(spark, texts, f):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["x"] for r in df.select("i", f(F.col("t")).alias("x")).orderBy("i").collect()]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(CHARS, max_size=30), min_size=1, max_size=30))
def test_words_strip_and_sentences_match_python(spark, texts):
    assert rows(spark, texts, T.count_words) == [len(WORDS.findall(t)) for t in texts]
    assert rows(spark, texts, T.strip) == [t.strip() for t in texts]
    want = [[p.strip() for p in re.split(r"(?<=[.!?])\s+", t.strip()) if p.strip()] for t in texts]
    assert rows(spark, texts, T.sentences) == want
    assert rows(spark, texts, T.filled_lines) == [[x.strip() for x in t.splitlines() if x.strip()] for t in texts]


def packed(text, limit):
    """Greedy packing, written anew for the test."""
    parts, room = [], []
    count = lambda s: len(WORDS.findall(s))
    for s in [p.strip() for p in re.split(r"(?<=[.!?])\s+", text.strip()) if p.strip()]:
        n = count(s)
        if room and sum(map(count, room)) + n > limit:
            parts.append(" ".join(room))
            room = []
        if n > limit:
            w = s.split()
            parts += [" ".join(w[i:i + limit]) for i in range(0, len(w), limit)]
        else:
            room.append(s)
    return parts + ([" ".join(room)] if room else [])


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from(list("ab. !-")), max_size=80), min_size=1, max_size=20), st.integers(1, 6))
def test_packing_matches_python(spark, texts, limit):
    assert rows(spark, texts, lambda c: T.pack_sentences(c, limit)) == [packed(t, limit) for t in texts]


def test_nulls_and_rendering(spark):
    assert one(spark, T.count_words(F.lit(None).cast("string"))) == 0
    assert one(spark, T.shown(F.lit(None))) == "None"
    assert one(spark, T.listed(F.array().cast("array<string>"), "Places")) == "Places: None listed"
    assert one(spark, T.listed(F.array(F.lit("a"), F.lit("b")))) == "a, b"
    assert one(spark, T.or_else(F.lit(""), F.lit(None).cast("string"), F.lit("z"))) == "z"
    assert one(spark, T.python_list(F.array(F.lit(1), F.lit(2)))) == "[1, 2]"
    assert one(spark, T.json_list(F.array(F.lit('a"b'), F.lit("é")))) == '["a\\"b", "é"]'
    assert one(spark, T.first_wins(F.array(*map(F.lit, ["B", "a", "b", "A"])), F.lower)) == ["B", "a"]
    assert one(spark, T.lines(F.lit("a\r\nb\x0bc d"))) == ["a", "b", "c", "d"]
