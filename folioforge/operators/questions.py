"""Question and answer parsing of chapter texts, all in array functions: no explode, no shuffle, no Python.

One scan of a text finds all question markers, numbered or not, as tokens with their text; a split at the tokens' signs gives
the pieces. Promotion, the first marker, the key section and the blocks are then decided on the list of tokens. Patterns
run only over texts that hold a character which every match needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACE, filled_lines, first_wins, let, python_list, strip

# The marker words of questions, answers and answer keys, and the grammar of markers, options and keys.
QUESTION_WORDS = "(?:ప్రశ్న|పశ్న)"
ANSWER_WORD = "జవాబు"
KEY_WORD = "జవాబులు"
SECTION_WORD = "అధ్యాయము"
EXPECTED_QUESTIONS = 5

_S = f"{SPACE}*"
_LINE = r"(?:\A|(?<=\n)|\n)"
_QUESTION = rf"{_LINE}{_S}([1-5]){_S}వ?{_S}[.)]?{_S}{QUESTION_WORDS}{_S}:?"
# Begins with a plain character, so that a scan rejects all others at once. It ends before white space without a colon, so the line end of a
# next token is there; a text is given one in front.
_TOKEN = rf"\n{_S}(?:([1-5]){_S}వ?{_S}[.)]?{_S}{QUESTION_WORDS}(?:{_S}:)?|{QUESTION_WORDS})"
_OPTION = rf"([1-4])(?<!\p{{Nd}}[1-4]){_S}[.)]{_S}"
_FALLBACK = rf"\n{_S}[^\n]*{SECTION_WORD}{_S}\n{_S}1{_S}\.{_S}[1-4]{_S}\..*?2{_S}\.{_S}[1-4]{_S}\..*?3{_S}\."
_KEY = rf"(?s)([1-5]){_S}\.{_S}(?:([1-4]){_S}\.{_S})?(.*?)(?=(?:{SPACE}+[1-5]{_S}\.)|\z)"
#: Signs around tokens: a token's start, the end of its number or label, the end of its text.
_AT, _END, _TEXT = "\x01", "\x02", "\x03"
_OPTIONS = "array<struct<label:string,text:string>>"


def _only(c: Column, needs: tuple[str, ...], change: Callable[[Column], Column]) -> Column:
    """c changed if it holds one of the strings without which no match is possible."""
    some = F.lit(False)
    for n in needs:
        some = some | F.contains(c, F.lit(n))
    return F.when(some, change(c)).otherwise(c)


def normalized(c: Column) -> Column:
    for needs, pattern, new in (("\r",), r"\r\n?", "\n"), (("\t",), "\t", " "), (("  ",), " {2,}", " "), ((":",), rf"\n{_S}:{_S}", ": "), (("\n\n\n",), r"\n{3,}", "\n\n"):
        c = let(c, lambda x: _only(x, needs, lambda y: F.regexp_replace(y, pattern, new)))  # noqa: B023
    return strip(c)


def _tokens(c: Column) -> Column:
    """array<struct<number, marker, text>> of a text's question markers and what follows each; the number of some is empty."""
    pieces = F.split(F.regexp_replace(F.concat(F.lit("\n"), c), _TOKEN, f"{_AT}$1{_END}$0{_TEXT}"), _AT)
    after = lambda p, sign: p.substr(F.instr(p, sign) + 1, F.length(p))
    own = lambda p: let(after(p, _END), lambda rest: F.struct(F.substring_index(p, _END, 1).alias("number"), F.substring_index(rest, _TEXT, 1).alias("marker"), after(rest, _TEXT).alias("text")))
    return F.transform(F.slice(pieces, 2, F.size(pieces)), own)


def _from_first(tokens: Column) -> Column:
    """Tokens from the first numbered one on. If that is 2, an unnumbered one before it becomes number 1. Null if none has a number."""
    at = F.array_position(F.transform(tokens, lambda t: t["number"] != ""), True).cast("int")
    first = lambda t: F.struct(F.lit("1").alias("number"), t["marker"].alias("marker"), F.regexp_replace(t["text"], rf"\A{_S}:?{_S}:?", "").alias("text"))

    def use(k: Column) -> Column:
        promoted = (k > 1) & (F.get(tokens, k - 1)["number"] == "2")
        rest = F.slice(tokens, k, F.size(tokens))
        return F.when(k > 0, F.when(promoted, F.concat(F.array(first(F.get(tokens, k - 2))), rest)).otherwise(rest))

    return let(at, use)


def _joined(tokens: Column, signs: bool) -> Column:
    """The tokens' text again; with signs before and after the markers that have a number."""
    plain = lambda t: F.concat(t["marker"], t["text"])
    signed = lambda t: F.when(t["number"] != "", F.concat(F.lit(_AT), t["number"], F.lit(_END), t["marker"], F.lit(_TEXT), t["text"])).otherwise(plain(t))
    return F.array_join(F.transform(tokens, signed if signs else plain), "")


def _sections(tokens: Column) -> Column:
    """struct(main, keys): the text before the last answer-key section, with signs, and that section; keys is null if there is none."""

    def headed(c: Column) -> Column:
        after = F.substring_index(c, KEY_WORD, -1)
        main = F.left(c, F.length(c) - F.length(after) - len(KEY_WORD))
        return F.struct(main.alias("main"), strip(_only(after, (_AT,), lambda x: F.regexp_replace(x, f"{_AT}[^{_END}]*{_END}|{_TEXT}", ""))).alias("keys"))

    def fallback(c: Column) -> Column:
        cut = F.nullif(F.length(F.regexp_extract(c, rf"(?s)\A(.+){_FALLBACK}", 1)), F.lit(0))
        marked = lambda k: F.regexp_replace(F.left(c, k), _QUESTION, f"{_AT}$1{_END}$0{_TEXT}")
        return let(cut, lambda k: F.when(k.isNotNull(), F.struct(marked(k).alias("main"), strip(c.substr(k + 1, F.length(c))).alias("keys"))))

    def use(c: Column) -> Column:
        whole = F.struct(c.alias("main"), F.lit(None).cast("string").alias("keys"))
        section = F.when(F.contains(c, F.lit(SECTION_WORD)), fallback(_joined(tokens, False)))
        return F.when(F.contains(c, F.lit(KEY_WORD)), headed(c)).otherwise(F.coalesce(section, whole))

    return let(_joined(tokens, True), use)


def answer_keys(section: Column) -> Column:
    """array<struct<question, answer>> in order of appearance; the last of a question counts."""
    clean = F.regexp_replace(F.replace(section, F.lit(KEY_WORD), F.lit(" ")), rf"(?:\A|(?<=\n))[^\n]*{SECTION_WORD}", " ")
    clean = normalized(F.replace(clean, F.lit(":"), F.lit(" ")))
    groups = let(clean, lambda c: F.arrays_zip(*[F.regexp_extract_all(c, F.lit(_KEY), k).alias(n) for k, n in ((1, "q"), (2, "option"), (3, "text"))]))
    rows = F.transform(groups, lambda g: F.struct(g["q"].cast("int").alias("question"), g["option"].alias("option"), normalized(g["text"]).alias("text")))
    rows = F.filter(rows, lambda r: r["text"] != "")
    return F.transform(rows, lambda r: F.struct(r["question"].alias("question"), F.when(r["option"] != "", F.concat(r["option"], F.lit(". "), r["text"])).otherwise(r["text"]).alias("answer")))


def _marked(c: Column) -> Column:
    """The text cut at its option markers; every part but the first begins with its label and an end sign."""
    return F.split(let(c, lambda t: _only(t, ("1", "2", "3", "4"), lambda x: F.regexp_replace(x, _OPTION, f"{_AT}$1{_END}"))), _AT)


def options(answer: Column) -> Column:
    """Labelled options of a text, empty unless it has two markers and its first two filled ones are 1 and 2."""
    none = F.array().cast(_OPTIONS)

    def use(parts: Column) -> Column:
        own = F.transform(F.slice(parts, 2, F.size(parts)), lambda p: F.struct(
            F.substring_index(p, _END, 1).alias("label"), normalized(p.substr(F.instr(p, _END) + 1, F.length(p))).alias("text")))
        own = F.filter(own, lambda o: o["text"] != "")
        good = lambda o: (F.size(parts) > 2) & (F.get(o, 0)["label"] == "1") & (F.get(o, 1)["label"] == "2")
        return let(own, lambda o: F.when(good(o), o).otherwise(none))

    some = F.contains(answer, F.lit("1")) & F.contains(answer, F.lit("2"))
    return F.when(some, let(_marked(F.array_join(filled_lines(answer), " ")), use)).otherwise(none)


def _bare(c: Column) -> Column:
    return F.btrim(c, F.lit(" :\n\t"))


def _split_block(b: Column) -> Column:
    """struct(n, asked, told) of a block struct(number, text) whose marker is removed."""

    def labelled(t: Column) -> Column:
        at = F.instr(t, ANSWER_WORD)
        told = F.regexp_replace(t.substr(at + len(ANSWER_WORD), F.length(t)), rf"\A{_S}:?", "")
        return F.struct(b["number"].alias("n"), normalized(_bare(t.substr(F.lit(1), at - 1))).alias("asked"), normalized(told).alias("told"))

    def unlabelled(t: Column) -> Column:
        parts = _marked(t)

        def use(p: Column) -> Column:
            splits = (F.size(p) > 2) & F.startswith(F.get(p, 1), F.lit("1" + _END)) & F.startswith(F.get(p, 2), F.lit("2" + _END))
            cut = F.when(splits, F.length(F.get(p, 0))).otherwise(F.length(t))
            return F.struct(b["number"].alias("n"), normalized(_bare(t.substr(F.lit(1), cut))).alias("asked"), normalized(t.substr(cut + 1, F.length(t))).alias("told"))

        return let(parts, use)

    return let(normalized(b["text"]), lambda t: F.when(F.contains(t, F.lit(ANSWER_WORD)), labelled(t)).otherwise(let(_bare(t), unlabelled)))


def _with_options(q: Column, keys: Column) -> Column:
    own = F.filter(keys, lambda k: k["question"] == q["n"])
    return F.struct(q["n"].alias("n"), q["asked"].alias("asked"), q["told"].alias("told"), options(q["told"]).alias("options"), F.try_element_at(own, F.lit(-1))["answer"].alias("key"))


def _finished(q: Column) -> Column:
    choice = F.size(q["options"]) > 0
    kind = F.when(choice, F.lit("multiple_choice")).when(q["n"] == 3, F.lit("direct_answer")).otherwise(F.lit("narrative"))
    narrative = ~choice & (q["n"] != 3)
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    warnings = F.array(
        F.when(q["asked"] == "", F.lit("Empty question text.")),
        F.when(choice & (F.size(q["options"]) < 4), F.concat(F.lit("Expected 4 options, detected "), F.size(q["options"]).cast("string"), F.lit("."))),
        F.when(~narrative & empty(q["key"]), F.lit("Missing answer key.")),
        F.when(narrative & empty(q["told"]), F.lit("Missing narrative answer.")),
    )
    return F.struct(
        q["n"].alias("question_number"), q["asked"].alias("question_telugu"), kind.alias("answer_type"), q["options"].alias("options_telugu"),
        F.when(~narrative, q["key"]).alias("answer_key_telugu"),
        F.when(choice, F.lit(None).cast("string")).when(narrative, q["told"]).otherwise(q["key"]).alias("answer_telugu"),
        F.filter(warnings, lambda w: w.isNotNull()).alias("parser_warnings"),
    )


def parse_questions(rows: DataFrame, text: str = "raw_telugu_text") -> DataFrame:
    """Adds questions (in order of number, first of each) and question_warnings."""
    t = rows.withColumn("__t", let(_tokens(normalized(F.coalesce(F.col(text), F.lit("")))), _from_first))
    t = t.withColumn("__s", F.when(F.col("__t").isNotNull(), _sections(F.col("__t"))))
    t = t.withColumn("__keys", F.when(F.col("__s.keys").isNotNull(), answer_keys(F.col("__s.keys"))).otherwise(F.array().cast("array<struct<question:int,answer:string>>")))
    parts = F.split("__s.main", _AT)
    blocks = F.transform(F.slice(parts, 2, F.size(parts)), lambda p: F.struct(F.substring_index(p, _END, 1).cast("int").alias("number"), strip(p.substr(F.instr(p, _TEXT) + 1, F.length(p))).alias("text")))
    t = t.withColumn("__blocks", F.coalesce(F.array_sort(first_wins(blocks, lambda b: b["number"])), F.array().cast("array<struct<number:int,text:string>>")))
    t = t.withColumn("__parsed", F.transform(F.transform("__blocks", _split_block), lambda q: _with_options(q, F.col("__keys"))))
    t = t.withColumn("questions", F.transform("__parsed", _finished))
    numbers = F.transform("questions", lambda q: q["question_number"])
    missing = F.array_except(F.sequence(F.lit(1), F.lit(EXPECTED_QUESTIONS)), numbers)
    general = F.filter(F.array(
        F.when(F.size(numbers) != EXPECTED_QUESTIONS, F.concat(F.lit(f"Expected {EXPECTED_QUESTIONS} questions, detected "), F.size(numbers).cast("string"), F.lit("."))),
        F.when(F.size(missing) > 0, F.concat(F.lit("Missing question numbers: "), python_list(missing))),
    ), lambda w: w.isNotNull())
    each = F.flatten(F.transform("questions", lambda q: F.transform(q["parser_warnings"], lambda w: F.concat(F.lit("Q"), q["question_number"].cast("string"), F.lit(": "), w))))
    found = F.when(F.size("questions") == 0, F.array(F.lit("No question starts detected."))).otherwise(F.concat(general, each))
    return t.withColumn("question_warnings", found).drop("__t", "__s", "__keys", "__blocks", "__parsed")


def attach_questions(chapters: DataFrame) -> DataFrame:
    """Chapters with their questions replaced; warnings of an earlier parse go, so that a rerun changes nothing."""
    own = chapters.drop("questions") if "questions" in chapters.columns else chapters
    parsed = parse_questions(own)
    old = ("Expected 5 questions", "Missing question numbers", "No question starts", "Q")

    def stays(w: Column) -> Column:
        made = F.lit(False)
        for o in old:
            made = made | F.startswith(w, F.lit(o))
        return ~made

    parsed = parsed.withColumn("parser_warnings", F.concat(F.filter(F.coalesce("parser_warnings", F.array().cast("array<string>")), stays), "question_warnings"))
    return parsed.withColumn("needs_review", F.size("parser_warnings") > 0).drop("question_warnings")


