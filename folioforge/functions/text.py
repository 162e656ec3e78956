"""Column functions on text whose results do not depend on the regex engine's defaults.

Character classes are spelled out: white space, line ends, digits and word characters of Unicode, so that combining
marks break words and every Unicode space is trimmed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Single characters below U+0100 are one lookup of a bit set, and one range keeps most letters from the rest.
_RARE_SPACE = r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
SPACE = rf"[\x20{_RARE_SPACE}]"
#: The characters of SPACE, for trimming without a pattern.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028-\u2029]"
WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value evaluated, and written into the plan, once."""
    return F.get(F.transform(F.array(value), use), 0)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def single_spaced(c: Column) -> Column:
    """Each run of white space as one space; runs that are one space already are no match."""
    return F.regexp_replace(c, rf"(?:\x20{SPACE}|[{_RARE_SPACE}]){SPACE}*", " ")


def lines(c: Column) -> Column:
    """Lines of a text, ends removed. A text that ends in a line end has an empty last line here."""
    return F.split(c, LINE_END)


def filled_lines(c: Column) -> Column:
    """Stripped lines that aren't empty."""
    return F.filter(F.transform(lines(c), strip), lambda x: x != "")


def count_words(c: Column) -> Column:
    """Runs of word characters, apostrophes and hyphens with a word character in them; null counts 0."""
    return F.coalesce(F.regexp_count(c, F.lit(rf"{WORD}[\p{{L}}\p{{N}}_'-]*")), F.lit(0))


def sentences(c: Column) -> Column:
    """Parts after white space that follows . ! or ?, stripped, none empty. The cuts take all white space, so only the ends have any left."""
    return F.filter(F.split(strip(F.coalesce(c, F.lit(""))), rf"(?<=[.!?]){SPACE}+"), lambda x: x != "")


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, rf"{SPACE}+"), lambda x: x != "")


def shown(c: Column) -> Column:
    """As text; a null shows as None."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def or_else(*cs: Column) -> Column:
    """The first that is neither null nor empty, else the last."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs[:-1]], cs[-1])


def listed(values: Column, label: str | None = None) -> Column:
    body = F.when(F.coalesce(F.size(values), F.lit(0)) <= 0, F.lit("None listed")).otherwise(F.array_join(F.transform(values, lambda v: shown(v)), ", "))
    return body if label is None else F.concat(F.lit(f"{label}: "), body)


def part_ends(counts: Column, limit: Column) -> Column:
    """Where parts end, as numbers of items before the end, when items of these word counts fill parts of at most `limit` words.

    A fold over integers: nothing is copied but the list of ends, when a part closes. An item over the limit is a part by itself.
    """
    start = F.struct(F.array().cast("array<int>").alias("ends"), F.lit(0).alias("at"), F.lit(0).alias("n"), F.lit(False).alias("open"))

    def add(acc: Column, n: Column) -> Column:
        over = n > limit
        closes = acc["open"] & (over | (acc["n"] + n > limit))
        after = (acc["at"] + 1).cast("int")
        both = F.when(closes & over, F.concat(acc["ends"], F.array(acc["at"], after))).when(closes, F.concat(acc["ends"], F.array(acc["at"])))
        return F.struct(
            both.when(over, F.concat(acc["ends"], F.array(after))).otherwise(acc["ends"]).alias("ends"), after.alias("at"),
            F.when(over, F.lit(0)).when(closes, n).otherwise(acc["n"] + n).cast("int").alias("n"), (~over).alias("open"))

    return F.aggregate(counts, start, add, lambda acc: F.when(acc["open"], F.concat(acc["ends"], F.array(acc["at"]))).otherwise(acc["ends"]))


def pack_sentences(text: Column, limit: Column | int) -> Column:
    """Parts of at most `limit` counted words, filled sentence by sentence.

    A sentence over the limit closes the part before it and is cut by itself into runs of `limit` tokens.
    """
    limit = F.lit(limit).cast("int") if isinstance(limit, int) else limit.cast("int")

    def runs(sentence: Column) -> Column:
        return let(tokens(sentence), lambda w: F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / limit).cast("int")), lambda i: F.array_join(F.slice(w, i * limit + 1, limit), " ")))

    def parts(x: Column) -> Column:
        s, n, ends = x["s"], x["n"], x["ends"]

        def part(end: Column, k: Column) -> Column:
            begin = F.when(k > 0, F.get(ends, k - 1)).otherwise(F.lit(0))
            return F.when(F.get(n, begin) > limit, runs(F.get(s, begin))).otherwise(F.array(F.array_join(F.slice(s, begin + 1, end - begin), " ")))

        return F.flatten(F.transform(ends, part))

    own = let(sentences(text), lambda s: F.struct(s.alias("s"), F.transform(s, lambda x: count_words(x).cast("int")).alias("n")))
    own = let(own, lambda x: F.struct(x["s"].alias("s"), x["n"].alias("n"), part_ends(x["n"], limit).alias("ends")))
    return let(own, parts)


def first_wins(values: Column, key: Callable[[Column], Column]) -> Column:
    """Array elements whose key occurs at no earlier place: two sorts, so no element looks at all others."""
    tagged = F.transform(values, lambda x, i: F.struct(key(x).alias("key"), i.alias("at"), x.alias("value")))
    opens = lambda own: F.filter(own, lambda e, j: (j == 0) | ~e["key"].eqNullSafe(F.get(own, j - 1)["key"]))
    firsts = let(F.array_sort(tagged), lambda own: F.transform(opens(own), lambda e: F.struct(e["at"].alias("at"), e["value"].alias("value"))))
    return F.transform(F.array_sort(firsts), lambda e: e["value"])


def lower_bound(values: Column, before: Callable[[Column], Column]) -> Column:
    """Number of leading elements of an array for which `before` holds, where none follows one for which it doesn't; by halving."""
    steps = F.sequence(F.lit(0), F.length(F.bin(F.size(values))))

    def step(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        right = before(F.get(values, mid))
        return F.when(acc["lo"] >= acc["hi"], acc).otherwise(F.when(right, F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi"))).otherwise(F.struct(acc["lo"].alias("lo"), mid.alias("hi"))))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(values).alias("hi")), step, lambda acc: acc["lo"])


def python_list(values: Column) -> Column:
    """[1, 2]"""
    return F.concat(F.lit("["), F.array_join(values.cast("array<string>"), ", "), F.lit("]"))


def json_list(values: Column) -> Column:
    """A JSON array with a space after each comma."""
    quoted = F.transform(values, lambda v: F.to_json(F.array(v)).substr(F.lit(2), F.length(F.to_json(F.array(v))) - 2))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
