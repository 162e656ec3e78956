"""Line deduplication within an edit distance of one word, in DataFrame functions only.

A line goes if an equal line, or one at a word edit distance of one (a word replaced, inserted or deleted), stands
earlier: in a document with a smaller doc_id, or higher up in the same one. Lines are compared in lower case with
white space collapsed; lines of fewer than `least_words` words only match when equal. All lines are judged on
the input, so a line may go because of one that goes itself.

The deletion neighbourhood of a line is the line and each variant with one word deleted, as hashed keys. Two lines are
within the bound exactly when one is a variant of the other, or both are equal after deleting the word at the same place.
Lines sharing such a key are joined through the earliest line of the key, which is linear in its lines, and the
word edit distance of each joined pair is verified on the words. Equal lines collapse to one before that, and only
lines that share their first or last words with a different line (as any pair within the bound does) have variants
emitted.

Defined cases: null texts have no lines and stay null; blank lines are never dropped; rows without doc_id take no
part and keep their lines; rows that repeat a doc_id share positions, so lines at the same position don't drop each other,
and each row loses only lines of its own text (rows are told apart by the text's hash); an empty table gives an empty result; columns other than doc_id and text pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bloom_probe, bloom_words, filter_bits, join_back, narrow, stored

KEY = ["k1", "k2"]


def _flat(line: Column) -> Column:
    """Lower case, every run of white space one space, none at the ends."""
    odd = F.lit(False)
    for run in ("  ", "\t", "\r", "\x0b", "\x0c"):
        odd = odd | F.contains(line, F.lit(run))
    low = F.lower(line)
    return F.trim(F.when(odd, F.regexp_replace(low, r"[\x20\x09-\x0D]+", " ")).otherwise(low))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, variant, line_no, flat, k1, k2) of every line that isn't blank; variant tells texts of one doc_id apart."""
    own = narrow(docs, {"doc_id": "long", "text": "string"}).filter("doc_id IS NOT NULL")
    out = own.select("doc_id", _variant().alias("variant"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    out = out.filter(F.btrim("line", F.lit(" \t\r\x0b\x0c")) != "").select("doc_id", "variant", "line_no", _flat(F.col("line")).alias("flat"))
    return out.withColumns({"k1": F.xxhash64("flat"), "k2": F.xxhash64(F.lit(97), "flat")})


def _variant() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def _ends(lines: DataFrame, least_words: int) -> DataFrame:
    """Adds ends, keys of which two lines within the bound share one: their first or last h words.

    h is the largest power of two of at most half the words, so it is the same for both but where the longer has a power
    of two of words; such a line also has the keys of half its h. An edit among the first h words leaves the last h.
    """
    own = lines.withColumn("w", F.split("flat", " ")).withColumn("n_words", F.size("w"))
    own = own.withColumn("h", F.expr("shiftleft(1, length(bin(n_words)) - 2)"))

    def keys(m: Column) -> list[Column]:
        return [F.xxhash64(F.lit("first"), m, F.slice("w", F.lit(1), m)), F.xxhash64(F.lit("last"), m, F.slice("w", F.col("n_words") - m + 1, m))]

    half = F.expr("h div 2").cast("int")
    ends = F.when(F.col("h") * 2 == F.col("n_words"), F.array(*keys(F.col("h")), *keys(half))).otherwise(F.array(*keys(F.col("h"))))
    return own.withColumn("ends", F.when(F.col("n_words") >= least_words, ends)).drop("w", "n_words", "h")


def _halves(words: Column) -> Column:
    """Keys of which two lines within the bound share one: first and last half of the words, for n and for n - 1 words."""

    def of(m: Column) -> list[Column]:
        half = F.floor(m / 2).cast("int")
        return [F.xxhash64(F.lit("first"), m, F.slice(words, F.lit(1), half)), F.xxhash64(F.lit("last"), m, F.slice(words, F.size(words) - (m - half) + 1, m - half))]

    return F.array(*of(F.size(words)), *of(F.size(words) - 1))


def _distance_one(a: Column, b: Column) -> Column:
    """Whether two arrays of words differ by exactly one replaced, inserted or deleted word."""
    short, long_ = F.when(F.size(a) <= F.size(b), a).otherwise(b), F.when(F.size(a) <= F.size(b), b).otherwise(a)
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda x: x)) == 1
    head = F.array_position(F.zip_with(short, F.slice(long_, 1, F.size(short)), lambda x, y: x == y), False).cast("int")
    at = F.when(head == 0, F.size(long_)).otherwise(head)
    more = F.concat(F.slice(long_, 1, at - 1), F.slice(long_, at + 1, F.size(long_))) == short
    return F.when(F.size(a) == F.size(b), same).when(F.size(long_) - F.size(short) == 1, more).otherwise(F.lit(False))


def repeated_lines(docs: DataFrame, least_words: int = 8) -> DataFrame:
    """(doc_id, variant, line_no) of every line that goes."""
    own = _ends(_lines(docs), least_words)
    rows = stored(own.select("doc_id", "variant", "line_no", *KEY, "ends"), "lines")
    total = rows.count()
    lines = rows.groupBy(*KEY).agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("n"), F.first("ends").alias("ends"))
    lines = stored(lines, "distinct", total)

    # Lines that share an end with a different line (and by the filter's error a few more).
    end = lines.filter("ends IS NOT NULL").select(*KEY, "first", F.explode("ends").alias("end"))
    shared = stored(end.groupBy("end").agg(F.min("k1").alias("a"), F.max("k1").alias("b")).filter("a <> b").select("end"), "shared", total)
    bits = filter_bits(shared.count())
    cells = [F.col("end"), F.xxhash64("end")]
    near = bloom_probe(end, bloom_words(shared, cells, bits), cells, bits, "maybe").filter("maybe")
    near = stored(near.select(*KEY, F.col("first.doc_id").alias("doc_id"), F.col("first.line_no").alias("line_no")).distinct(), "near", total)
    n_near = near.count()

    gone = lines.filter("n > 1").select(*KEY, "first", "n", F.lit(False).alias("flag"))
    if n_near:
        flagged = stored(_near_lines(docs, near, n_near), "flagged", n_near)
        bits = filter_bits(flagged.count())
        cells = [F.col("k1"), F.col("k2")]
        words = bloom_words(flagged, cells, bits)
        marked = bloom_probe(lines.drop("ends"), words, cells, bits, "maybe")
        held = marked.filter("maybe").join(flagged.withColumn("flag", F.lit(True)), KEY, "left")
        held = held.filter("n > 1 OR flag").select(*KEY, "first", "n", F.coalesce("flag", F.lit(False)).alias("flag"))
        gone = held.unionByName(marked.filter("NOT maybe AND n > 1").select(*KEY, "first", "n", F.lit(False).alias("flag")))
    gone = stored(gone, "gone", total)
    bits = filter_bits(gone.count())
    cells = [F.col("k1"), F.col("k2")]
    maybe = bloom_probe(rows.drop("ends"), bloom_words(gone, cells, bits), cells, bits, "maybe").filter("maybe").drop("maybe")
    hit = join_back(maybe, gone, KEY, "n", max(total, 1))
    return hit.filter(F.col("flag") | (F.struct("doc_id", "line_no") > F.col("first"))).select("doc_id", "variant", "line_no")


def _near_lines(docs: DataFrame, near: DataFrame, n_near: int) -> DataFrame:
    """Keys of the lines that have an earlier line at a word edit distance of one."""
    bits = filter_bits(n_near)
    cells = [F.col("k1"), F.col("k2")]
    ids = [F.xxhash64(F.col("doc_id").cast("long"))]
    some = bloom_probe(docs.select("doc_id", "text"), bloom_words(near, ids, bits), ids, bits, "has").filter("has").drop("has")
    own = bloom_probe(_lines(some), bloom_words(near, cells, bits), cells, bits, "maybe").filter("maybe")
    words = F.transform(F.split("flat", " "), lambda w: F.xxhash64(w))
    texts = own.join(near, [*KEY, "doc_id", "line_no"]).select(*KEY, F.struct("doc_id", "line_no").alias("first"), words.alias("w"))
    texts = stored(texts.dropDuplicates(KEY), "ends", n_near, 5_000)

    # Of these, only lines that share half of their words in place with a different line of about their length.
    half = texts.select(*KEY, F.explode(_halves(F.col("w"))).alias("half"))
    shared = stored(half.groupBy("half").agg(F.min("k1").alias("a"), F.max("k1").alias("b")).filter("a <> b").select("half"), "halves", n_near)
    bits = filter_bits(shared.count())
    cells = [F.col("half"), F.xxhash64("half")]
    held = bloom_probe(half, bloom_words(shared, cells, bits), cells, bits, "maybe").filter("maybe").select(*KEY).distinct()
    texts = stored(texts.join(held, KEY), "words", n_near, 5_000)

    without = F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.xxhash64(F.slice("w", F.lit(1), i - 1), F.slice("w", i + 1, F.size("w"))))
    keyed = F.concat(F.array(F.xxhash64("w")), without)
    variants = stored(texts.select(*KEY, "first", F.posexplode(keyed).alias("i", "v")), "variants")

    # Only keys of two variants or more can join lines: the rest of the variants end here.
    twice = stored(variants.groupBy("v").agg(F.count("*").alias("n")).filter("n > 1").select("v"), "twice", variants.count())
    bits = filter_bits(twice.count())
    cells = [F.col("v"), F.xxhash64("v")]
    variants = stored(bloom_probe(variants, bloom_words(twice, cells, bits), cells, bits, "maybe").filter("maybe").drop("maybe"), "shared_variants")
    n = max(1, variants.count())
    who = F.struct("first", *KEY)
    cuts, wholes = variants.filter("i > 0"), variants.filter("i = 0")
    least = lambda of: F.min(F.when(of, who))
    same = variants.groupBy("v", "i").agg(F.min(who).alias("e"), F.count("*").alias("n")).filter("i > 0 AND n > 1")
    other = variants.groupBy("v").agg(least(F.col("i") == 0).alias("whole"), least(F.col("i") > 0).alias("cut"), F.count("*").alias("n")).filter("whole IS NOT NULL AND cut IS NOT NULL")
    other = stored(other, "others", n)
    found = [
        join_back(cuts, same, ["v", "i"], "n", n),
        join_back(cuts, other.select("v", F.col("whole").alias("e"), "n"), ["v"], "n", n),
        join_back(wholes, other.select("v", F.col("cut").alias("e"), "n"), ["v"], "n", n),
    ]
    pairs = None
    for f in found:
        f = f.filter(F.col("e.first") < F.col("first")).select(*KEY, F.col("e.k1").alias("e1"), F.col("e.k2").alias("e2"))
        pairs = f if pairs is None else pairs.unionByName(f)
    pairs = stored(pairs.distinct(), "pairs", n)
    # A line may be the earliest of many keys' lines: its words come to them as to a group of that size.
    sizes = pairs.groupBy("e1", "e2").agg(F.count("*").alias("n"))
    early = texts.select(F.col("k1").alias("e1"), F.col("k2").alias("e2"), F.col("w").alias("u")).join(sizes, ["e1", "e2"])
    checked = join_back(pairs.join(texts.select(*KEY, "w"), KEY), early, ["e1", "e2"], "n", n).filter(_distance_one(F.col("w"), F.col("u")))
    return checked.select(*KEY).distinct()


def line_dedup(docs: DataFrame, least_words: int = 8) -> DataFrame:
    """The documents with the lines that remain, and n_lines and n_dropped; other columns pass through."""
    clash = [c for c in docs.columns if c in ("n_lines", "n_dropped")]
    docs = docs.drop(*clash)
    drops = repeated_lines(docs, least_words).groupBy("doc_id", "variant").agg(F.collect_set("line_no").alias("__gone"))
    drops = stored(drops.withColumnsRenamed({"doc_id": "__doc", "variant": "__variant"}), "drops")
    bits = filter_bits(drops.count())
    words = bloom_words(drops, [F.xxhash64("__doc")], bits)
    marked = bloom_probe(docs, words, [F.xxhash64(F.col("doc_id").cast("long"))], bits, "__maybe")
    maybe, rest = marked.filter("__maybe").drop("__maybe"), marked.filter("not __maybe").drop("__maybe")
    # Drops grow with the documents, so they are never broadcast, however few they are.
    joined = maybe.join(drops.hint("merge"), (F.col("doc_id").cast("long") == F.col("__doc")) & (_variant() == F.col("__variant")), "left").drop("__doc", "__variant")
    breaks = (F.octet_length("text") - F.octet_length(F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))) + 1).cast("long")
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(breaks).cast("long")
    none = F.lit(0).cast("long")
    whole = F.col("__gone").isNull()
    lines = joined.withColumn("__lines", F.when(~whole, F.split("text", "\n")))
    kept = F.array_except(F.sequence(F.lit(1), F.size("__lines")), F.transform("__gone", lambda i: i + 1))  # in order
    text = F.when(whole, F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.element_at("__lines", i)), "\n"))
    changed = lines.withColumns({"n_lines": F.when(whole, n_lines).otherwise(F.size("__lines").cast("long")), "n_dropped": F.when(whole, none).otherwise(F.size("__gone").cast("long")), "text": text})
    return changed.drop("__gone", "__lines").unionByName(rest.withColumns({"n_lines": n_lines, "n_dropped": none}))
