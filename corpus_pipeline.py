"""A corpus pipeline over documents: toxicity filter, line, near-duplicate and substring deduplication, packing.

Each stage works on all that its predecessor kept. All but the last return the columns of documents; the last returns
the packed pieces. The toxicity stage learns from labels, so SQL cannot express the whole: ORACLE_SQL is None, and the
tests hold each stage against a brute-force version on its own input.

Defined cases: a null text scores as an empty one, has no lines, no near copies and no bytes to lose, and is packed as its end
token; it is null up to line deduplication and empty from substring deduplication on. Empty and blank texts pass every
stage. Rows without doc_id are scored and packed, and lose neither lines, bytes nor themselves to copies. Rows that repeat a
doc_id are one document to the deduplications: they go or stay together, and each loses only what its own text repeats. Of
equal lines, near copies and strings the smallest doc_id stays. Nulls in other columns pass; further columns are dropped; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.common import bloom_probe, bloom_words, filter_bits, stored, table
from folioforge.llm.line_dedup import line_dedup
from folioforge.llm.near_dedup import near_duplicates
from folioforge.llm.packing import pack, token_pieces
from folioforge.llm.registry import TOXIC_AT, tokenizer_file
from folioforge.llm.substring_dedup import substring_dedup
from folioforge.llm.toxicity import fit, score

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, carry=("text", "lang", "source", "n_chars")).filter(F.col("score") < TOXIC_AT).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats go; documents stay, even empty ones."""
    return line_dedup(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    gone = stored(near_duplicates(docs).filter("NOT kept").select(F.col("doc_id").alias("__gone")), "gone")
    bits = filter_bits(gone.count())
    docs = docs.select(*COLUMNS)
    marked = bloom_probe(docs, bloom_words(gone, [F.xxhash64("__gone")], bits), [F.xxhash64(F.col("doc_id").cast("long"))], bits, "__maybe")
    maybe = marked.filter("__maybe").select(*COLUMNS)
    left = maybe.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
    return marked.filter("NOT __maybe").select(*COLUMNS).unionByName(left)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte strings that an earlier document holds go."""
    kept = substring_dedup(docs, 50, carry=("lang", "source"))
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2048 tokens."""
    return pack(token_pieces(docs, tokenizer_file("word_bpe_49k.json"), 2048), 2048)


STAGES = [("toxicity", toxicity), ("line_dedup", lines), ("near_dedup", near_copies), ("suffix_array_dedup", substrings), ("best_fit_packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
