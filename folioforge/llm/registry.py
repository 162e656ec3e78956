"""Queries of the training-data operators with their production parameters, and their SQL."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql
from .ann import nearest
from .chat_format import format_chats, loss_text, read_chats
from .common import narrow, table
from .exact_dedup import exact_dedup
from .jaccard_join import jaccard_components
from .licenses import license_scan
from .line_dedup import line_dedup
from .merkle import manifest
from .near_dedup import near_duplicates
from .packing import pack, token_pieces
from .periods import periodic_runs, planted
from .pieces import encode_parts, summary
from .substring_dedup import substring_dedup
from .toxicity import fit, held_out, score

#: Score from which a document counts as toxic.
TOXIC_AT = 0.7

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), 2048)
    return pack(pieces, 2048)


def op2_lsh_forest_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_block_matrix_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every known licence, in whole documents and in whole lines."""
    return license_scan(table(spark, sf_dir, "documents"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), 50).drop("kept_text")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op7_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= TOXIC_AT).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"), F.size("spans").cast("long").alias("n_spans"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, dropped lines and the digest of the remaining text of each document."""
    kept = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text, and the digest of the text decoded from them."""
    path = tokenizer_file("piece_bpe_32k.model")
    return summary(*encode_parts(table(spark, sf_dir, "documents"), path), path)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = r"\### Assistant: </turn> ok"
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], own.schema)
    chats = read_chats(format_chats(own.unionByName(extra)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = loss_text(F.col("formatted"), F.col("loss_spans"))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(F.encode(learned, "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least four periods and six words, and the digest of the text that is left of each document."""
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    found = found.withColumn("longest", longest)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.encode(lines, "UTF-8"), 256).alias("runs_sha256"), F.sha2(F.encode("collapsed_text", "UTF-8"), 256).alias("collapsed_sha256"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents linked by a shingle similarity of 0.8 or more."""
    return jaccard_components(table(spark, sf_dir, "documents"), 80)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents in trees by lang; every third document is verified with its text's A-Z in lower case."""
    docs = narrow(table(spark, sf_dir, "documents"), {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"})
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    small = {"text": F.translate("text", string.ascii_uppercase, string.ascii_lowercase)}
    return manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", tampered, small)


def queries() -> dict[str, Query]:
    own = [
        op1_best_fit_packing, op2_lsh_forest_near_dedup, op3_block_matrix_ann, op4_license_scan, op5_suffix_array_dedup,
        op6_exact_dedup, op7_crf_toxicity, op8_line_dedup, op9_sentencepiece, op10_chat_format,
        op11_periodic_runs, op12_jaccard_join, op13_merkle_manifest,
    ]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLE)
