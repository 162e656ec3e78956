"""Exact deduplication by two Bloom passes, in DataFrame functions only.

Pass one counts hash cells and keeps those set twice in a Bloom filter of bounded size; pass two probes it.
Only rows whose cells are all set twice may have an equal text: they alone shuffle by digest. The rest pass
straight through.

Defined cases: a null text is the empty text; a row with a null doc_id takes part but is kept_id only of a
group without any other id; rows repeated with one doc_id are one id, so each of them is kept; an empty table
gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bloom_probe, bloom_words, filter_bits, join_back, narrow, stored

WHITE = r"[\x20\x09-\x0D]+"


def digests(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, digest): SHA-256 of each whole text after every run of white space became one space."""
    own = narrow(docs, {"doc_id": "long", text: "string"})
    flat = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE, " ")
    return own.select("doc_id", F.unhex(F.sha2(F.encode(flat, "UTF-8"), 256)).alias("digest"))


def exact_dedup(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row."""
    rows = stored(digests(docs, text), "digests")
    total = rows.count()
    bits = filter_bits(total)
    cells = [F.xxhash64("digest"), F.xxhash64("digest", F.lit(7))]
    seen_twice = bloom_words(rows, cells, bits, least=2)
    probed = bloom_probe(rows, seen_twice, cells, bits, "maybe")
    maybe, lone = probed.filter("maybe").drop("maybe"), probed.filter("not maybe").drop("maybe")
    groups = maybe.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    found = join_back(maybe, groups, ["digest"], "group_size", total)
    alone = lone.select("doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return found.unionByName(alone).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
