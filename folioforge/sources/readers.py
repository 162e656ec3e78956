"""Sources: PDF pages, JSON lines, JSON documents, CSV rows, alias files. Schemas are given, never inferred."""

from __future__ import annotations

import csv
import importlib.util
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.entities import alias_rows
from ..operators.pages import printed_page_number
from ..schemas import PAGE
from . import splitting


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object per line; blank lines are skipped, anything else that isn't JSON raises."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_jsonl(spark, path, schema) if exists(spark, path) else spark.createDataFrame([], schema)


def count_jsonl_lines(spark: SparkSession, path: str) -> int:
    """Lines that aren't blank, unparsed; 0 if the file is missing."""
    return spark.read.text(path).filter(strip(F.col("value")) != "").count() if exists(spark, path) else 0


def _root(spark: SparkSession, path: str, sign: str) -> bool:
    """Whether the first character that isn't white space is the sign; lines are read until one has such a character."""
    head = spark.read.text(path).select(F.regexp_replace("value", r"\A[\s\ufeff]+", "").alias("v")).filter("v <> ''").select(F.left("v", F.lit(1))).first()
    return head is not None and head[0] == sign


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The schema's columns, index and json of each object of a file whose root is an array; none if the file is missing.

    A file of more than one block is read by many tasks, if it holds nothing but objects.
    json is the object as it is written, so keys that it lacks can be told from nulls; what doesn't fit the schema is null.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], f"{schema}, index long, json string")
    records = splitting.json_records(spark, path) if splitting.is_large(spark, path) and _root(spark, path, "[") else None
    if records is not None:
        own = records.select("index", F.to_json(F.parse_json("text")).alias("json"))
        return own.select(F.from_json("json", schema).alias("r"), "index", "json").select("r.*", "index", "json")
    text = F.regexp_replace("value", r"\A\ufeff", "")
    whole = spark.read.text(path, wholetext=True).select(F.posexplode(F.variant_get(F.parse_json(text), "$", "array<variant>")).alias("index", "v"))
    own = whole.select(F.col("index").cast("long").alias("index"), F.to_json("v").alias("json"))
    return own.select(F.from_json("json", schema).alias("r"), "index", "json").select("r.*", "index", "json")


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a file whose root is an array; a missing file or another root raises."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    if not _root(spark, path, "["):
        raise ValueError(f"{path} must contain a JSON array")
    records = splitting.json_records(spark, path) if splitting.is_large(spark, path) else None
    if records is not None:
        return records.select(F.from_json("text", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", True).json(path)


def read_json(spark: SparkSession, path: str, schema: str, default: DataFrame | None = None) -> DataFrame | None:
    """A whole-file JSON document (or array of them); `default` if the file is missing."""
    if not exists(spark, path):
        return default
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", True).json(path)


def read_csv_rows(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Rows of a CSV with a header, all strings; none if the file is missing. A file of more than one block is read by many tasks."""
    if not exists(spark, path):
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns or ["value"]))
    options = {"multiLine": "true", "escape": '"', "emptyValue": ""}
    records = splitting.csv_records(spark, path) if splitting.is_large(spark, path) else None
    if records is not None:
        head = records.orderBy("index").first()
        names = next(csv.reader([head["text"]], strict=True)) if head else columns or ["value"]
        schema = ", ".join(f"`{n}` string" for n in names)
        rest = records.filter(F.col("index") > (head["index"] if head else 0))
        return rest.select(F.from_csv("text", schema, options).alias("r")).select("r.*").fillna("")
    return spark.read.option("header", True).option("nullValue", None).options(**options).csv(path).fillna("")


def read_aliases(path: str) -> list[tuple]:
    """Alias rows of a YAML file, longest first."""
    return alias_rows(read_config(path))


def read_config(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def _pdf_texts(content: bytes) -> list[str]:
    import fitz

    with fitz.open(stream=content, filetype="pdf") as book:
        return [page.get_text("text") for page in book]


def read_pdf_pages(spark: SparkSession, path: str, texts: Callable[[bytes], list[str]] | None = None) -> DataFrame:
    """One row per page of each PDF. texts gives a file's page texts; by default a PDF library, which the executors must have."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    if texts is None and not any(importlib.util.find_spec(m) for m in ("pymupdf", "fitz")):
        raise RuntimeError("no PDF library is installed; give texts, or start from page records (read_jsonl with schemas.PAGE)")
    open_ = texts or _pdf_texts

    def pages(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for content in pdf["content"]:
                yield pd.DataFrame([(i, None, t, "pymupdf") for i, t in enumerate(open_(bytes(content)))], columns=["pdf_page_index", "printed_page_number", "raw_text", "extraction_method"])

    raw = spark.read.format("binaryFile").load(path).select("content").mapInPandas(pages, PAGE)
    return raw.withColumn("printed_page_number", printed_page_number(F.col("raw_text")))
