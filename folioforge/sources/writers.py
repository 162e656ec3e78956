"""Sinks: partitioned tables, and the single files of one book.

A single file is written by one task from rows that arrive in order from range partitions, where they were formatted; the
driver only renames what the task has committed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import INDEX_COLUMNS
from ..shipping import ship


def write_text(spark: SparkSession, path: str, lines: Iterable[str]) -> None:
    """One file in UTF-8 through the file system that the path names; lines are streamed."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        for line in lines:
            out.write(bytearray(line.encode("utf-8")))
    finally:
        out.close()


def _json(df: DataFrame, drop: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in drop]), {"ignoreNullFields": "false"})


def _indented(objects: pa.Array) -> pa.Array:
    """JSON texts over several lines, in a list's margin."""
    return pa.array(["  " + json.dumps(json.loads(x), ensure_ascii=False, indent=2).replace("\n", "\n  ") for x in objects.to_pylist()], pa.string())


def _write_file(rows: DataFrame, path: str, order: Sequence[str], frame: Callable[[Iterator[str]], Iterator[str]] = iter, end: str = "\n") -> None:
    """The column line of rows as one file, in order. frame turns the lines into those of the file; it runs in the task that writes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        for line in frame(x for b in batches for x in b.column(0).to_pylist() if x is not None):
            held.append(line)
            if len(held) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])
                held = []
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])

    spark = rows.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    beside = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{at.getName()}-{uuid.uuid4().hex}")
    own = rows.select(F.lit(1).alias("__part"), *[F.col(c).alias(f"__{c}") for c in order], "line")
    # A row without a line, so that a file without rows is written by a task too.
    head = spark.range(1).select(F.lit(0).alias("__part"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in own.schema.fields[1:]])
    own = ship(head.unionByName(own)).orderBy(*own.columns[:-1]).select("line").coalesce(1).mapInArrow(run, "value string")
    try:
        own.write.option("lineSep", end).text(beside.toString())
        parts = [s.getPath() for s in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(beside, "part-*"))]
        fs.delete(at, True)
        if not fs.rename(parts[0], at):
            raise OSError(f"can't write {path}")
    finally:
        fs.delete(beside, True)


def _listed(objects: Iterator[str]) -> Iterator[str]:
    """The lines of a JSON array; each object waits until it is known whether another follows."""
    held = None
    for x in objects:
        yield "[" if held is None else held + ","
        held = x
    yield from ["[]"] if held is None else [held, "]"]


def write_jsonl(df: DataFrame, path: str) -> None:
    """A folder of JSON lines, one object per row, nulls written: the form for any size."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def _cut(lines: Iterator[str], sign: str) -> Iterator[str]:
    """The lines' text cut at a sign in which it ends: written with the sign after each piece it has no other end."""
    rest = None
    for line in lines:
        *whole, rest = (line if rest is None else f"{rest}\n{line}").split(sign)
        yield from whole


def write_jsonl_file(df: DataFrame, path: str, order: Sequence[str], drop: Sequence[str] = ()) -> None:
    """One ordered file of JSON lines."""
    _write_file(df.withColumn("line", _json(df, drop)), path, order)


def write_json_array(df: DataFrame, path: str, order: Sequence[str], drop: Sequence[str] = (), end: str = "\n") -> None:
    """One indented JSON array; end, a line end or nothing, comes after it."""
    rows = ship(df).withColumn("line", F.arrow_udf(_indented, "string")(_json(df, drop)))  # type: ignore[call-overload]
    if end:
        _write_file(rows, path, order, _listed)
    else:
        _write_file(rows, path, order, lambda lines: _cut(_listed(lines), "]"), "]")


def write_json_object(row: DataFrame, path: str) -> None:
    """The only row as one indented JSON object."""
    text = row.select(_json(row, [])).first()[0]
    write_text(row.sparkSession, path, [json.dumps(json.loads(text), ensure_ascii=False, indent=2) + "\n"])


def _csv_field(c: str) -> Column:
    value = F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.when(F.regexp_like(value, F.lit('[",\r\n]')), F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(value)


def write_index_csv(index: DataFrame, path: str) -> None:
    def headed(lines: Iterator[str]) -> Iterator[str]:
        yield ",".join(INDEX_COLUMNS)
        yield from lines

    _write_file(index.withColumn("line", F.concat_ws(",", *map(_csv_field, INDEX_COLUMNS))), path, ["chapter_number"], headed, "\r\n")


def write_chunks(chunks: DataFrame, index: DataFrame, folder: str) -> None:
    """final_chunks.jsonl, final_chunks.json and chapter_index.csv from one cached frame."""
    own = chunks.cache()
    try:
        order, drop = ["chapter_number", "chunk_no"], ["chapter_number", "chunk_no"]
        write_jsonl_file(own, f"{folder}/final_chunks.jsonl", order, drop)
        write_json_array(own, f"{folder}/final_chunks.json", order, drop)
        write_index_csv(index, f"{folder}/chapter_index.csv")
    finally:
        own.unpersist()


def write_cache(translated: DataFrame, path: str) -> None:
    """The keyed cache: chapters of this run replace theirs, all others stay."""
    translated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chapter_number").parquet(path)
