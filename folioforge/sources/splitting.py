"""Records of one large file, read by many tasks.

A file is cut into pieces at a byte that ends records but may also stand inside strings: `}` for a JSON array of objects, the line
end for CSV. Spark's line reader deals the pieces out by byte blocks. What a piece does to the lexical state is a function that
composes: an odd number of quotes turns inside and outside of strings around, and brackets outside of strings move the depth.
Running sums over pieces and blocks therefore give each piece its state, and records begin where it is outside at the least
depth. Spark's own parsers read the records. Escaped characters occur in strings only, and never are a brace, so a cut is in no escape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ordering import running_sums
from ..storage import stored


def is_large(spark: SparkSession, path: str) -> bool:
    """Whether the path is one file of more than one task's block."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p)
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return status.isFile() and status.getLen() > most


def _pieces(spark: SparkSession, path: str, end: str) -> DataFrame:
    """(block, at, value): pieces in order of the file, without their end."""
    text = spark.read.option("lineSep", end).text(path)
    return text.select(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")


def _odd(quoted: Column) -> Column:
    return (F.length(quoted) - F.length(F.replace(quoted, F.lit('"'), F.lit("")))) % 2


def _records(pieces: DataFrame, joint: str) -> DataFrame:
    """(index, text) of pieces with number, their record's; a record's pieces meet in one task."""
    listed = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    return pieces.groupBy(F.col("number").alias("index")).agg(F.array_join(F.transform(listed, lambda p: p["value"]), joint).alias("text"))


def json_records(spark: SparkSession, path: str) -> DataFrame | None:
    """(index, text) of the objects of a file whose root is an array; None if it holds anything else or isn't well formed."""
    pieces = _pieces(spark, path, "}")
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    pieces = stored(pieces.withColumns({"plain": plain, "odd": _odd(plain)}), "pieces")
    last = pieces.agg(F.max(F.struct("block", "at")).alias("last"))
    own = pieces.crossJoin(F.broadcast(last)).withColumn("ends", F.struct("block", "at") != F.col("last")).drop("last")  # one row
    own = running_sums(own, "block", "at", {"quotes": F.col("odd")})
    begins = F.col("quotes") % 2
    outside = (begins + F.col("odd")) % 2 == 0
    bare = F.regexp_replace(F.concat(F.when(begins == 1, F.lit('"')).otherwise(F.lit("")), F.col("plain")), r'"[^"]*(?:"|\z)', "")
    count = lambda signs: F.length(F.regexp_replace("bare", f"[^{signs}]", ""))
    own = own.withColumns({"bare": bare, "closes": F.col("ends") & outside}).withColumn("delta", count(r"\[{") - count(r"\]}") - F.col("closes").cast("int"))
    own = stored(running_sums(own.drop("plain", "bare", "odd", "quotes"), "block", "at", {"depth": F.col("delta")}), "depths")
    own = own.withColumn("closed", (F.col("closes") & (F.col("depth") + F.col("delta") == 1)).cast("int"))
    own = running_sums(own, "block", "at", {"number": F.col("closed")})
    own = stored(own.select("block", "at", "number", "closed", "ends", "delta", F.when(F.col("ends"), F.concat("value", F.lit("}"))).otherwise(F.col("value")).alias("value")), "numbered")
    n, depth = own.agg(F.sum("closed"), F.sum("delta")).first()
    records = _records(own, "").withColumn("inside", F.col("index") < n)
    # Before the first record stands the root's bracket, between records one comma, after the last the closing bracket.
    lead = F.regexp_extract("text", r"\A([^{]*)", 1)
    wanted = F.when(~F.col("inside"), r"\A\s*\]\s*\z" if n else r"\A\ufeff?\s*\[\s*\]\s*\z").when(F.col("index") == 0, r"\A\ufeff?\s*\[\s*\z").otherwise(r"\A\s*,\s*\z")
    strange = records.filter(~F.regexp_like(F.when(F.col("inside"), lead).otherwise(F.col("text")), wanted))
    if depth != 0 or not strange.isEmpty():
        return None
    return records.filter("inside").select("index", F.col("text").substr(F.length(lead) + 1, F.length("text")).alias("text"))


_FIELD = r'(?:"(?:[^"]|"")*+"|[^",]*+)'


def csv_records(spark: SparkSession, path: str) -> DataFrame | None:
    """(index, text) of the lines of a CSV file, with line ends inside quotes; None if quotes stand inside bare fields."""
    pieces = stored(_pieces(spark, path, "\n").withColumn("odd", _odd(F.col("value"))), "lines")
    own = running_sums(pieces, "block", "at", {"quotes": F.col("odd")})
    own = own.withColumn("ended", ((F.col("quotes") + F.col("odd")) % 2 == 0).cast("int"))
    own = running_sums(own, "block", "at", {"number": F.col("ended")})
    records = stored(_records(own.select("block", "at", "number", "value"), "\n"), "records")
    records = records.withColumn("text", F.regexp_replace("text", r"\A\ufeff|\r\z", ""))
    if not records.filter(~F.regexp_like("text", F.lit(rf"\A{_FIELD}(?:,{_FIELD})*+\z"))).isEmpty():
        return None
    return records.filter("text <> ''")
