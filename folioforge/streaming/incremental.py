"""Incremental runs: arriving page files are cleaned and kept by key, each batch once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.pages import clean_pages, with_page_numbers
from ..schemas import PAGE
from ..sources.readers import exists
from ..storage import stored


def stream_pages(spark: SparkSession, folder: str, schema: str = PAGE) -> DataFrame:
    """Cleaned pages of JSON lines files as they arrive."""
    return clean_pages(with_page_numbers(spark.readStream.schema(schema).json(folder)))


def keep_latest(stream: DataFrame, table: str, checkpoint: str, key: str, order: str, *, parts: int = 64, once: bool = True) -> StreamingQuery:
    """Each micro-batch replaces the rows of its keys in a table of `parts` parts by the key's hash.

    Of several rows of a key the one with the largest `order` stays, also against rows that the table already holds, so a
    batch that is run again changes nothing. Only the parts that the batch touches are read and written.
    """

    def put(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        columns = batch.columns
        fresh = batch.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
        if exists(spark, table):
            touched = F.broadcast(fresh.select("part").distinct())  # at most `parts` rows
            old = spark.read.schema(fresh.schema).parquet(table).join(touched, "part", "left_semi")
            fresh = fresh.unionByName(old)
        best = F.max_by(F.struct(*columns), F.struct(order, F.xxhash64(*columns)))
        latest = stored(fresh.groupBy("part", key).agg(best.alias("x")).select("x.*", "part"), "latest")
        latest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(table)

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
