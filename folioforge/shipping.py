"""Brings this package to the executors, whose Python workers import it, and bounds the batches that go to them."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
#: Largest Arrow batch between an executor and its Python workers: whole texts are long, and each side holds a few batches.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def ship(df: DataFrame) -> DataFrame:
    """The frame itself, after ship_session()."""
    ship_session(df.sparkSession)
    return df


def ship_session(spark: SparkSession) -> None:
    """Adds an archive of this package to the session's context, once, and bounds the session's batches."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "folioforge"), "zip", os.path.dirname(package), os.path.basename(package))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    for key, most in BATCHES.items():
        now = spark.conf.get(key).rstrip("b")
        if now.isdigit() and int(now) > most:
            spark.conf.set(key, most)
