"""Tables that a job writes for itself, in the shared folder that the cluster names, never on one machine's disk; and small inputs over all cores."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir.

    Only in a local session that names none, as in tests, a temporary folder is made and set; on a cluster without one this raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="folioforge-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/folioforge-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "t", rows: int | None = None, per_file: int = 50_000) -> DataFrame:
    """The frame written once as a table in the shared folder and read back: lineage ends here.

    rows: a bound of its rows, where one is known and they are short. A small table then fills few files, not one for each
    shuffle partition; a large one has as many as before.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    (df if rows is None else df.coalesce(1 + rows // per_file)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The frame dealt over all cores, if its files make fewer tasks than there are cores, as a file of one row group does."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.rdd().getNumPartitions() < cores else df
