"""Numbers and running sums over ordered rows, without a task that sees all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import stored

#: Most rows of a table of totals that is broadcast; a larger one is joined by shuffles.
FEW = 100_000


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= FEW else df


def row_numbers(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Adds name, 0 for the first row in order.

    Rows are sorted over range partitions; each row's number is its place in its partition and the rows of those before. Only
    the partitions' counts, one row each, meet in one task.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    dealt = stored(dealt.withColumn("__part", F.shiftright("__at", 33)), "numbered")
    counts = dealt.groupBy("__part").agg(F.count("*").alias("c"))
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("__part", F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("__before"))
    place = F.col("__at") - F.shiftleft("__part", 33) + F.col("__before")
    return dealt.join(_small(before), "__part").withColumn(name, place).drop("__at", "__part", "__before")


def running_sums(df: DataFrame, block: str, at: str, sums: dict[str, Column]) -> DataFrame:
    """Adds, by name, the sum of a number over all earlier rows, those of earlier blocks and those before in the same one.

    Sums compose: a window over each block, and one over the blocks' totals, one row each. A block's rows have to fit a task.
    """
    own = df.withColumns({f"__{n}": c for n, c in sums.items()})
    totals = own.groupBy(block).agg(*[F.sum(f"__{n}").alias(f"__t_{n}") for n in sums])
    ahead = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(block, *[F.coalesce(F.sum(f"__t_{n}").over(ahead), F.lit(0)).alias(f"__b_{n}") for n in sums])
    inside = Window.partitionBy(block).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    own = own.join(_small(before), block)
    own = own.withColumns({n: F.coalesce(F.sum(f"__{n}").over(inside), F.lit(0)) + F.col(f"__b_{n}") for n in sums})
    return own.drop(*[f"__{n}" for n in sums], *[f"__b_{n}" for n in sums])
