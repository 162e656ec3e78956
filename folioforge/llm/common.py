"""Shared helpers of the training-data operators: tables, shared folders, bounded filters, skew-safe joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship
from ..storage import shared_dir, stored

__all__ = ["bloom_probe", "bloom_words", "components", "filter_bits", "join_back", "narrow", "shared_dir", "ship", "stored", "table"]

#: Largest Bloom filter in bits (16 MiB): the proven bound of every filter that is broadcast.
MAX_FILTER_BITS = 1 << 27
#: A key with more rows than 1/HOT_SHARE of its table is hot; at most HOT_SHARE keys can be.
HOT_SHARE = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame, columns: dict[str, T.DataType | str]) -> DataFrame:
    """Only the named columns, in order and cast; further columns of the input never clash."""
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()])


def filter_bits(n: int, per_key: int = 16) -> int:
    """Power of two of at least per_key bits a key, within [2**16, MAX_FILTER_BITS]."""
    return max(1 << 16, min(MAX_FILTER_BITS, 1 << (max(1, n) * per_key - 1).bit_length()))


def bloom_words(keys: DataFrame, cells: Sequence[Column], bits: int, least: int = 1) -> DataFrame:
    """Distributed Bloom filter as (word, mask) rows: the cells that at least `least` rows set.

    At most bits / 64 rows of 16 bytes, whatever the input: that is the bound under which it is broadcast.
    """
    cell = F.explode(F.array(*[F.pmod(c, F.lit(bits)).cast("long") for c in cells])).alias("cell")
    hit = keys.select(cell)
    if least > 1:
        hit = hit.groupBy("cell").count().filter(F.col("count") >= least)
    word = F.shiftright("cell", 6).alias("word")
    bit = F.expr("shiftleft(1L, cast(cell & 63 as int))")
    return hit.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("mask"))


def bloom_probe(df: DataFrame, words: DataFrame, cells: Sequence[Column], bits: int, out: str) -> DataFrame:
    """Adds boolean `out`: whether every cell of the row is set. Broadcast hash joins, no shuffle of df."""
    names = []
    for i, c in enumerate(cells):
        w, m, p = f"__w{i}", f"__m{i}", f"__p{i}"
        side = F.broadcast(words.select(F.col("word").alias(w), F.col("mask").alias(m)))
        df = df.withColumn(p, F.pmod(c, F.lit(bits)).cast("long"))
        df = df.join(side, F.shiftright(F.col(p), 6) == F.col(w), "left")
        names.append((w, m, p))
    test = F.lit(True)
    for _, m, p in names:
        test = test & F.coalesce(F.expr(f"getbit({m}, cast({p} & 63 as int)) = 1"), F.lit(False))
    return df.withColumn(out, test).drop(*[x for n in names for x in n])


def _hot_from(total: int) -> int:
    """Rows from which a group of a table of `total` rows is hot: at most HOT_SHARE groups of a large table are."""
    return max(256, total // HOT_SHARE)


def join_back(rows: DataFrame, groups: DataFrame, key: Sequence[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined with their group's one row, hot groups apart.

    A group of more than total / HOT_SHARE rows is hot, so at most HOT_SHARE groups are: they are
    broadcast under that bound, and rows of hot groups never meet in one task.
    """
    limit = _hot_from(total)
    hot = groups.filter(F.col(size) > limit)
    cold = groups.filter(F.col(size) <= limit)
    flag = hot.select(*key, *[F.col(c).alias(f"__h_{c}") for c in groups.columns if c not in key], F.lit(True).alias("__hot"))
    marked = rows.join(F.broadcast(flag), list(key), "left")
    extra = [c for c in groups.columns if c not in key]
    base = [F.col(c) for c in rows.columns]
    from_hot = marked.filter(F.col("__hot")).select(*base, *[F.col(f"__h_{c}").alias(c) for c in extra])
    rest = marked.filter(F.col("__hot").isNull()).select(*base)
    return from_hot.unionByName(rest.join(cold, list(key), how).select(*base, *extra))


def components(edges: DataFrame, rows: int | None = None, rounds: int = 60) -> DataFrame:
    """Connected components of (a long, b long) links: (id, component), the smallest id reachable. rows: a bound of links, if known.

    Alternating large-star and small-star steps on link tables; every round is stored in the shared folder,
    links only ever move between executors and nothing but their count, checksum and largest degree reaches the driver.
    Each step reduces by a partial minimum before it shuffles; in rounds with hot nodes these are joined apart.
    """
    links = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "links", rows)
    before = None
    for _ in range(rounds):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        degrees = both.groupBy("a").agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
        n, mark, most = degrees.agg(F.coalesce(F.sum("n"), F.lit(0)), F.sum("h"), F.coalesce(F.max("n"), F.lit(0))).first()
        if n == 0 or mark == before:
            break
        before = mark
        back = lambda rows, groups: join_back(rows, groups, ["a"], "n", n) if most > _hot_from(n) else rows.join(groups, "a")  # noqa: B023, E731
        low = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        large = back(both, low).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter("a > b").distinct(), "large", n)
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = back(large, least).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        links = stored(small.filter("a > b").distinct(), "links", n)
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    found = links.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component")
    return found.union(links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
