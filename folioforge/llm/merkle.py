"""A Merkle manifest of a table: digests of rows, one tree of arity 8 for each group, a tree over the groups, and a proof for each row.

Digests of rows are made in the JVM. They are sorted by range, numbered without any task seeing a whole group, and cut into
aligned blocks of ARITY**HEIGHT leaves. A first pass reduces each block to its root by a treehash stack; the roots are the
leaves of the next layer, until each group has one. Proofs go the other way: from the top layer down, each block's task
walks its leaves in order while treehash stacks, one for each level, prepare the next run of siblings (a level's stack takes
one leaf a step and is done when its run begins). Besides the block's digests that keeps O(ARITY * HEIGHT**2) digests,
whatever the table's size. Upper paths are the same for all leaves of a block and arrive as one row for each.

Defined cases: a null group is one of its own and comes first; rows without an order value come first in their group; rows that
repeat it stand in the order of their digests, so the result doesn't depend on the input's order; a lone leaf is its group's root, a
lone group's root is the root; an empty table gives an empty result; columns that aren't named are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored

ARITY, HEIGHT = 8, 4
#: Most rows of the table of groups' places in partitions that is broadcast; a larger one is joined by shuffles.
FEW = 100_000
PATH = "array<struct<at:int,run:array<string>>>"
_KEY = ["tree", "block"]


def digest(parts: Sequence[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels between n leaves and their root."""
    levels = 0
    while n > 1:
        n = -(-n // ARITY)
        levels += 1
    return levels


class Treehash:
    """A stack of open runs, one for each level below `levels`; leaves are pushed one by one."""

    def __init__(self, levels: int):
        self.open: list[list[str]] = [[] for _ in range(levels + 1)]
        self.first: list[list[str]] = [[] for _ in range(levels)]

    def push(self, node: str, level: int = 0) -> None:
        while True:
            run = self.open[level]
            run.append(node)
            if level + 1 == len(self.open) or len(run) < ARITY:
                return
            node, level = self._close(level), level + 1

    def _close(self, level: int) -> str:
        run, self.open[level] = self.open[level], []
        if not self.first[level]:
            self.first[level] = run
        return digest(run)

    def finish(self) -> list[str]:
        """The nodes of the highest level, after the runs that are not full are closed."""
        for level in range(len(self.open) - 1):
            if self.open[level]:
                self.push(self._close(level), level + 1)
        return self.open[-1]


def block_root(leaves: Sequence[str], levels: int) -> str:
    stack = Treehash(levels)
    for leaf in leaves:
        stack.push(leaf)
    return stack.finish()[0]


def paths(leaves: Sequence[str], levels: int) -> Iterator[list[list[str]]]:
    """For each leaf of a block in order its runs, from the lowest level up; a run holds the leaf's own node too.

    The lists change as the walk goes on.
    """
    whole = Treehash(levels)
    for leaf in leaves:
        whole.push(leaf)
    whole.finish()
    now = whole.first
    ahead = [Treehash(h) for h in range(levels - 1)]
    for i in range(len(leaves)):
        yield now
        for h in range(levels - 1):
            width = ARITY ** (h + 1)
            if i + width < len(leaves):
                ahead[h].push(leaves[i + width])
            if (i + 1) % width == 0:
                now[h] = ahead[h].finish()
                ahead[h] = Treehash(h)


def row_digest(columns: Sequence[str], instead: dict[str, Column] | None = None) -> Column:
    """SHA-256 of the columns, each `-` if null, else its UTF-8 byte count, `:` and itself; `instead` replaces some."""

    def part(c: str) -> Column:
        value = (instead or {}).get(c, F.col(f"`{c}`")).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.encode(F.concat(*map(part, columns)), "UTF-8"), 256)


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds pos, from 0 in each tree by the order, and n, the rows of the tree.

    Range partitions hold rows in order; what a tree has in partitions before gives the rest, so a tree may be of any size.
    """
    spread = rows.withColumn("__any", F.monotonically_increasing_id())
    key = ["tree", *order, "__any"]
    dealt = spread.repartitionByRange(*key).sortWithinPartitions(*key).drop("__any").withColumn("__at", F.monotonically_increasing_id())
    dealt = stored(dealt.withColumn("__part", F.shiftright("__at", 33)), "dealt")
    counts = dealt.groupBy("tree", "__part").agg(F.count("*").alias("c"), F.min("__at").alias("low"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("c").over(tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = stored(counts.select("tree", "__part", (before - F.col("low")).alias("shift"), F.sum("c").over(tree).alias("n")), "shifts")
    if shifts.count() <= FEW:
        shifts = F.broadcast(shifts)
    return dealt.join(shifts, ["tree", "__part"]).withColumn("pos", F.col("__at") + F.col("shift")).drop("__at", "__part", "shift")


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {ARITY**levels}"))


def _in_order(pdf: pd.DataFrame, most: int) -> tuple[pd.DataFrame, int]:
    """The block's leaves by position, and the levels between them and the block's root, `most` but in the last layer."""
    return pdf.sort_values("pos"), min(most, height(int(pdf["n"].iloc[0])))


def lifted(nodes: DataFrame, most: int) -> DataFrame:
    """The next layer: roots of blocks as (tree, pos, n, digest)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, levels = _in_order(pdf, most)
        n = -(-int(pdf["n"].iloc[0]) // ARITY**most)
        return pd.DataFrame({"tree": pdf["tree"].iloc[:1], "pos": pdf["block"].iloc[:1], "n": n, "digest": block_root(pdf["digest"].tolist(), levels)})

    return _blocks(ship(nodes).select("tree", "pos", "n", "digest"), most).groupBy(*_KEY).applyInPandas(run, "tree string, pos long, n long, digest string")


def _layers(nodes: DataFrame, most: int) -> list[DataFrame]:
    """The nodes, then layers up to that whose trees have one node each."""
    layers = [nodes]
    while len(layers) == 1 or (layers[-1].agg(F.max("n")).first()[0] or 0) > 1:
        layers.append(stored(lifted(layers[-1], most), "layer"))
    return layers


def _with_upper(nodes: DataFrame, upper: DataFrame, most: int, run: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Each block of nodes with the one row of its root."""
    above = upper.withColumnRenamed("pos", "block")
    return _blocks(ship(nodes), most).groupBy(*_KEY).cogroup(above.groupBy(*_KEY)).applyInPandas(run, schema)


def _placed(own: list[list[str]], i: int, above: list) -> list[dict]:
    return [*({"at": i // ARITY**h % ARITY, "run": list(run)} for h, run in enumerate(own)), *above]


_UPPER = f"tree string, pos long, subroot string, root string, path {PATH}"


def _down(layer: DataFrame, upper: DataFrame, most: int) -> DataFrame:
    """Paths of a layer's nodes from those of their blocks' roots."""

    def run(pdf: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        pdf, levels = _in_order(pdf, most)
        above = [{"at": int(p["at"]), "run": list(p["run"])} for p in top["path"].iloc[0]]
        own = [_placed(p, i, above) for i, p in enumerate(paths(pdf["digest"].tolist(), levels))]
        return pd.DataFrame({"tree": pdf["tree"].to_numpy(), "pos": pdf["pos"].to_numpy(), "subroot": top["subroot"].iloc[0], "root": top["root"].iloc[0], "path": own})

    return _with_upper(layer, upper, most, run, _UPPER)


def _tops(subroots: DataFrame, most: int) -> DataFrame:
    """(tree, pos = 0, subroot, root, path) of each tree's root in the tree over all of them."""
    one = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("own"), "digest"), ["own"])
    layers = _layers(stored(one, "subroots"), most)
    upper = layers[-1].select("tree", "pos", F.col("digest").alias("subroot"), F.col("digest").alias("root"), F.array().cast(PATH).alias("path"))
    for layer in reversed(layers[:-1]):
        upper = stored(_down(layer, upper, most), "upper")
    ends = upper.select("pos", "root", "path")
    return layers[0].join(ends, "pos").select(F.col("own").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"), "root", "path")


def proofs(leaves: DataFrame, order: Sequence[str], most: int = HEIGHT) -> DataFrame:
    """For (tree, digest, changed, ...) the paths, roots and what a changed digest folds to.

    Instead of the columns of order it has subroot, root, proof_sha256 (the digest of all siblings from the leaf up, left to right), folded_root (from changed, or from
    digest where that is null) and verified. tree is a string that sorts as the groups do. most: levels of a block.
    """
    carried = [c for c in leaves.columns if c not in ("tree", "digest", "changed", *order)]
    nodes = stored(numbered(leaves, order).drop(*[c for c in order if c != "digest"]), "leaves")
    layers = _layers(nodes, most)
    upper = stored(_tops(layers[-1], most), "tops")
    for layer in reversed(layers[1:-1]):
        upper = stored(_down(layer, upper, most), "upper")
    kinds = ", ".join(f"`{c}` {nodes.schema[c].dataType.simpleString()}" for c in carried)

    def run(pdf: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        pdf, levels = _in_order(pdf, most)
        subroot, root = top["subroot"].iloc[0], top["root"].iloc[0]
        above = [(int(p["at"]), list(p["run"])) for p in top["path"].iloc[0]]
        shared = "".join("".join(run[:at] + run[at + 1:]) for at, run in above).encode()
        known: dict[str, str] = {}

        def to_root(node: str) -> str:
            if node not in known:
                known.clear()
                up = node
                for at, run in above:
                    up = digest([*run[:at], up, *run[at + 1:]])
                known[node] = up
            return known[node]

        sealed, folded = [], []
        original = pdf["digest"].tolist()
        for i, (own, changed) in enumerate(zip(paths(original, levels), pdf["changed"].tolist(), strict=True)):
            others, node, at = [], changed or original[i], i
            for run in own:
                k = at % ARITY
                left, right = run[:k], run[k + 1:]
                others += left + right
                node = digest([*left, node, *right])
                at //= ARITY
            sealed.append(sha256("".join(others).encode() + shared).hexdigest())
            folded.append(to_root(node))
        out = pdf[carried].copy()
        out["digest"] = original
        out["subroot"], out["root"], out["proof_sha256"], out["folded_root"] = subroot, root, sealed, folded
        out["verified"] = [f == root for f in folded]
        return out

    made = f"{kinds}{', ' if kinds else ''}digest string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _with_upper(nodes, upper, most, run, made)


def manifest(docs: DataFrame, columns: Sequence[str], tree: str, order: str, tampered: Column | None = None, instead: dict[str, Column] | None = None, most: int = HEIGHT) -> DataFrame:
    """(order, leaf, subroot, root, proof_sha256, folded_root, verified) of each row.

    Rows where `tampered` holds are verified with the columns of `instead` replaced, all others as they are.
    """
    kind = docs.schema[order].dataType
    changed = F.lit(None).cast("string")
    if tampered is not None:
        changed = F.when(tampered, row_digest(columns, instead))
    group = F.col(f"`{tree}`").cast("string")
    own = docs.select(F.coalesce(F.concat(F.lit("1"), group), F.lit("0")).alias("tree"), F.col(f"`{order}`").alias("key"), F.col(f"`{order}`").cast("string").alias("id"), row_digest(columns).alias("digest"), changed.alias("changed"))
    found = proofs(stored(own, "digests"), ["key", "digest"], most)
    return found.select(F.col("id").cast(kind).alias(order), F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", "verified")
