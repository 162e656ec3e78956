"""Near-duplicate documents by an LSH forest of MinHash orders, confirmed on full shingle sets.

Each distinct shingle set has TREES orders: in each, the set's place is given by LEVELS MinHash values. All places of
all orders are sorted at once (range partitions, so no region of equal beginnings has to fit one task), and neighbours whose
longest common prefix has DEPTH values or more are candidates of each other. Sets with equal first DEPTH values lie
in a row, each with its neighbours' common prefix at least that long; so all of them are in one candidate component.

Candidate components are then confirmed exactly: their full shingle sets meet in one task each, which walks from set to
set and links by exact intersection sizes. A component heavier than MAX_BLOCK is confirmed in two rounds. The first takes
FIRST orders and in each region the shortest prefix, from DEPTH to LEVELS values, whose region fits a block; what is
denser than that is dealt into blocks that share the region's smallest set. The second is complete: of each DEPTH-value region
of each order that still holds several components, all pairs of sets of different ones meet, block by block. (Or those of the
whole candidate component at once, where that sends fewer copies of sets than its regions would.) Links join
up to components across tasks. So every pair of sets that shares DEPTH values is in one component or examined.

Two sets of similarity 0.75 miss each other in every order with probability (1 - 0.75**4)**32 = 5e-6.

Defined cases: a null text or one without words has an empty set, is linked with nothing and kept; a text of fewer
words than a shingle is one shingle; rows without doc_id are left out of links and returned as kept; rows that repeat
a doc_id are one document, whose sets are joined by that id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bloom_probe, bloom_words, components, filter_bits, join_back, narrow, ship, stored
from .textscan import U, mix, release, seeds, shingle_sets, slices

WIDTH = 5
TREES, DEPTH, LEVELS = 32, 4, 8
#: Most sets of one block; a set of more than LIGHT shingles counts as several, so that bytes are bounded too.
MAX_BLOCK, LIGHT = 2048, 2048
#: Orders of the first round of a heavy component.
FIRST = 2
#: Bytes of a place: the order's number, then two for each value.
PLACE = 1 + 2 * LEVELS
_FLIP, _TIMES = seeds(TREES * DEPTH, 41), seeds(TREES * DEPTH, 43) | U(1)
_MARK = seeds(2, 47) | U(1)

SIGNED = "row long, doc_id long, n_shingles long, set_a long, set_b long, places binary"


def signatures(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """MinHash values (rows of TREES * DEPTH) of sets that lie in a row; sizes are all positive."""
    start = np.cumsum(sizes) - sizes
    out = np.empty((len(sizes), TREES * DEPTH), np.uint64)
    work = np.empty_like(sets)
    for k in range(TREES * DEPTH):
        np.bitwise_xor(sets, _FLIP[k], out=work)
        np.multiply(work, _TIMES[k], out=work)
        out[:, k] = np.minimum.reduceat(work, start)
    return out


def places(sig: np.ndarray) -> np.ndarray:
    """Place of each set in each order, as bytes that sort like it: (rows, TREES, PLACE).

    An order's first DEPTH values are its own; those after them are the next orders'.
    """
    values = (mix(sig) & U(0xFFFF)).astype(">u2")
    at = (DEPTH * np.arange(TREES)[:, None] + np.arange(LEVELS)[None, :]) % (TREES * DEPTH)
    out = np.empty((len(sig), TREES, PLACE), np.uint8)
    out[:, :, 0] = np.arange(TREES)
    out[:, :, 1:] = np.ascontiguousarray(values[:, at]).view(np.uint8).reshape(len(sig), TREES, 2 * LEVELS)
    return out


def _marks(sets: np.ndarray, start: np.ndarray, k: int) -> np.ndarray:
    return np.add.reduceat(mix(sets * _MARK[k]), start)


def sign(docs: DataFrame) -> DataFrame:
    """One row per document: a row number, set size, a 128-bit mark of the set, and its places in all orders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n in slices(batch.column(2)):
                sets, sizes = shingle_sets(batch.column(2).slice(lo, n))
                full = np.flatnonzero(sizes)
                marks = np.zeros((n, 2), np.uint64)
                at = np.zeros(n + 1, np.int32)
                where = np.zeros((0, TREES, PLACE), np.uint8)
                if len(full):
                    start = np.cumsum(sizes[full]) - sizes[full]
                    for k in range(2):
                        marks[full, k] = _marks(sets, start, k)
                    where = places(signatures(sets, sizes[full]))
                    np.cumsum(np.where(sizes > 0, TREES * PLACE, 0), out=at[1:])
                packed = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at), pa.py_buffer(where.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), pa.array(sizes), pa.array(marks[:, 0].copy().view(np.int64)), pa.array(marks[:, 1].copy().view(np.int64)), packed],
                    names=["row", "doc_id", "n_shingles", "set_a", "set_b", "places"])

    own = narrow(docs, {"doc_id": "long", "text": "string"}).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return ship(own).mapInArrow(run, SIGNED)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (place, node): (a, b, null) of neighbours that share DEPTH values, and (a, a, place) of the partition's ends."""
    last: tuple[bytes, int] | None = None
    names = ["a", "b", "place"]
    kinds = (pa.int64(), pa.int64(), pa.binary())
    made = lambda *cols: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        node = batch.column(1).to_numpy()
        place = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(n, PLACE)
        if last is None:
            yield made([int(node[0])], [int(node[0])], [place[0].tobytes()])
        else:
            node, place = np.r_[last[1], node], np.r_[np.frombuffer(last[0], np.uint8)[None, :], place]
        near = np.flatnonzero((place[1:, :1 + 2 * DEPTH] == place[:-1, :1 + 2 * DEPTH]).all(axis=1))
        if len(near):
            yield made(node[near + 1], node[near], [None] * len(near))
        last = place[-1].tobytes(), int(node[-1])
    if last is not None:
        yield made([last[1]], [last[1]], [last[0]])


def _prefix(place: Column | str, values: int) -> Column:
    return F.substring(place, 1, 1 + 2 * values)


def _orders(nodes: DataFrame, orders: int = TREES) -> DataFrame:
    """(node, place) in each of the first orders."""
    each = F.transform(F.sequence(F.lit(0), F.lit(orders - 1)), lambda t: F.substring(F.col("places"), t * PLACE + 1, F.lit(PLACE)))
    return nodes.select("node", F.explode(each).alias("place"))


def candidate_links(nodes: DataFrame) -> DataFrame:
    """(a, b): neighbours in any of the orders whose longest common prefix has DEPTH values or more."""
    rows = _orders(nodes).select("place", "node").repartitionByRange("place", "node").sortWithinPartitions("place", "node")
    found = stored(rows.mapInArrow(_neighbours, "a long, b long, place binary"), "neighbours")
    # The ends of partitions, two rows each, are neighbours of each other.
    order = Window.orderBy("place", "a")
    ends = found.filter("place IS NOT NULL").select("place", "a", F.lag("a").over(order).alias("b"), F.lag("place").over(order).alias("other"))
    ends = ends.filter(_prefix("place", DEPTH) == _prefix("other", DEPTH)).select("a", "b")
    return found.filter("place IS NULL").select("a", "b").unionByName(ends)


def _sets(docs: DataFrame, wanted: DataFrame, n_wanted: int) -> DataFrame:
    """(comp, node, shingle set) of the wanted (comp, node, doc_id, set_a, set_b), recomputed from their texts; may repeat a node."""
    bits = filter_bits(n_wanted)
    own = narrow(docs, {"doc_id": "long", "text": "string"})
    own = bloom_probe(own, bloom_words(wanted, [F.xxhash64("doc_id")], bits), [F.xxhash64("doc_id")], bits, "maybe").filter("maybe").drop("maybe")
    own = own.join(wanted, "doc_id").select("comp", "node", "set_a", "set_b", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n in slices(batch.column(4)):
                sets, sizes = shingle_sets(batch.column(4).slice(lo, n))
                full = np.flatnonzero(sizes)
                at = np.r_[0, np.cumsum(sizes[full])]
                same = np.ones(len(full), bool)
                for k in range(2) if len(full) else ():
                    same &= _marks(sets, at[:-1], k).view(np.int64) == batch.column(2 + k).slice(lo, n).to_numpy()[full]
                keep = np.flatnonzero(same)
                rows = pa.array(full[keep])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n).take(rows), batch.column(1).slice(lo, n).take(rows), pa.array([sets[at[i]:at[i + 1]].tobytes() for i in keep], pa.binary())],
                    names=["comp", "node", "shingles"])

    return own.mapInArrow(run, "comp long, node long, shingles binary")


def linked(sets: list[np.ndarray], known: np.ndarray | None = None, share: int = 75) -> np.ndarray:
    """Number of the exact component of each set: 100 * intersection >= share * union links two.

    A walk from set to set; each step intersects one set with all that no walk has reached yet. Sets of one
    `known` label are linked already: a walk that reaches one reaches them all. Walks start at the rarest labels.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.concatenate([[0], np.cumsum(sizes)])
    root = np.full(n, -1)
    left = np.arange(n)
    known = left if known is None else np.unique(known, return_inverse=True)[1]
    left = left[np.argsort(np.bincount(known)[known], kind="stable")]
    flat, owner = codes, np.repeat(np.arange(n), sizes)
    flag = np.zeros(int(codes.max()) + 1, bool)
    todo: list[int] = []
    while len(left) or todo:
        if not todo:
            near = left[known[left] == known[left[0]]]
            root[near] = near[0]
            todo = near.tolist()
            gone = np.zeros(n, bool)
            gone[near] = True
            keep = ~gone[owner]
            flat, owner, left = flat[keep], owner[keep], left[~gone[left]]
        x = todo.pop()
        if not len(left):
            break
        own = codes[at[x]:at[x + 1]]
        flag[own] = True
        both = np.bincount(owner[flag[flat]], minlength=n)[left]
        flag[own] = False
        near = left[100 * both >= share * (sizes[left] + sizes[x] - both)]
        if len(near):
            near = left[np.isin(known[left], known[near])]
            root[near] = root[x]
            todo += near.tolist()
            gone = np.zeros(n, bool)
            gone[near] = True
            keep = ~gone[owner]
            flat, owner, left = flat[keep], owner[keep], left[~gone[left]]
    return root


def _confirm(pdf: pd.DataFrame) -> pd.DataFrame:
    release()
    pdf = pdf.drop_duplicates("node").sort_values("node")
    ids = pdf["node"].to_numpy(np.int64)
    root = linked([np.frombuffer(b, np.uint64) for b in pdf["shingles"]])
    own = np.flatnonzero(root != np.arange(len(ids)))
    return pd.DataFrame({"a": ids[own], "b": ids[root[own]]})


def _confirm_rest(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links between the labels of one task's sets."""
    pdf = pdf.drop_duplicates("node").sort_values("node")
    label = pdf["label"].to_numpy(np.int64)
    root = linked([np.frombuffer(b, np.uint64) for b in pdf["shingles"]], label)
    return pd.DataFrame({"a": label, "b": label[root]}).query("a != b").drop_duplicates()


def _blocks(nodes: DataFrame, total: int) -> DataFrame:
    """(node, block): in each of the first orders the shortest prefix whose region fits a block, or hashed parts of the longest."""
    levels = F.posexplode(F.array(*[_prefix("place", d) for d in range(DEPTH, LEVELS + 1)])).alias("level", "prefix")
    weights = nodes.select("node", "weight")
    rows = stored(_orders(nodes, FIRST).join(weights, "node").select("node", "weight", levels), "ladder", total * FIRST * (LEVELS - DEPTH + 1))
    sizes = rows.groupBy("prefix").agg(F.sum("weight").alias("n"), F.count("*").alias("c"), F.min("node").alias("low"))
    sized = join_back(rows, sizes, ["prefix"], "c", total * FIRST * (LEVELS - DEPTH + 1))
    wish = F.when(F.col("n") <= MAX_BLOCK, F.col("level")).otherwise(100 - F.col("level"))
    fit = sized.groupBy("node", F.substring("prefix", 1, 1).alias("order")).agg(F.min_by(F.struct("prefix", "n", "c", "low"), wish).alias("x"))
    fit = fit.select("node", "x.*").filter("c > 1")
    part = F.when(F.col("n") > MAX_BLOCK, F.pmod(F.xxhash64("node", "prefix"), F.ceil(F.col("n") / MAX_BLOCK))).otherwise(F.lit(0)).cast("int").alias("part")
    dealt = fit.select("node", "prefix", part, "low")
    shared = dealt.select(F.col("low").alias("node"), "prefix", "part", "low").distinct()  # each block holds its region's smallest set
    return dealt.union(shared).distinct().select("node", F.xxhash64("prefix", "part").alias("block"))


def _rest(nodes: DataFrame, links: DataFrame, total: int) -> DataFrame:
    """(task, node, label) under which every pair of a region whose labels differ meets in a task.

    A label is the component so far; regions of one label need no task, those that fit a block take one. In a heavier region,
    sets of its most frequent label are dealt apart from the others: tasks are all pairs of parts but those of that label alone.
    Where its regions overlap so much that they would take more copies of sets, the candidate component is one region.
    """
    half = max(1, MAX_BLOCK // 2)
    labels = components(links, total).withColumnRenamed("id", "node")
    own = nodes.join(labels, "node", "left").select("node", "comp", F.coalesce("component", "node").alias("label"), "weight")
    places = _orders(nodes).join(own, "node").select(*own.columns, _prefix("place", DEPTH).alias("key"), F.lit(False).alias("whole"))
    keys = stored(places.unionByName(own.select("*", F.encode(F.col("comp").cast("string"), "UTF-8").alias("key"), F.lit(True).alias("whole"))), "labelled", total * TREES)
    count = keys.groupBy("key", "whole", "comp", "label").agg(F.sum("weight").alias("n"), F.count("*").alias("c"))
    regions = count.groupBy("key", "whole", "comp").agg(F.sum("n").alias("n"), F.sum("c").alias("c"), F.count("*").alias("labels"), F.max(F.struct("n", "c", "label")).alias("top")).filter("labels > 1")
    few, many = F.ceil((F.col("n") - F.col("top.n")) / half), F.ceil(F.col("top.n") / half)
    regions = regions.select("key", "whole", "comp", "n", "c", F.col("top.label").alias("main"), F.col("top.c").alias("mains"), few.alias("few"), many.alias("many"))
    copies = F.when(F.col("n") <= MAX_BLOCK, F.col("c")).otherwise(F.col("mains") * F.col("few") + (F.col("c") - F.col("mains")) * (F.col("few") + F.col("many") - 1))
    regions = stored(regions.withColumn("copies", copies), "regions", total * TREES)
    cost = regions.groupBy("comp").agg(F.sum(F.when(F.col("whole"), F.col("copies"))).alias("once"), F.sum(F.when(~F.col("whole"), F.col("copies"))).alias("each"))
    cost = cost.select("comp", (F.col("once") < F.coalesce("each", F.lit(0))).alias("whole"))
    regions = stored(regions.join(cost, ["comp", "whole"]).drop("comp", "copies", "mains"), "chosen", total * TREES)
    rows = join_back(keys.drop("comp"), regions, ["key", "whole"], "c", total * TREES)
    deal, main, light = F.xxhash64("node", "key"), F.col("label") == F.col("main"), F.col("n") <= MAX_BLOCK
    rows = rows.withColumn("part", F.when(main, F.col("few") + F.pmod(deal, "many")).otherwise(F.pmod(deal, "few")))
    last = F.when(main, F.col("few")).otherwise(F.col("few") + F.col("many"))
    rows = rows.withColumn("other", F.explode(F.when(light, F.array(F.lit(-1).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), last - 1)))).filter("other <> part")
    pair = F.when(light, F.array(F.lit(-1).cast("long"))).otherwise(F.array(F.least("part", "other"), F.greatest("part", "other")))
    return rows.select(F.xxhash64("key", "whole", pair).alias("task"), "node", "label")


def _confirmed(docs: DataFrame, marked: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(a, b) links between the nodes of each candidate component."""
    weight = F.greatest(F.lit(1.0), F.col("n_shingles") / LIGHT)
    marked = marked.withColumn("weight", weight)
    size = stored(marked.groupBy("comp").agg(F.sum("weight").alias("n"), F.count("*").alias("c")), "sizes", n)
    sized = stored(join_back(marked, size, ["comp"], "c", n), "sized", n)
    wanted = ["comp", "node", "doc_id", "set_a", "set_b"]
    links = _sets(docs, sized.filter(F.col("n") <= MAX_BLOCK).select(*wanted), n).groupBy("comp").applyInPandas(_confirm, "a long, b long")
    n_large = size.filter(F.col("n") > MAX_BLOCK).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    if n_large:
        large = sized.filter(F.col("n") > MAX_BLOCK)
        shingles = stored(_sets(docs, large.select(*wanted), n_large).dropDuplicates(["node"]).select("node", "shingles"), "shingles", n_large, 2_000)
        own = stored(nodes.join(large.select("node", "comp", "weight"), "node").select("node", "comp", "weight", "places"), "heavy", n_large, 10_000)
        most = stored(_blocks(own, n_large).join(shingles, "node").groupBy("block").applyInPandas(_confirm, "a long, b long"), "most")
        rest = _rest(own, most, n_large).join(shingles, "node").groupBy("task").applyInPandas(_confirm_rest, "a long, b long")
        links = links.union(most).union(rest)
    return links


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row."""
    signed = stored(sign(docs), "signed")
    total = max(1, signed.count())
    full = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # Equal sets count once from here on: a node is a distinct set, named by the smallest row that has it.
    sets = ["set_a", "set_b"]
    own = ["row", "doc_id", "n_shingles", *sets, "maybe"]
    copies = stored(full.groupBy(*sets).agg(F.min("row").alias("node"), F.count("*").alias("n")).filter("n > 1"), "copies", total)
    bits = filter_bits(copies.count())
    cells = [F.col("set_a")]
    probed = bloom_probe(full, bloom_words(copies, cells, bits), cells, bits, "maybe")
    lone, some = probed.filter("NOT maybe"), probed.filter("maybe")
    copied = join_back(some.select(*own), copies, sets, "n", total, "left").select(*own, F.coalesce("node", "row").alias("node"))
    rows = stored(lone.select(*own, F.col("row").alias("node")).unionByName(copied), "rows", total)
    firsts = stored(rows.filter("maybe AND row = node").select("node"), "firsts", total)
    bits = filter_bits(firsts.count())
    held = bloom_probe(some.drop("maybe").withColumn("node", F.col("row")), bloom_words(firsts, [F.xxhash64("node")], bits), [F.xxhash64("node")], bits, "maybe")
    nodes = lone.select(F.col("row").alias("node"), "places").unionByName(held.filter("maybe").join(firsts, "node", "left_semi").select("node", "places"))

    candidates = components(candidate_links(nodes), total).select(F.col("id").alias("node"), F.col("component").alias("comp"))
    marked = stored(rows.filter("row = node").drop("row", "maybe").join(candidates, "node"), "candidates", total)
    n = marked.count()
    links = rows.select(F.col("node").alias("a"), F.col("node").alias("b")).filter("false")
    if n:
        links = _confirmed(docs, marked, nodes, n)
    ids = rows.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("top")).filter("b <> top").drop("top")
    links = links.union(rows.join(ids, "doc_id").filter("node <> b").select(F.col("node").alias("a"), "b"))

    # Rows of a set that has copies or links get the smallest id of their component; the others their own.
    joined = stored(components(links, total).select(F.col("id").alias("node"), "component"), "joined", total)
    bits = filter_bits(joined.count())
    linked_rows = bloom_probe(rows.drop(*sets), bloom_words(joined, [F.xxhash64("node")], bits), [F.xxhash64("node")], bits, "linked")
    grouped = linked_rows.filter("maybe OR linked")
    size = grouped.groupBy("node").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")).join(joined, "node", "left")
    size = stored(size.withColumn("component", F.coalesce("component", "node")), "sizes", total)
    lows = size.groupBy("component").agg(F.min("low").alias("component_id"), F.count("*").alias("c"))
    ends = stored(join_back(size.select("node", "n", "component"), lows, ["component"], "c", total).select("node", "n", "component_id"), "ends", total)
    found = join_back(grouped.select("node", "doc_id", "n_shingles"), ends, ["node"], "n", total).select("doc_id", "n_shingles", "component_id")
    self = F.col("doc_id").alias("component_id")
    rest = linked_rows.filter("NOT (maybe OR linked)").select("doc_id", "n_shingles", self)
    alone = signed.filter("NOT (n_shingles > 0 AND doc_id IS NOT NULL)").select("doc_id", "n_shingles", self)
    return found.unionByName(rest).unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
