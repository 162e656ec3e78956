"""Exact Jaccard self-join of documents on word shingles, by a token-group matrix.

1. Equal sets count once. 2. Similar sets are put into groups: in each of ORDERS orders of MinHash values, sets with an equal
first value lie in a row that is cut into bounded pieces; the exact links inside the pieces make components, and components are cut
into groups of sets of like size. A group is all of one component, so pairs inside it need no look. Sets without a link
so far that share two MinHash values with many others make groups too: these hold several components, so pairs inside them are compared. 3. The matrix
of tokens and groups holds for each group the union of its sets' prefixes: the first n - ceil(share * n) + 1 tokens of a set in an order
of all tokens, rare ones first, of which two linked sets always share one. Pairs of groups of different components that
share tokens there are kept if the number of them, with all that may follow the prefixes, reaches the overlap that their
sizes ask for. 4. What is left meets as groups: the union of a group's tokens and a bit row for each set. The overlap of a set
with the other group's union bounds its overlap with each set there; only sets that reach the bound are opened, by
one product of the bit rows.

No link is lost: orders and groups decide only how much is opened. Shingles are told apart by 64-bit hashes.

Tokens in many documents come last in the order, by counts over all documents: the most frequent ones, at most HOT, are sent to all
tasks. Prefixes are a fifth of a set, so a hash range of COUNTED of all tokens is counted, and tokens outside of it stand between its rare and
its frequent ones. If that doesn't settle all frequent tokens, those of more than LIMIT groups are dealt into parts and only pairs
that could have that token as their first common one are made. Sets of one piece or group are bounded by number and size;
pairs that meet one group in many rows are dealt over copies of it.

Defined cases: a null text or one without words has an empty set, linked with nothing; a text of fewer words than a
shingle is one shingle; rows without doc_id are in no link, and have no component_id; rows that repeat a doc_id are one document, whose
sets are joined by that id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bloom_probe, bloom_words, components, filter_bits, join_back, narrow, ship, stored
from .near_dedup import linked
from .textscan import U, mix, release, seeds, shingle_sets, slices

ORDERS = 3
#: Most sets of a piece or group, and shingles from which on a set takes the place of several.
GROUP, LIGHT = 64, 2048
#: Sets without links with two equal MinHash values from which on they make groups; and the values of which two are taken.
FEWEST, VALUES = 16, 4
#: Most tokens whose frequency is known to all tasks (8 bytes each, and one for its class), and the least such frequency.
HOT, RARE = 1 << 19, 16
#: The share of the tokens, by their hashes, that is counted.
COUNTED = 0.4
#: Groups of one token from which on it is dealt into parts; pairs with one group from which on it is copied.
LIMIT = 64
#: Tokens by which a pair's first common one is told from later ones; beyond it a pair may be made more than once.
EARLIER = 32
_FLIP, _TIMES = seeds(ORDERS + 2, 61), seeds(ORDERS + 2, 67) | U(1)
_MARK = seeds(2, 71) | U(1)
#: Groups that a task handles before it gives free memory back, which takes about as long as a small group.
_OFTEN = 200
SET = ["set_a", "set_b"]
_ID = "doc_id long, set_a long, set_b long"


_handled = itertools.count(1)


def _tidy() -> None:
    if next(_handled) % _OFTEN == 0:
        release()


def least_overlap(n: np.ndarray, share: int) -> np.ndarray:
    """Smallest overlap of a set of n with any set that it links: ceil(share * n / 100)."""
    return -(-n * share // 100)


def _marks(sets: np.ndarray, start: np.ndarray) -> np.ndarray:
    """128-bit marks of sets that lie in a row."""
    return np.stack([np.add.reduceat(mix(sets * _MARK[k]), start) for k in range(2)]).view(np.int64)


def _signed(docs: DataFrame) -> DataFrame:
    """One row per document: a row number, set size, the mark of the set, its MinHash values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n in slices(batch.column(2)):
                sets, sizes = shingle_sets(batch.column(2).slice(lo, n))
                full = np.flatnonzero(sizes)
                marks, mins = np.zeros((2, n), np.int64), np.zeros((n, ORDERS + 2), np.uint64)
                if len(full):
                    start = np.cumsum(sizes[full]) - sizes[full]
                    marks[:, full] = _marks(sets, start)
                    for k in range(ORDERS + 2):
                        mins[full, k] = np.minimum.reduceat((sets ^ _FLIP[k]) * _TIMES[k], start)
                listed = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * (ORDERS + 2)), pa.array(mins.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), pa.array(sizes), pa.array(marks[0]), pa.array(marks[1]), listed],
                    names=["row", "doc_id", "n_shingles", *SET, "mins"])

    own = narrow(docs, {"doc_id": "long", "text": "string"}).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return ship(own).mapInArrow(run, "row long, doc_id long, n_shingles long, set_a long, set_b long, mins array<long>")


def _scan(docs: DataFrame, make: Callable, schema: str, by_id: bool = True) -> DataFrame:
    """make(ids, marks, sets, at) of the sets of each slice; a task makes a set once, or once for each doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            for lo, n in slices(batch.column(1)):
                sets, sizes = shingle_sets(batch.column(1).slice(lo, n))
                full = np.flatnonzero(sizes)
                if not len(full):
                    continue
                at = np.r_[0, np.cumsum(sizes[full])]
                marks = _marks(sets, at[:-1])
                ids = batch.column(0).slice(lo, n).to_numpy()[full]
                keep = []
                for k, key in enumerate(zip(ids.tolist() if by_id else [0] * len(full), *marks.tolist(), strict=True)):
                    if key not in seen:
                        seen.add(key)
                        keep.append(k)
                if not keep:
                    continue
                if len(keep) < len(full):
                    sets = np.concatenate([sets[at[k]:at[k + 1]] for k in keep])
                    at = np.r_[0, np.cumsum(np.diff(at)[keep])]
                    ids, marks = ids[keep], marks[:, keep]
                yield make(ids, marks, sets, at)

    own = narrow(docs, {"doc_id": "long", "text": "string"}).filter("doc_id IS NOT NULL")
    return ship(own).mapInArrow(run, schema)


def _key_bits(total: int) -> int:
    """Bits of a token's bucket in a table of so many documents; 32 more make its key."""
    return max(3, min(16, (total // 4000).bit_length()))


_BUCKETS = "bucket int, low binary, n binary"


def _in_buckets(tokens: np.ndarray, bits: int) -> pa.RecordBatch:
    """Tokens by the first bits, each with the next 32 bits and how often they occur: 4 bytes a token, and little more after compression."""
    key, n = np.unique(tokens >> U(32 - bits), return_counts=True)
    bucket = (key >> U(32)).astype(np.int32)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(key) else np.zeros(0, int)
    ends = pa.py_buffer((np.r_[first, len(key)] * 4).astype(np.int32))
    lists = [pa.Array.from_buffers(pa.binary(), len(first), [None, ends, pa.py_buffer(x.astype(np.uint32).tobytes())]) for x in (key & U(0xFFFFFFFF), n)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), *lists], names=["bucket", "low", "n"])


def _often(buckets: DataFrame, least: int) -> DataFrame:
    """(token, n): the keys of tokens that occur at least so often."""

    def run(rows: pa.Table) -> pa.Table:
        _tidy()
        low, n = (np.frombuffer(b"".join(rows[c].to_pylist()), np.uint32) for c in ("low", "n"))
        key, at = np.unique(low, return_inverse=True)
        total = np.bincount(at, weights=n).astype(np.int64)
        many = total >= least
        return pa.table({"token": (rows["bucket"][0].as_py() << 32) + key[many].astype(np.int64), "n": total[many]})

    return buckets.groupBy("bucket").applyInArrow(run, "token long, n long")


def _frequent(docs: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the most frequent of the counted tokens of all documents, sorted, and their classes (from 2, by doubling); at most HOT."""
    below = U(int(COUNTED * 2**64))

    def tokens(ids: np.ndarray, marks: np.ndarray, sets: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        return _in_buckets(sets[sets < below], bits)

    counts = _often(_scan(docs, tokens, _BUCKETS, by_id=False), RARE)
    counts = stored(counts.withColumn("level", F.floor(F.log2("n")).cast("int")), "frequent")
    by_level = dict(counts.groupBy("level").count().collect())  # a row for each doubling
    least, n = 64, 0
    while least and n + by_level.get(least - 1, 0) <= HOT:
        least -= 1
        n += by_level.get(least, 0)
    rows = counts.filter(F.col("level") >= least).select("token", "level").toPandas()  # at most HOT
    token = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(token)
    return token[order], (rows["level"].to_numpy(np.uint8) - least + 2 if len(rows) else np.zeros(0, np.uint8))[order]


def _prefixes(docs: DataFrame, share: int, bits: int) -> DataFrame:
    """(doc_id, set_a, set_b, prefix) of each set: its rarest tokens."""
    token, level = _frequent(docs, bits)
    below = U(int(COUNTED * 2**64))
    some = np.zeros(1 << 20, bool)
    some[token & U((1 << 20) - 1)] = True
    known = docs.sparkSession.sparkContext.broadcast((token, level, some))

    def make(ids: np.ndarray, marks: np.ndarray, sets: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        token, level, some = known.value
        rank = (sets >= below).astype(np.uint8)  # 0 for rare tokens, 1 for those not counted, more for frequent ones
        keys = sets >> U(32 - bits)
        maybe = np.flatnonzero(some[keys & U((1 << 20) - 1)])
        if len(maybe):
            found = np.minimum(np.searchsorted(token, keys[maybe]), len(token) - 1)
            same = token[found] == keys[maybe]
            rank[maybe[same]] = level[found[same]]
        n = np.diff(at)
        wide = n - least_overlap(n, share) + 1
        hot = np.add.reduceat(rank > 1, at[:-1]) > 0
        parts = []
        for k in range(len(n)):
            own = sets[at[k]:at[k + 1]]
            parts.append(own[np.argsort(rank[at[k]:at[k + 1]], kind="stable")[:wide[k]]] if hot[k] else own[:wide[k]])
        listed = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(wide)].astype(np.int32)), pa.array(np.concatenate(parts).view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(marks[0]), pa.array(marks[1]), listed], names=["doc_id", *SET, "prefix"])

    return _scan(docs, make, f"{_ID}, prefix array<long>")


def _full_sets(docs: DataFrame, wanted: DataFrame, n_wanted: int) -> DataFrame:
    """The rows of wanted (doc_id, set_a, set_b, ...) with their set's shingles; may repeat a row."""
    bits = filter_bits(n_wanted)
    own = narrow(docs, {"doc_id": "long", "text": "string"})
    own = bloom_probe(own, bloom_words(wanted, [F.xxhash64("doc_id")], bits), [F.xxhash64("doc_id")], bits, "maybe").filter("maybe").drop("maybe")

    def make(ids: np.ndarray, marks: np.ndarray, sets: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        packed = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer((at * 8).astype(np.int32)), pa.py_buffer(sets.tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(marks[0]), pa.array(marks[1]), packed], names=["doc_id", *SET, "shingles"])

    return _scan(own, make, f"{_ID}, shingles binary").join(wanted, ["doc_id", *SET])


def _pieces(rows: DataFrame, run: list[str], order: list[str], name: str) -> DataFrame:
    """Adds piece: rows of equal run columns, in order, cut into pieces of at most GROUP; fewer where sets are large.

    Rows are sorted over range partitions and cut by their place there, so a run may be of any length.
    """
    heavy = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n_shingles") / LIGHT))).cast("int")
    key = [*run, "__heavy", *order]
    dealt = rows.withColumn("__heavy", heavy).repartitionByRange(*key).sortWithinPartitions(*key).withColumn("__at", F.monotonically_increasing_id())
    wide = F.greatest(F.lit(2), F.expr(f"shiftright({GROUP}, __heavy)"))
    return stored(dealt.withColumn("piece", F.xxhash64(*run, "__heavy", F.floor(F.col("__at") / wide).cast("long"))).drop("__at", "__heavy"), name)


def _of_nodes(rows: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """Nodes in order and their sets, each once."""
    _tidy()
    ids, first = np.unique(rows["node"].to_numpy(), return_index=True)
    shingles = rows["shingles"]
    return ids, [np.frombuffer(shingles[int(k)].as_py(), np.uint64) for k in first]


def _links_in(pieces: DataFrame, share: int) -> DataFrame:
    """(a, b) links of the sets of each piece that join it up; pieces are (piece, node, shingles)."""

    def run(piece: pa.Table) -> pa.Table:
        ids, sets = _of_nodes(piece)
        root = linked(sets, share=share) if len(ids) > 1 else np.zeros(1, int)
        own = np.flatnonzero(root != np.arange(len(ids)))
        return pa.table({"a": ids[own], "b": ids[root[own]]})

    return pieces.groupBy("piece").applyInArrow(run, "a long, b long")


def _rough_links(docs: DataFrame, nodes: DataFrame, total: int, share: int) -> DataFrame:
    """Exact links inside pieces of sets with an equal MinHash value."""
    value = lambda k: F.get("mins", F.col("k") + k)
    rows = nodes.withColumn("k", F.explode(F.array(*map(F.lit, range(ORDERS))))).select("node", "n_shingles", "k", *[value(i).alias(f"m{i}") for i in range(3)])
    dealt = _pieces(rows, ["k", "m0"], ["m1", "m2", "node"], "rough").select("piece", "node", "k")
    # A piece that lies inside one of an earlier order has no new pair.
    before = dealt.groupBy("node").agg(*[F.max(F.when(F.col("k") == j, F.col("piece"))).alias(f"p{j}") for j in range(ORDERS - 1)])
    inside = F.lit(False)
    for j in range(ORDERS - 1):
        inside = inside | ((F.min("k") > j) & (F.min(f"p{j}") == F.max(f"p{j}")))
    some = dealt.join(before, "node").groupBy("piece").agg(F.count("*").alias("n"), inside.alias("inside")).filter("n > 1 AND NOT inside").select("piece")
    by_node = dealt.join(some, "piece", "left_semi").groupBy("node").agg(F.collect_list("piece").alias("pieces"))  # at most ORDERS
    wanted = stored(nodes.join(by_node, "node").select("doc_id", *SET, "node", "pieces"), "wanted", total)
    sets = _full_sets(docs, wanted, wanted.count()).select(F.explode("pieces").alias("piece"), "node", "shingles")
    return _links_in(sets, share)


def _alike(alone: DataFrame, total: int) -> DataFrame:
    """Nodes without links with gid, those that share two MinHash values with many others in groups; comp is the node's or such a group's own."""
    two = [F.xxhash64(F.lit(i), F.lit(j), F.get("mins", F.lit(i)), F.get("mins", F.lit(j))) for i, j in itertools.combinations(range(VALUES), 2)]
    cells = alone.select("node", F.explode(F.array(*two)).alias("cell"))
    many = cells.groupBy("cell").agg(F.count("*").alias("c")).filter(F.col("c") >= FEWEST)
    best = cells.join(many, "cell").groupBy("node").agg(F.max(F.struct("c", "cell")).alias("best")).select("node", "best.cell")
    own = stored(alone.drop("mins").join(best, "node", "left"), "alone", total)
    some = _pieces(own.filter("cell IS NOT NULL"), ["cell"], ["n_shingles", "node"], "alike").withColumn("gid", F.expr("-1 - (piece & 9223372036854775807)"))
    rest = own.filter("cell IS NULL").withColumn("gid", F.col("node"))
    return some.drop("piece", "cell").unionByName(rest.drop("cell")).withColumn("comp", F.col("gid"))


def _groups(nodes: DataFrame, links: DataFrame, total: int) -> DataFrame:
    """nodes with comp and gid, their component so far and their group in it, and the group's smallest and largest sets, lo and hi.

    A group of sets of several components stands for a component of its own, with a comp below 0.
    """
    found = components(links, total).select(F.col("id").alias("node"), F.col("component").alias("comp"))
    own = stored(nodes.select("node", "doc_id", *SET, "n_shingles", "mins").join(found, "node", "left"), "components", total)
    alone = _alike(own.filter("comp IS NULL").drop("comp"), total)
    own = own.drop("mins")
    many = _pieces(own.filter("comp IS NOT NULL"), ["comp"], ["n_shingles", "node"], "grouped").withColumn("gid", F.expr("-1 - (piece & 9223372036854775807)")).drop("piece")
    many = stored(many.unionByName(alone.filter("gid < 0")), "many", total)
    size = many.groupBy("gid").agg(F.min("n_shingles").alias("lo"), F.max("n_shingles").alias("hi"))
    n = F.col("n_shingles")
    return stored(many.join(size, "gid").unionByName(alone.filter("gid >= 0").withColumns({"lo": n, "hi": n})), "groups", total)


def _matrix(docs: DataFrame, groups: DataFrame, share: int, total: int) -> DataFrame:
    """(token, gid, comp, lo, hi, pos, n): tokens in prefixes of groups of several components; n counts the token's groups."""
    bits = _key_bits(total)
    listed = stored(_prefixes(docs, share, bits).join(groups, ["doc_id", *SET]).select("gid", "comp", "lo", "hi", "prefix"), "prefixes")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _in_buckets(batch.column(0).flatten().to_numpy().view(np.uint64), bits)

    # Most tokens are in one prefix only: those whose key isn't repeated go first, by 4 bytes each.
    again = stored(_often(listed.select("prefix").mapInArrow(keys, _BUCKETS), 2).select("token"), "again")
    short = F.xxhash64(F.shiftrightunsigned("token", 32 - bits))
    wide = filter_bits(again.count())
    own = listed.select("gid", "comp", "lo", "hi", F.posexplode("prefix").alias("pos", "token"))
    own = stored(bloom_probe(own, bloom_words(again, [F.xxhash64("token")], wide), [short], wide, "maybe").filter("maybe").drop("maybe"), "repeated")
    key = ["token", "gid", "comp", "lo", "hi"]
    own = own.filter("gid >= 0").unionByName(own.filter("gid < 0").groupBy(*key).agg(F.min("pos").alias("pos")))
    shared = own.groupBy("token").agg(F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("token", "n")
    shared = stored(shared, "shared")
    bits = filter_bits(shared.count())
    maybe = bloom_probe(own, bloom_words(shared, [F.xxhash64("token")], bits), [F.xxhash64("token")], bits, "maybe").filter("maybe").drop("maybe")
    return stored(maybe.join(shared, "token"), "matrix")


def _need(a: str, b: str, share: int) -> Column:
    """Smallest overlap of linked sets of sizes a and b: share / (100 + share) of their sum."""
    return F.ceil(F.lit(share) * (F.col(a) + F.col(b)) / (100 + share))


def _after(hi: str, share: int) -> Column:
    """Tokens after the prefix of the largest set."""
    return F.ceil(F.lit(share) * F.col(hi) / 100) - 1


def _with_earlier(many: DataFrame) -> DataFrame:
    """Adds earlier to the tokens of many groups: those of them before it in a lone set's prefix, EARLIER at most, none in other groups.

    A pair of lone sets without a common earlier token has this one as its first, so it is made once and not for each common token.
    """
    key = ["gid", "comp", "lo", "hi"]
    listed = many.filter("gid >= 0").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("pos", "token", "n"))).alias("own"))
    lone = listed.select(*key, "own", F.posexplode("own").alias("at", "x"))
    lone = lone.select(*key, "x.pos", "x.token", "x.n", F.transform(F.slice("own", 1, F.least(F.col("at"), F.lit(EARLIER))), lambda x: x["token"]).alias("earlier"))
    return lone.unionByName(many.filter("gid < 0").withColumn("earlier", F.array().cast("array<long>")))


def candidate_pairs(matrix: DataFrame, share: int) -> DataFrame:
    """(ga, gb): pairs of groups of different components whose shared prefix tokens leave a link possible."""
    side = lambda df, x: df.select("token", *[c for c in ("part",) if c in df.columns], *[F.col(c).alias(c + x) for c in ("gid", "comp", "lo", "hi", "pos", "earlier") if c in df.columns])
    fits = (100 * F.col("hia") >= share * F.col("lob")) & (100 * F.col("hib") >= share * F.col("loa")) & (F.col("compa") < F.col("compb"))
    few, many = matrix.filter(F.col("n") <= LIMIT), matrix.filter(F.col("n") > LIMIT)
    cold = side(few, "a").join(side(few, "b"), "token").filter(fits)
    sizes = ["gida", "gidb", "loa", "lob", "hia", "hib"]
    cold = cold.groupBy(*sizes).agg(F.count("*").alias("c"))
    # A group's tokens in many groups may be common to a pair too.
    hot = stored(many.groupBy("gid").agg(F.count("*").alias("h")), "hot_tokens")
    for x in "ab":
        cold = cold.join(hot.select(F.col("gid").alias("gid" + x), F.col("h").alias("h" + x)), "gid" + x, "left")
    most = F.col("c") + F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0))) + F.greatest(_after("hia", share), _after("hib", share))
    cold = cold.filter(most >= _need("loa", "lob", share)).select("gida", "gidb")
    parts = _with_earlier(many).withColumn("k", F.ceil(F.col("n") / LIMIT).cast("int"))
    left = parts.withColumn("part", F.pmod(F.xxhash64("gid", "token"), "k").cast("int")).drop("k")
    right = parts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).drop("k")
    first = F.least(F.col("hia") - F.col("posa"), F.col("hib") - F.col("posb")) >= _need("loa", "lob", share)
    first = first & ~F.arrays_overlap("earliera", "earlierb")
    rest = side(left, "a").join(side(right, "b"), ["token", "part"]).filter(fits & first).select("gida", "gidb")
    return cold.union(rest).distinct().toDF("ga", "gb")


_RECORD = "gid long, tokens binary, bits binary, nodes array<long>, sizes array<int>"


def _record(group: pa.Table) -> pa.Table:
    """A group as the union of its tokens and a bit row for each set."""
    ids, sets = _of_nodes(group)
    tokens = np.unique(np.concatenate(sets))
    rows = np.zeros((len(sets), len(tokens)), bool)
    for k, own in enumerate(sets):
        rows[k, np.searchsorted(tokens, own)] = True
    return pa.table({
        "gid": group["gid"][:1], "tokens": pa.array([tokens.tobytes()], pa.binary()), "bits": pa.array([np.packbits(rows, axis=1).tobytes()], pa.binary()),
        "nodes": pa.array([ids], pa.list_(pa.int64())), "sizes": pa.array([[len(own) for own in sets]], pa.list_(pa.int32()))})


def _lone_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of groups of one set."""
    for batch in batches:
        sizes = [len(b.as_py()) // 8 for b in batch.column(2)]
        bits = [np.packbits(np.ones(n, bool)).tobytes() for n in sizes]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(bits, pa.binary()), pa.array([[x] for x in batch.column(1).to_pylist()], pa.list_(pa.int64())), pa.array([[n] for n in sizes], pa.list_(pa.int32()))],
            names=["gid", "tokens", "bits", "nodes", "sizes"])


def _joining(hit: np.ndarray) -> list[tuple[int, int]]:
    """Links (row, column) of a matrix of links that join all that it joins."""
    found, rows, columns = [], np.zeros(hit.shape[0], bool), np.zeros(hit.shape[1], bool)
    for begin in np.flatnonzero(hit.any(axis=1)).tolist():
        wait = [] if rows[begin] else [begin]
        rows[begin] = True
        while wait:
            i = wait.pop()
            for j in np.flatnonzero(hit[i] & ~columns).tolist():
                columns[j] = True
                found.append((i, j))
                new = np.flatnonzero(hit[:, j] & ~rows).tolist()
                rows[new] = True
                found += [(k, j) for k in new]
                wait += new
    return found


def opened(a: dict, b: dict, share: int) -> tuple[int, int] | None:
    """A link between the sets of two groups, if there is one: (node, node)."""
    return next(iter(opened_links(a, b, share)), None)


def opened_links(a: dict, b: dict, share: int) -> list[tuple[int, int]]:
    """Links between the sets of two groups that join all that are joined by such links: (node, node)."""
    ta, tb = np.frombuffer(a["tokens"], np.uint64), np.frombuffer(b["tokens"], np.uint64)
    _, ia, ib = np.intersect1d(ta, tb, assume_unique=True, return_indices=True)
    na, nb = np.asarray(a["sizes"], np.int64), np.asarray(b["sizes"], np.int64)
    need = lambda x, y: -(-share * (x + y) // (100 + share))
    if len(ia) < need(na.min(), nb.min()):
        return []
    rows = []
    for x, t, i, own, other in ((a, ta, ia, na, nb), (b, tb, ib, nb, na)):
        bits = np.unpackbits(np.frombuffer(x["bits"], np.uint8).reshape(len(own), -1), axis=1, count=len(t))[:, i]
        # The overlap of each set with the other group's union bounds that with each of its sets.
        good = np.flatnonzero(bits.sum(axis=1, dtype=np.int64) >= need(own, other.min()))
        rows.append((good, bits[good].astype(np.float32)))
    (ga, ba), (gb, bb) = rows
    if not len(ga) or not len(gb):
        return []
    both = (ba @ bb.T).astype(np.int64)
    hit = 100 * both >= share * (na[ga][:, None] + nb[gb][None, :] - both)
    return [(int(a["nodes"][ga[i]]), int(b["nodes"][gb[j]])) for i, j in _joining(hit)]


def _opened_links(docs: DataFrame, groups: DataFrame, pairs: DataFrame, share: int) -> DataFrame:
    """(a, b) links between the groups of each pair, and inside groups of several components."""
    uses = pairs.select(F.explode(F.array("ga", "gb")).alias("gid")).groupBy("gid").agg(F.count("*").alias("uses"))
    uses = stored(uses.withColumn("copies", F.ceil(F.col("uses") / LIMIT).cast("int")), "uses")
    wanted = groups.join(uses, "gid", "left").filter("uses IS NOT NULL OR comp < 0")
    wanted = stored(wanted.select("doc_id", *SET, "gid", "node", (F.col("comp") < 0).alias("mixed"), F.col("uses").isNotNull().alias("met")), "in_pairs")
    sets = stored(_full_sets(docs, wanted, wanted.count()).select("gid", "node", "shingles", "mixed", "met"), "group_sets")
    inner = _links_in(sets.filter("mixed").select(F.col("gid").alias("piece"), "node", "shingles"), share)
    sets = sets.filter("met").drop("mixed", "met")
    lone = sets.filter("gid >= 0").dropDuplicates(["gid"]).mapInArrow(_lone_records, _RECORD)
    records = stored(lone.unionByName(sets.filter("gid < 0").groupBy("gid").applyInArrow(_record, _RECORD)), "records")
    spread = records.join(uses.select("gid", "copies"), "gid").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    rows = pairs
    for x in "ab":
        g, other = "g" + x, "gb" if x == "a" else "ga"
        rows = rows.join(uses.select(F.col("gid").alias(g), "copies"), g).withColumn("copy", F.pmod(F.xxhash64(other), "copies").cast("int")).drop("copies")
        record = F.struct("tokens", "bits", "nodes", "sizes").alias("r" + x)
        rows = rows.join(spread.select(F.col("gid").alias(g), "copy", record), [g, "copy"]).drop("copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for k in range(batch.num_rows):
                found += opened_links(batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), share)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])
            release()

    return rows.select("ra", "rb").mapInArrow(run, "a long, b long").union(inner)


def jaccard_components(docs: DataFrame, share: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row; share: the least similarity of a link in hundredths."""
    signed = stored(_signed(docs), "signed")
    total = max(1, signed.count())
    full = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    firsts = full.groupBy(*SET).agg(F.min("row").alias("node"), F.min("doc_id").alias("doc_id"), F.count("*").alias("n"), F.min("n_shingles").alias("n_shingles"), F.min("mins").alias("mins"))
    nodes = stored(firsts, "nodes", total)
    rows = stored(join_back(full.select(*SET, "doc_id", "n_shingles"), nodes.select(*SET, "node", "n"), SET, "n", total).select("doc_id", "n_shingles", "node"), "rows", total)

    links = stored(_rough_links(docs, nodes, total, share), "rough_links", total)
    groups = _groups(nodes, links, total)
    pairs = stored(candidate_pairs(_matrix(docs, groups, share, total), share), "pairs")
    if pairs.limit(1).count() or groups.filter("comp < 0").limit(1).count():
        links = links.union(_opened_links(docs, groups, pairs, share))
    ids = rows.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("top")).filter("a < top").drop("top")
    links = links.union(rows.join(ids, "doc_id").filter("node <> a").select(F.col("node").alias("a"), F.col("a").alias("b")))

    joined = components(links, total).select(F.col("id").alias("node"), "component")
    own = rows.groupBy("node").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")).join(joined, "node", "left")
    own = stored(own.withColumn("component", F.coalesce("component", "node")), "joined", total)
    lows = own.groupBy("component").agg(F.min("low").alias("component_id"), F.count("*").alias("c"))
    ends = stored(join_back(own.select("node", "n", "component"), lows, ["component"], "c", total).select("node", "n", "component_id"), "ends", total)
    found = join_back(rows, ends, ["node"], "n", total).select("doc_id", "n_shingles", "component_id")
    alone = signed.filter("NOT (n_shingles > 0 AND doc_id IS NOT NULL)").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone)
