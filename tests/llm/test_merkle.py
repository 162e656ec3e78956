"""The Merkle manifest against a plain statement of its contract."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from folioforge.llm import merkle, registry  # noqa: E402

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, digest string, pos long, key int"


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[c] for c in COLUMNS))


def climbed(nodes):
    """All levels, from the nodes to their root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def expected(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))):
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climbed([leaf(r) for r in groups[g]]) for g in order}
    top = climbed([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            steps = []
            for levels, at in ((trees[g], i), (top, k)):
                for nodes in levels[:-1]:
                    steps.append((at % 8, nodes[at // 8 * 8:at // 8 * 8 + 8]))
                    at //= 8
            changed = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                changed["text"] = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
            node = leaf(changed)
            for at, run in steps:
                node = h([*run[:at], node, *run[at + 1:]])
            proof = h(x for at, run in steps for x in run[:at] + run[at + 1:])
            root = top[-1][0]
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def found(df, most):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    small = {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    return sorted((tuple(r) for r in merkle.manifest(df, COLUMNS, "lang", "doc_id", tampered, small, most).collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 3])
@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 200, 512])
def test_paths_of_a_block(levels, n):
    n = min(n, 8**levels)
    leaves = [h([str(i)]) for i in range(n)]
    nodes = [leaves]
    for _ in range(levels):
        nodes.append([h(nodes[-1][i:i + 8]) for i in range(0, len(nodes[-1]), 8)])
    for i, own in enumerate(merkle.paths(leaves, levels)):
        assert own == [nodes[k][i // 8**(k + 1) * 8:i // 8**(k + 1) * 8 + 8] for k in range(levels)]
    assert merkle.block_root(leaves, levels) == nodes[-1][0]


def test_memory_of_a_walk_is_bounded_by_levels():
    stack = merkle.Treehash(4)
    for i in range(8**4 - 1):
        stack.push(str(i))
        assert sum(map(len, stack.open)) <= 8 * 5
    assert [merkle.height(n) for n in (1, 2, 8, 9, 64, 65, 4096, 4097)] == [0, 1, 1, 2, 2, 3, 4, 5]


@pytest.mark.parametrize("most", [1, 2, 4])
def test_manifest_of_odd_rows(spark, most):
    """Groups of one to hundreds of rows, nulls in every column, rows that repeat, an id with two texts, columns that clash."""
    rows = [(i, f"Text {i}" if i % 9 else None, ["en", "de", "é"][i % 3] if i % 2 else "en", "S" if i % 5 else None, i if i % 4 else None) for i in range(300)]
    rows += [(1000 + i, "A", f"l{i}", "s", 1) for i in range(20)]
    rows += [(7, "Other", "en", "s", 1), (7, "Other", "en", "s", 1), (None, "T", "en", "s", 1), (None, None, None, None, None), (2**62 + 1, "", "", "", 0), (5001, "Ü" * 5000, None, "s", 5000)]
    df = spark.createDataFrame([(*r, "x", "y", 3, 4) for r in rows], SCHEMA).repartition(5)
    assert found(df, most) == expected([dict(zip(["doc_id", "text", "lang", "source", "n_chars"], r, strict=True)) for r in rows])


def test_manifest_of_few_rows_and_none(spark):
    assert found(spark.createDataFrame([], SCHEMA), 4) == []
    one = [dict(doc_id=3, text="A", lang="en", source="s", n_chars=1)]
    df = spark.createDataFrame([(3, "A", "en", "s", 1, "x", "y", 3, 4)], SCHEMA)
    assert found(df, 4) == expected(one)


def test_query_and_its_sql_are_registered():
    assert "op13_merkle_manifest" in registry.queries() and "op13_merkle_manifest" in registry.oracle_sql()
