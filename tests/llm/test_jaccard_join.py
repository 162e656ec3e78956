"""The exact Jaccard join against all pairs."""

import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")

from folioforge.llm import jaccard_join, registry  # noqa: E402

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def expected(rows, share=80):
    """(doc_id, set size, component) of each row by all pairs; rows of one id are linked."""
    sets = [shingles(t) for _, t in rows]
    low = list(range(len(rows)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if rows[a][0] == rows[b][0] or 100 * both >= share * (len(sets[a]) + len(sets[b]) - both):
                low[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def found(spark, rows, share=80, parts=5):
    df = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], "doc_id long, text string, token string, gid long, node long, comp int")
    return sorted((tuple(r) for r in jaccard_join.jaccard_components(df.repartition(parts), share).select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def cluttered(seed, n):
    """Texts around the threshold: families of edited copies, a passage and a line in a third of all, whole copies, short ones."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage, line = [word() for _ in range(40)], [word() for _ in range(8)]
    bases = [[word() for _ in range(rng.randint(5, 160))] for _ in range(n // 12)]
    rows = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6])):
            text[rng.randrange(len(text))] = word()
        if rng.random() < 0.2:
            text = text[:rng.randint(1, len(text))]
        if i % 3 == 0:
            text = text[:30] + passage + text[30:]
        if i % 3 == 1:
            text += line
        rows.append((i, " ".join(text)))
    rows += [(n + k, " ".join([*passage, *[word() for _ in range(rng.randint(1, 9))]])) for k in range(n // 10)]
    return rows


@pytest.mark.parametrize("small, share", [(False, 80), (True, 60)])
def test_join_by_all_pairs(spark, monkeypatch, small, share):
    """Also with tiny groups, few known frequent tokens and most tokens dealt into parts, and without any rough links."""
    if small:
        for name, value in (("GROUP", 4), ("LIGHT", 64), ("LIMIT", 2), ("HOT", 20), ("RARE", 2)):
            monkeypatch.setattr(jaccard_join, name, value)
        monkeypatch.setattr(jaccard_join, "_rough_links", lambda docs, nodes, total, share: nodes.selectExpr("node AS a", "node AS b").filter("false"))
    rows = cluttered(7 + share, 240)
    want = expected(rows, share)
    assert 20 < len({c for _, _, c in want}) < 230
    assert found(spark, rows, share) == want


def test_join_of_odd_rows(spark):
    base = " ".join(f"w{i}" for i in range(100))
    other = " ".join(f"x{i}" for i in range(100))
    rows = [(1, base), (2, base.replace("w50 ", "new ")), (3, base), (3, base), (4, None), (5, ""), (6, " \n\t"), (7, " ".join(f"y{i}" for i in range(20_000))), (8, "Short"), (9, "short"), (None, base), (None, None)]
    rows += [(10, base + " z"), (10, other), (11, other + " é"), (12, "É"), (13, "é")] + [(20 + i % 3, "the same of all") for i in range(30)]
    assert found(spark, rows) == expected(rows)
    assert found(spark, []) == []


def test_join_of_a_large_family(spark):
    """One group of copies that are all linked, in which pieces of 64 sets meet, and copies of one set in a third of the rows."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(500):
        text = list(base)
        text[rng.randrange(120)] = f"new{i}"
        rows.append((i, " ".join(text)))
    rows += [(500 + i, " ".join(base)) for i in range(300)]
    got = found(spark, rows, parts=8)
    assert {c for _, _, c in got} == {0} and len(got) == 800


def test_opening_of_groups():
    rng = np.random.default_rng(1)
    for _ in range(300):
        sides, sets = [], []
        pool = np.unique(rng.integers(0, 60, 60)).astype(np.uint64)
        for g in range(2):
            own = [np.unique(rng.choice(pool, rng.integers(10, 40))) for _ in range(rng.integers(1, 5))]
            rows = pa.table({"gid": [g] * len(own), "node": range(10 * g, 10 * g + len(own)), "shingles": [s.tobytes() for s in own]})
            record = jaccard_join._record(rows).to_pylist()[0]
            if len(own) == 1:
                assert record == next(jaccard_join._lone_records(iter(rows.to_batches()))).to_pylist()[0]
            sides.append(record)
            sets.append(own)
        hits = {(i, 10 + j) for i, x in enumerate(sets[0]) for j, y in enumerate(sets[1]) if 100 * len(np.intersect1d(x, y)) >= 60 * len(np.union1d(x, y))}
        got = jaccard_join.opened(*sides, 60)
        assert (got in hits) if hits else got is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
def test_query_by_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in registry.queries()["op12_jaccard_join"](spark, SF).select("doc_id", "n_shingles", "component_id").collect()), key=repr)
    assert got == expected(rows)


def _below(seed, n, edits):
    """Copies of one text, each with its own edits, so that most of them lie just below the threshold."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        text = list(base)
        for k in rng.sample(range(300), edits[i % len(edits)]):
            text[k] = f"new{i}x{k}"
        rows.append((i, " ".join(text)))
    return rows


def test_family_below_the_threshold_meets_as_groups(spark, monkeypatch):
    """A hundred sets that all are candidates of each other are opened as few pairs of groups, with the links of all pairs."""
    for name, value in (("FEWEST", 4), ("GROUP", 8)):
        monkeypatch.setattr(jaccard_join, name, value, raising=False)
    made = []
    own = jaccard_join.candidate_pairs
    monkeypatch.setattr(jaccard_join, "candidate_pairs", lambda *a: made.append(own(*a)) or made[-1])
    rows = _below(5, 100, [9])
    want = expected(rows)
    assert len({c for _, _, c in want}) > 90
    assert found(spark, rows) == want
    assert made[-1].count() < 100 * 99 / 2 / 5


def test_links_inside_and_between_mixed_groups(spark, monkeypatch):
    """Without rough links all sets lie in groups of several components, whose links inside and between them are all found."""
    for name, value in (("FEWEST", 2), ("GROUP", 4)):
        monkeypatch.setattr(jaccard_join, name, value, raising=False)
    monkeypatch.setattr(jaccard_join, "_rough_links", lambda docs, nodes, total, share: nodes.selectExpr("node AS a", "node AS b").filter("false"))
    rows = _below(6, 90, [4, 6, 7, 9, 12])
    want = expected(rows)
    assert 5 < len({c for _, _, c in want}) < 85
    assert found(spark, rows) == want
