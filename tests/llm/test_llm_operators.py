"""Operators on small tables with every odd row, and registered queries against brute force on the smallest tables."""

import collections
import hashlib
import math
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from folioforge.llm import near_dedup, registry, sql  # noqa: E402
from folioforge.llm import substring_dedup as substrings_module  # noqa: E402
from folioforge.llm.ann import code_products, nearest  # noqa: E402
from folioforge.llm.chat_format import format_chats, loss_text, read_chats  # noqa: E402
from folioforge.llm.common import components, join_back  # noqa: E402
from folioforge.llm.exact_dedup import exact_dedup  # noqa: E402
from folioforge.llm.licenses import license_scan  # noqa: E402
from folioforge.llm.line_dedup import line_dedup  # noqa: E402
from folioforge.llm.near_dedup import near_duplicates  # noqa: E402
from folioforge.llm.packing import pack, token_pieces  # noqa: E402
from folioforge.llm.pieces import encode_documents, encode_parts, summary  # noqa: E402
from folioforge.llm.substring_dedup import substring_dedup  # noqa: E402
from folioforge.llm.toxicity import _windows, fit, score  # noqa: E402
from brute_force import near_components, packed_well, table_texts, without_substrings  # noqa: E402

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Documents with nulls, empty, repeated and long texts, and columns that clash with those the operators make.
LONG = " ".join(f"word{i} of this" for i in range(12_000))
BASE = " ".join(f"w{i}" for i in range(200))
ROWS = [
    (1, BASE), (2, BASE.replace("w100 ", "other ")), (3, BASE), (3, BASE), (4, None), (5, ""), (6, " \n\t"), (7, LONG), (8, "short"), (9, "short"),
    (None, BASE), (10, "é" * 60 + "\n" + BASE[:300]), (11, "a\n\nA  \nb c d e f g h i\nb c x e f g h i\nb c d e f g h\n"), (12, "MIT License\nReleased under the MIT Licence"),
]
SCHEMA = "doc_id long, text string, kept string, score int, n_lines string, carry int, id string, word long, low int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "k", 1, "x", 2, "i", 3, 4) for i, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, empty):
    got = exact_dedup(docs).collect()
    assert len(got) == len(ROWS) and exact_dedup(empty).count() == 0
    by = {(r.doc_id): r for r in got}
    assert (by[1].keep_id, by[1].group_size, by[1].kept) == (1, 4, True) and (by[3].keep_id, by[3].kept) == (1, False)
    assert by[None].keep_id == 1 and not by[None].kept
    assert (by[4].keep_id, by[4].group_size) == (4, 2) and by[5].keep_id == 4 and by[6].group_size == 1
    assert by[4].text_sha256 == hashlib.sha256(b"").hexdigest()


def test_exact_dedup_of_a_hot_group(spark):
    """A third of all rows in one group, which is joined apart from the others."""
    rows = [(i, "the  same\ttext" if i % 3 == 0 else f"text {i // 2}") for i in range(1200)]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"\s+", " ", t)].append(i)
    assert got == {i: (min(own), len(own)) for own in groups.values() for i in own} and max(map(len, groups.values())) == 400


def test_join_back_with_hot_groups(spark):
    rows = spark.createDataFrame([(i, i % 7 if i % 2 else 0) for i in range(2000)] + [(5000, 99)], "row long, key long")
    groups = rows.filter("key <> 99").groupBy("key").agg(F.count("*").alias("n"), F.max("row").alias("top"))
    assert groups.filter("n > 256").count() == 1
    got = {(r.row, r.key): r.top for r in join_back(rows, groups, ["key"], "n", 2000, "left").collect()}
    top = {r.key: r.top for r in groups.collect()}
    assert got == {(r.row, r.key): top.get(r.key) for r in rows.collect()}
    assert join_back(rows, groups, ["key"], "n", 2000).count() == 2000


def test_near_duplicates(docs, empty):
    got = near_duplicates(docs).collect()
    assert len(got) == len(ROWS) and near_duplicates(empty).count() == 0
    by = {r.doc_id: r for r in got}
    assert by[1].n_shingles == 196 and {by[i].component_id for i in (1, 2, 3)} == {1} and by[1].kept and not by[2].kept
    assert by[4].n_shingles == 0 and by[4].kept and by[6].kept and (by[9].component_id, by[9].n_shingles) == (8, 1)
    assert by[None].kept and by[7].kept


def test_near_duplicates_of_oversized_regions(spark, monkeypatch):
    """Only the last two documents link the others, which share most of their words and fill regions over a block."""
    monkeypatch.setattr(near_dedup, "MAX_BLOCK", 8)
    core = [f"w{i}" for i in range(200)]
    texts = [" ".join([*core, *[f"own{i}x{k}" for k in range(20 if i > 57 else 39)]]) for i in range(60)]
    sets = [{tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for t in texts]
    low = list(range(60))
    for _ in range(4):
        for a in range(60):
            for b in range(60):
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    low[a] = low[b] = min(low[a], low[b])
    assert set(low) == {0} and all(100 * len(sets[a] & sets[0]) < 75 * len(sets[a] | sets[0]) for a in range(1, 58))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == dict(enumerate(low))


def test_near_duplicates_of_one_id_with_two_texts(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (4, a), (5, "other words here"), (5, "other words here")]
    for order in (rows, rows[::-1]):
        got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(order, "doc_id long, text string").repartition(3)).collect())
        assert got == [(1, 56, 1, True), (1, 56, 1, True), (2, 57, 1, False), (3, 57, 1, False), (4, 56, 1, False), (5, 1, 5, True), (5, 1, 5, True)]


def test_near_duplicates_in_chains_across_blocks(spark, monkeypatch):
    """5,000 sets, each linked with the next ones only; every 1,000 the step is too wide for a link, though not for a candidate."""
    monkeypatch.setattr(near_dedup, "MAX_BLOCK", 256)
    n, width = 5000, 100
    at = np.cumsum([16 if i % 1000 == 0 else 4 for i in range(n)])
    ids = np.random.default_rng(9).permutation(n)
    shared = width - 4 - 16
    assert 100 * (96 - 4) >= 75 * (96 + 4) and 100 * shared < 75 * (2 * 96 - shared)
    rows = [(int(ids[i]), " ".join(f"w{k}" for k in range(at[i], at[i] + width))) for i in range(n)]
    want = {int(ids[i]): int(min(ids[i // 1000 * 1000:i // 1000 * 1000 + 1000])) for i in range(n)}
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    assert got == want


def test_neighbours_of_sorted_places():
    sig = near_dedup.places(near_dedup.mix(np.arange(3 * 128, dtype=np.uint64)).reshape(3, 128))
    assert sig.shape == (3, near_dedup.TREES, near_dedup.PLACE) and (sig[:, :, 0] == np.arange(near_dedup.TREES)).all()
    assert (sig[:, 0, 9:] == sig[:, 1, 1:9]).all()  # an order goes on with the next one's values
    rows = [(b"\0" + b"a" * 8 + bytes([i]) * 8, i) for i in range(4)] + [(b"\0" + b"b" * 16, 9), (b"\1" + b"b" * 16, 10)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.binary()), pa.array([r[1] for r in part], pa.int64())], names=["place", "node"]) for part in (rows[:2], [], rows[2:])]
    out = [r for b in near_dedup._neighbours(iter(batches)) for r in b.to_pylist()]
    assert [(r["a"], r["b"]) for r in out if r["place"] is None] == [(1, 0), (2, 1), (3, 2)]
    assert [(r["a"], r["place"]) for r in out if r["place"]] == [(0, rows[0][0]), (10, rows[-1][0])]


def test_linked_from_known_labels():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 40, 30)).astype(np.uint64) for _ in range(60)]
    want = near_dedup.linked(sets)
    known = np.array([i if i % 3 else want[i] for i in range(60)])
    got = near_dedup.linked(sets, known)
    assert len(set(want)) > 1 and len(set(zip(want, got, strict=True))) == len(set(want)) == len(set(got))


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 1), (7, 7), (200, 201)] + [(300, 300 + i) for i in range(1, 50)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[100] == 0 and got[201] == 200 and got[349] == 300 and 7 in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_substrings(docs, empty):
    got = substring_dedup(docs, carry=("kept", "carry")).collect()
    assert len(got) == len(ROWS) and substring_dedup(empty).count() == 0
    by = {r.doc_id: r for r in got}
    assert by[1].n_removed == 0 and by[3].n_removed == by[3].n_bytes == len(BASE) and by[3].n_spans == 1 and by[3].kept_text == ""
    assert by[2].n_spans == 2 and by[2].kept_text == "other" or by[2].n_removed == len(BASE.replace("w100 ", "other ")) - len(by[2].kept_text)
    assert by[None].n_removed == 0 and by[4].n_bytes == 0 and by[4].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[10].kept_text.startswith("é" * 60) and by[10].n_removed >= 250 and by[1].carry == 2 and by[1].kept == "k"


def test_substrings_of_one_id_with_two_texts(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(1, a), (2, a), (2, b), (3, "x " + b), (4, c), (5, d), (5, "yy " + c + " z"), (6, a[:30])]
    got = {(r.doc_id, r.n_bytes, r.kept_text) for r in substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    left = {(2, a): "", (3, "x " + b): "x ", (5, "yy " + c + " z"): "yy  z"}
    assert got == {(i, len(t), left.get((i, t), t)) for i, t in rows}


def test_line_dedup(docs, empty):
    got = line_dedup(docs).collect()
    assert len(got) == len(ROWS) and line_dedup(empty).count() == 0
    by = {r.doc_id: r for r in got}
    assert by[4].text is None and by[4].n_lines == 0 and by[5].n_lines == 1 and by[6].text == " \n\t"
    assert by[1].n_dropped == 0 and by[2].n_dropped == 1 and by[2].text == "" and by[3].n_dropped == 1 and by[None].text == BASE
    assert by[9].n_dropped == 1 and by[11].text == "a\n\nb c d e f g h i\nb c d e f g h\n" and by[11].n_dropped == 2
    assert by[1].kept == "k" and by[1].word == 3


def test_line_edits(spark):
    base = "one two three four five six seven eight nine ten"
    edits = [base, base.replace("five ", ""), base.replace("two", "zwei"), base + " eleven", "zero " + base, base.replace("one two", "two one"), base.replace("three four", "x y")]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(edits)], "doc_id long, text string")
    assert {r.doc_id: r.n_dropped for r in line_dedup(docs).collect()} == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 0, 6: 0}
    eight = spark.createDataFrame([(0, "a b c d e f g h"), (1, "a b c d e f g"), (2, "a b c d e f g h i"), (3, "a b c d e f g h i j k l m n o p"), (4, "a b c d e f g h i j k l m n o")], "doc_id long, text string")
    assert {r.doc_id: r.n_dropped for r in line_dedup(eight).collect()} == {0: 0, 1: 0, 2: 1, 3: 0, 4: 1}


def test_lines_of_one_id_with_two_texts(spark):
    rows = [(1, "first\nsecond"), (2, "first\nx y"), (2, "only here\nsecond"), (2, "only here\nsecond"), (3, "only here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.text, r.n_dropped) for r in line_dedup(docs).collect())
    assert got == [(1, "first\nsecond", 0), (2, "only here", 1), (2, "only here", 1), (2, "x y", 1), (3, "", 1)]


def test_lines_near_one_common_line(spark, monkeypatch):
    """One line with thousands of lines at an edit of one word, and a group over the bound from which groups are joined apart."""
    words = [f"w{i}" for i in range(12)]
    rows = [(0, " ".join(words))] + [(i, " ".join([*words[:5], f"other{i}", *words[6:]])) for i in range(1, 1500)] + [(2000 + i, "the very same line") for i in range(1500)]
    got = {r.doc_id: r.n_dropped for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: int(i not in (0, 2000)) for i, _ in rows}


def test_packing(docs, empty):
    got = pack(token_pieces(docs, WORDS, 64), 64, per_partition=40).collect()
    assert pack(token_pieces(empty, WORDS, 64), 64).count() == 0
    pieces = collections.defaultdict(list)
    bins = collections.defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for o, n in sorted(items):
            assert o == at
            at += n
        assert at <= 64
    assert [r.length for r in pieces[4]] == [1] and len(pieces[3]) == 2 * len(pieces[1])
    assert len(bins) <= -(-sum(r.length for r in got) // 64) + 3
    p = sorted(pieces[7], key=lambda r: r.piece)
    assert [r.start for r in p] == [64 * k for k in range(len(p))] and all(r.length == 64 for r in p[:-1])


def test_licenses(docs, empty, spark):
    got = {(r.doc_id, r.scope, r.line_no, r.license) for r in license_scan(docs).collect()}
    assert got == {(12, "line", 1, "MIT")} and license_scan(empty).count() == 0
    from folioforge.llm.licenses import KNOWN

    text = "Copyright (c) 2020 Somebody\n\n" + KNOWN[0][1].upper().replace("LICENSE", "LICENCE").replace(",", " ,")
    own = spark.createDataFrame([(1, text), (2, KNOWN[0][1] + " more"), (3, None)], "doc_id long, text string")
    assert {(r.doc_id, r.scope, r.license) for r in license_scan(own).collect()} == {(1, "text", "MIT")}


def test_licenses_of_repeated_rows_and_long_texts(spark):
    from folioforge.llm.licenses import _MIT, stems

    filler = "\n".join(f"line {i} of a long text" for i in range(60_000))
    rows = [(1, "Licence licence MIT"), (1, "Released under MIT"), (1, "Released under MIT"), (None, "SPDX-License-Identifier: MIT"), (2, filler + "\n  RELEASED  UNDER THE MIT LICENSE!\n" + filler), (3, "Copyright 2020 x\n" * 30_000 + _MIT), (4, "  ")]
    got = sorted((r.doc_id or -1, r.scope, r.line_no) for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect())
    assert got == [(-1, "line", 0), (-1, "text", -1), (1, "line", 0), (1, "line", 0), (1, "text", -1), (1, "text", -1), (2, "line", 60_000), (3, "text", -1)]
    assert license_scan(spark.createDataFrame([(1, "ask us")], "doc_id long, text string"), known=[("Own", "Ask us!")]).count() == 2 and stems([("Own", "ask us")]) == []
    two = license_scan(spark.createDataFrame([(1, "licence licence licence")], "doc_id long, text string"), known=[("Own", "license license license")])
    assert two.count() == 2  # each of neighbouring equal words is brought to its one spelling


def test_entire_licenses_and_notices(spark):
    from folioforge.llm.licenses import KNOWN, canonical_text

    named = {canonical_text(t): name for name, t in KNOWN}
    assert all(named[canonical_text(t)] == name for name, t in KNOWN)
    folder = os.path.join(os.path.dirname(registry.__file__), "license_texts")
    names = sorted(f.removesuffix(".txt") for f in os.listdir(folder))
    assert {"Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "MPL-2.0", "Unlicense"} <= set(names)
    texts = [open(os.path.join(folder, f"{n}.txt"), encoding="utf-8").read() for n in names]
    rows = [*enumerate(texts), (100, "Licensed under the Mozilla Public License 2.0"), (101, "# SPDX-License-Identifier: AGPL-3.0-or-later"), (102, texts[0] + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.scope, r.license) for r in license_scan(docs).collect()}
    assert {x for x in got if x[1] == "text"} == {(i, "text", n) for i, n in enumerate(names)} | {(100, "text", "MPL-2.0"), (101, "text", "AGPL-3.0-or-later")}
    assert (100, "line", "MPL-2.0") in got
    own = license_scan(spark.createDataFrame([(1, "Ask us first!")], "doc_id long, text string"), known=[("Own", "ask us first")])
    assert {(r.scope, r.license) for r in own.collect()} == {("text", "Own"), ("line", "Own")}


def test_pieces(docs, empty):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = summary(*encode_parts(docs, PIECES, chunk=5000), PIECES).collect()
    assert encode_documents(docs, PIECES, chunk=5000).filter("n > 1").count() > 2
    assert len(got) == len(ROWS) and summary(*encode_parts(empty, PIECES), PIECES).count() == 0
    for r in got:
        text = dict(ROWS)[r.doc_id] or ""
        ids = np.array(sp.encode(text), "<i4").tobytes()
        assert (r.n_ids, r.ids_crc32, r.text_sha256) == (len(ids) // 4, zlib.crc32(ids), hashlib.sha256(text.encode()).hexdigest())


def test_toxicity(docs, empty, spark):
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("aeioubcdgt"), 5))
    rows, labels = [], []
    for i in range(600):
        text = [word() for _ in range(40)]
        if i % 3 == 0:
            for _ in range(3):
                text[rng.integers(0, 40)] = ("Zorkhead" + word())[: rng.integers(8, 13)]
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 3 == 0)))
    own = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (None, 1), (5000, None)], "doc_id long, toxic int")
    model = fit(own, lab)
    got = {r.doc_id: r for r in score(own, model).collect()}
    assert all((got[i].score >= 0.7) == (y == 1) for i, y in labels)
    r = got[0]
    assert {re.match("zorkhead", rows[0][1][s.start:s.end].lower()) is not None for s in r.spans} == {True}
    odd = score(docs, model, carry=("score",)).collect()
    assert len(odd) == len(ROWS) and all(0 <= x[1] <= 1 for x in odd) and score(empty, model).count() == 0
    nothing = fit(own, lab.filter("toxic = 0"))
    assert {r.score for r in score(own, nothing).collect()} == {0.0}


def test_toxicity_of_odd_labels_and_rows(spark):
    """Contradictory labels count as toxic; repeated rows are scored each; a word may have more features than four."""
    rng = np.random.default_rng(7)
    words = np.array(["".join(rng.choice(list("aeioubcdgt"), 5)) for _ in range(300)])
    rows = [(i, " ".join([*rng.choice(words, 30), *(["abominable"] * 2 if i % 3 == 0 else [])])) for i in range(240)]
    rows += [(0, rows[0][1]), (900, " ".join(rng.choice(words, 200_000)) + " Abominable"), (901, " ".join(rng.choice(words, 200_000))), (902, "ABOMINABLE")]
    own = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)] + [(i, 0) for i in range(0, 240, 3)], "doc_id long, toxic int")
    got = score(own, fit(own, labels)).collect()
    assert len(got) == len(rows) and len([r for r in got if r.doc_id == 0]) == 2
    by = {r.doc_id: r for r in got}
    assert all((by[i].score >= 0.7) == (i % 3 == 0) for i in range(240)) and not by[901].spans and len(by[900].spans) == 1
    assert by[900].spans[0].start == len(rows[-3][1]) - 10 and by[900].spans[0].end == len(rows[-3][1])
    seen = {(0, 4): list(range(6))}
    d, w, f = np.zeros(6, int), np.full(6, 4), np.arange(6)
    table, states = _windows(d, w, f, np.array([9]), np.array([1]), 6)
    assert sorted(table[0, 6].tolist()) == seen[0, 4] and states[0].sum() == 1


def test_toxicity_learns_from_whole_texts(spark):
    """Toxic words stand after the first 20,000 characters only."""
    rng = np.random.default_rng(5)
    words = np.array(["".join(rng.choice(list("aeioubcdgt"), 5)) for _ in range(200)])
    rows = [(i, " ".join([*rng.choice(words, 3600), *(["zorkhead"] * 3 if i % 3 == 0 else []), "end"])) for i in range(90)]
    assert min(len(t) for _, t in rows) > 20_100
    own = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in score(own, fit(own, labels)).collect()}
    assert all((got[i].score >= 0.7) == (i % 3 == 0) for i in got) and len(got[0].spans) == 3


def test_nearest(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(40)] + [(1000, None), (1050, [0.0] * 8), (1100, [1.0, None] * 4), (1150, [float("nan")] * 8), (None, rows[0][1]), (1200, []), (1250, [1.0, 2.0]), (1, rows[1][1])]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = collections.defaultdict(list)
    for r in nearest(df, query_block=3, vector_block=64).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    want = {}
    for q, a in ok:
        if q % 50 == 0:
            s = sorted(((-(a @ b) / math.sqrt((a @ a) * (b @ b)), i) for i, b in ok if i != q))[:5]
            want[q] = s
    assert set(got) == set(want)
    for q, s in want.items():
        own = sorted(got[q])
        assert [x[1] for x in own] == [i for _, i in s] and np.allclose([x[2] for x in own], [-c for c, _ in s], atol=1e-12)
    assert nearest(df.filter("false")).count() == 0


def test_nearest_of_repeated_queries_and_many_dimensions(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=2100).round(2).tolist()) for i in range(40)] + [(0, rng.normal(size=2100).round(2).tolist())]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), query_block=1, vector_block=16).collect()
    want = []
    for q, a in rows:
        if q % 50 == 0:
            cos = sorted((-(np.dot(a, b) / math.sqrt(np.dot(a, a) * np.dot(b, b))), i) for i, b in rows if i != q)[:5]
            want += [(q, r + 1, i, round(-c, 9)) for r, (c, i) in enumerate(cos)]
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got) == sorted(want) and len(want) == 10
    codes = rng.integers(-127, 128, (3, 5000))
    assert (code_products(codes.astype(np.float32), codes.astype(np.float32)) == codes @ codes.T).all()


def test_chats(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "<turn:\\b>\\"), (1, 2, "assistant", "a</turn>\n\\l"), (1, 3, "user", None), (1, 4, "assistant", ""), (2, 0, "assistant", "x"), (3, 1, None, "n"), (3, None, "user>\n", "u"), (None, 0, "user", "q"), (None, 1, "assistant", "é")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    got = {r.conv_id: r for r in read_chats(format_chats(df)).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    turns = lambda i: [(t.role, t.text) for t in got[i].turns]
    assert turns(1) == [("system", "s"), ("user", "<turn:\\b>\\"), ("assistant", "a</turn>\n\\l"), ("user", ""), ("assistant", "")]
    assert got[1].loss == "a</turn>\n\\l" and got[1].valid and got[1].error_at is None
    assert turns(3) == [("user>\n", "u"), ("", "n")] and not got[3].valid and got[3].error_at == 0 and not got[2].valid
    assert got[None].loss == "é" and got[None].valid and format_chats(df.filter("false")).count() == 0
    masked = {i: "".join(s.text for s in r.segments if s.loss) for i, r in got.items()}
    assert {i: b"".join(r.formatted.encode()[s.start - 1:s.start - 1 + s["size"]] for s in r.loss_spans).decode() for i, r in got.items()} == masked


def test_chats_with_ties_repeats_and_long_texts(spark):
    long = "<é>\\" * 100_000
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 1, "assistant", long), (1, 1, "assistant", long), (1, 1, "assistant", "é"), *[(2, k, ("user", "assistant")[k % 2], f"é{k}") for k in range(3000)]]
    got = {r.conv_id: r for r in read_chats(format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5))).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("user", "a"), ("user", "b"), ("assistant", long), ("assistant", long), ("assistant", "é")]
    assert got[1].loss == long + long + "é" and not got[1].valid and got[1].error_at == 1
    assert got[2].valid and got[2].loss == "".join(f"é{k}" for k in range(1, 3000, 2)) and len(got[2].turns) == 3000


needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


@needs_tables
@pytest.mark.parametrize("name", sorted(sql.ORACLE))
def test_queries_match_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(sql.ORACLE[name])
    names = [d[0] for d in found.description]
    want = sorted(map(repr, (tuple(r) for r in found.fetchall())))
    df = registry.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(repr(tuple(r)) for r in df.select(*names).collect()) == want


@needs_tables
@pytest.mark.parametrize("hot", [20_000, 1])
def test_substring_query_by_brute_force(spark, monkeypatch, hot):
    """Also with every repeated anchor dealt by window, and over many buckets."""
    monkeypatch.setattr(substrings_module, "HOT", hot)
    monkeypatch.setattr(substrings_module, "BUCKET_BYTES", 100_000)
    texts = table_texts(spark, SF)
    want = without_substrings(texts)
    for r in registry.queries()["op5_suffix_array_dedup"](spark, SF).collect():
        kept, gone = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(gone), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())


@needs_tables
def test_near_query_by_brute_force(spark):
    texts = table_texts(spark, SF)
    sets, low = near_components(texts)
    got = {r.doc_id: r for r in registry.queries()["op2_lsh_forest_near_dedup"](spark, SF).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), low[i], low[i] == i) for i in texts}


@needs_tables
def test_packing_query_by_the_tokenizer(spark):
    texts = table_texts(spark, SF)
    rows = registry.queries()["op1_best_fit_packing"](spark, SF).collect()
    packed_well(texts, [r.asDict() for r in rows])


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="needs the driver's tables")
def test_toxicity_query_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in registry.queries()["op7_crf_toxicity"](spark, LARGER).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for i, r in rows.items())
    own = [(rows[i].score, y) for i, y in labels.items() if rows[i].held_out]
    bad, good = [s for s, y in own if y], [s for s, y in own if not y]
    assert len(bad) > 30 and sum(s >= 0.7 for s in bad) >= 0.9 * len(bad) and sum(s < 0.7 for s in good) >= 0.98 * len(good)
