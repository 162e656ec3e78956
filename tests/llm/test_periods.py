"""Periodic runs against a plain statement of the contract."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from folioforge.llm import periods, registry  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, runs string, n_words int, start long, collapsed_text int"


def runs_of(words, least=6, power=4):
    """Every maximal stretch by its smallest period, tried period by period."""
    found, seen = [], set()
    codes = {}
    w = np.array([codes.setdefault(x, len(codes)) for x in words])
    for q in range(1, len(w) // power + 1):
        same = np.r_[False, w[q:] == w[:-q], False]
        change = np.flatnonzero(same[1:] != same[:-1])
        for start, end in zip(change[::2].tolist(), change[1::2].tolist(), strict=True):
            length = end - start + q
            if length >= max(least, power * q) and (start, length) not in seen:
                found.append((start, length, q))
            if length >= 2 * q:
                seen.add((start, length))
    return sorted(found, key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def bent(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def kernel(texts, least=6, power=4):
    codes = {}
    words = [[codes.setdefault(w, len(codes)) for w in t] for t in texts]
    at = np.cumsum([0, *map(len, words)])
    return periods.word_runs(np.array([w for t in words for w in t], np.uint64), at, least, power)


@pytest.mark.parametrize("together", [0, 1, 3, 12])
def test_runs_of_random_words(monkeypatch, together):
    """The refinement by smaller halves takes over at each of several lengths."""
    monkeypatch.setattr(periods, "TOGETHER", together)
    rng = random.Random(together)
    texts = [[], ["a"], ["a"] * 6, ["a"] * 5, ["a"] * 100]
    for _ in range(400):
        root = [rng.choice("abc") for _ in range(rng.randint(1, 30))]
        text = [rng.choice("ab") for _ in range(rng.randint(0, 30))] + root * rng.randint(1, 7) + root[:rng.randint(0, len(root))]
        text += [rng.choice("ab") for _ in range(rng.randint(0, 40))]
        texts.append(text)
    texts += [[rng.choice("ab") for _ in range(rng.randint(0, 120))] for _ in range(200)]
    for least, power in ((6, 4), (2, 2), (4, 3)):
        got = kernel(texts, least, power)
        for t, own in zip(texts, got, strict=True):
            assert own == runs_of(t, least, power), (t, least, power)


def test_moves_stay_near_linear(monkeypatch):
    """Long periodic texts, Fibonacci words and single words: the number of moves grows like n log n."""
    moves = 0
    unlink = periods.Classes._unlink

    def counted(self, i):
        nonlocal moves
        moves += 1
        unlink(self, i)

    monkeypatch.setattr(periods.Classes, "_unlink", counted)
    rng = random.Random(5)
    root = [rng.randrange(1000) for _ in range(2000)]
    a, b = [0], [0, 1]
    while len(b) < 10_000:
        a, b = b, b + a
    for text in ([1] * 10_000, root * 5, b[:10_000], [i // 3 % 7 for i in range(10_000)]):
        moves = 0
        n = len(text)
        got = periods.word_runs(np.array(text, np.uint64), np.array([0, n]), 6, 4)[0]
        assert moves <= n * (2 + np.log2(n))
        if text == root * 5:
            assert got == [(0, n, 2000)]
        elif text[:9] == [1] * 9:
            assert got == [(0, n, 1)]


def test_runs_of_odd_rows(spark):
    long = " ".join(f"w{i % 37}" for i in range(20_000))
    rows = [(1, "x a b a b a b a b y"), (1, "x a b a b a b a b y"), (1, "other"), (2, None), (3, ""), (4, " \t\n"), (5, long), (None, "a " * 9), (6, "é\x0bé\x0cé\té\né\ré é ü"), (7, "A a A a A a A a")]
    df = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.collapsed_text) for r in periods.periodic_runs(df).collect()), key=repr)
    want = []
    for i, t in rows:
        w = words_of(t)
        own = runs_of(w)
        want.append((i, len(w), own, collapsed(w, own)))
    assert got == sorted(want, key=repr)
    assert ("x a b y", [(1, 8, 2)]) in [(g[3], g[2]) for g in got]
    assert periods.periodic_runs(df.limit(0)).count() == 0


def test_planted_texts(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 40))) for i in range(200)] + [(None, "a b"), (10, None), (25, " lead\ttwo \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in df.select("doc_id", periods.planted(F.col("doc_id"), F.col("text")).alias("text")).collect()), key=repr)
    assert sorted(((i, words_of(t)) for i, t in got), key=repr) == sorted(((i, bent(i, words_of(t))) for i, t in rows), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
def test_query_by_brute_force(spark):
    rows = registry.queries()["op11_periodic_runs"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts) and any(r.n_runs for r in rows)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in rows:
        words = bent(r.doc_id, words_of(texts[r.doc_id]))
        own = runs_of(words)
        best = min(own, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.start, r.length, r.period) == best and r.n_runs == len(own)
        assert r.exponent_milli == (None if best[0] is None else 1000 * best[1] // best[2])
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in own)) and r.collapsed_sha256 == sha(collapsed(words, own))
