"""Kernels against independent statements of what they compute."""

import collections
import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")

from folioforge.llm import substring_dedup as S  # noqa: E402
from folioforge.llm.ann import cosine  # noqa: E402
from folioforge.llm.near_dedup import linked  # noqa: E402
from folioforge.llm.packing import best_fit, lower_bound  # noqa: E402
from folioforge.llm.pieces import PieceModel, max_plus, prepared, resolve, transfer  # noqa: E402
from folioforge.llm.suffix_array import suffix_array  # noqa: E402
from folioforge.llm.textscan import shingle_sets  # noqa: E402
from folioforge.llm.toxicity import Model, _Chain  # noqa: E402
from folioforge.llm.word_bpe import WordBPE  # noqa: E402


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_array(text):
    assert suffix_array(np.array(text, np.int64)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=4, max_size=12), min_size=1, max_size=12))
def test_window_minima(texts):
    pieces = [t.encode() for t in texts]
    owner = np.arange(len(pieces))[::-1].copy()
    low = {}
    for p, o in zip(pieces, owner, strict=True):
        for i in range(len(p) - 3):
            low[p[i:i + 4]] = min(int(o), low.get(p[i:i + 4], 99))
    got = S.window_minima(pieces, owner, 4)
    assert [g.tolist() for g in got] == [[low[p[i:i + 4]] for i in range(len(p) - 3)] for p in pieces]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_best_fit_and_bound(lengths):
    sizes = np.array(lengths, np.int64)
    bins, offsets, made = best_fit(sizes, 64)
    seen = collections.defaultdict(list)
    for b, o, n in zip(bins.tolist(), offsets.tolist(), lengths, strict=True):
        seen[b].append((o, n))
    for items in seen.values():
        at = 0
        for o, n in sorted(items):
            assert o == at
            at += n
        assert at <= 64
    assert len(seen) == made >= lower_bound(np.bincount(sizes, minlength=65)) >= -(-sum(lengths) // 64)


def test_bound_beats_volume():
    assert lower_bound(np.bincount([33] * 10, minlength=65)) == 10
    assert lower_bound(np.bincount([22] * 9, minlength=65)) == 5


@pytest.fixture(scope="module")
def bpe():
    return WordBPE(public_tokenizers.path("word_bpe_49k.json"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abTh'sre ré ÀßÿİΣ²ª_-!?19\n\t 漢<|")), max_size=24), min_size=1, max_size=8))
def test_word_bpe_is_the_tokenizer(bpe, texts):
    want = [np.array(e.ids, "<u4").tobytes() for e in bpe.full.encode_batch(texts, add_special_tokens=False)]
    assert bpe.encode(texts) == want


def test_word_bpe_on_long_words_and_control_strings(bpe):
    texts = ["x" * 300 + " <|endoftext|> don't", "it's '' 's'll", "a" * 41]
    assert bpe.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in bpe.full.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def pieces():
    return PieceModel(public_tokenizers.path("piece_bpe_32k.model"))


TEXTS = st.text(st.sampled_from(list("the and ing  \n\t.é漢☃▁xyz09'\"")), max_size=60)


@settings(max_examples=80, deadline=None)
@given(TEXTS, st.integers(3, 25))
def test_pieces_are_the_encoder(pieces, text, chunk):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sp.encode(text)
    assert np.frombuffer(pieces.encode(text), "<i4").tolist() == want
    if "▁" not in text:
        assert pieces.decode(want) == text
    if not text:
        return
    whole = prepared(text)
    cuts = [*range(0, len(whole), chunk), len(whole)]
    tables = [transfer(pieces, whole, a, b, b == len(whole)) for a, b in zip(cuts, cuts[1:], strict=False)]
    states = resolve([t[2] for t in tables])
    out, now = [], tables[0][0][0]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        to = tables[k][1][states[k]]
        out += pieces.trace_words(whole, a, b, now, to, b == len(whole))
        now = to
    assert out == want


def test_max_plus_is_associative():
    rng = np.random.default_rng(0)
    a, b, c = (np.where(rng.random((4, 4)) < 0.3, -np.inf, rng.integers(0, 9, (4, 4))) for _ in range(3))
    assert (max_plus(max_plus(a, b), c) == max_plus(a, max_plus(b, c))).all()


def test_linked_walks_chains():
    base = np.arange(100, dtype=np.uint64)
    sets = [base, base + np.uint64(10), base + np.uint64(20), np.arange(500, 520, dtype=np.uint64)]
    assert linked(sets).tolist() == [0, 0, 0, 3]  # the first and third are linked only through the second
    assert linked([base[:75], base]).tolist() == [0, 0] and linked([base[:74], base]).tolist() == [0, 1]


def test_shingles():
    sets, sizes = shingle_sets(pa.array(["A b c d e f", "a B\x0bC d  e F\n", "a b", "A B ", "", None, "a b c d e a b c d e a", "a\xa0b"]))
    assert sizes.tolist() == [2, 2, 1, 1, 0, 0, 5, 1]
    assert set(sets[:2]) == set(sets[2:4]) and sets[4] == sets[5]


def test_cosine_of_extreme_vectors():
    v = np.array([[1e-200, 0.0], [1e200, 1e200], [0.0, 5e-324]])
    assert np.allclose(cosine(np.array([1e300, 0.0]), v), [1.0, 2**-0.5, 0.0])


def test_chain_powers_match_step_by_step():
    model = Model(np.zeros(2, np.uint64), np.array([3.0, 1.0]), -2.0, np.array([[0.5, -1.0], [0.2, 0.7]]))
    at, weight, n = [2, 3, 90], [3.0, 1.0, 4.0], 120
    emit = np.zeros((n, 2))
    emit[:, 1] = -2.0
    for k, w in zip(at, weight, strict=True):
        emit[k, 1] += w
    e, t = np.exp(emit), np.exp(model.moves)
    ahead, back = np.zeros((n, 2)), np.ones((n, 2))
    ahead[0] = e[0]
    for i in range(1, n):
        a = (ahead[i - 1] @ t) * e[i]
        ahead[i] = a / a.sum()
    for i in range(n - 2, -1, -1):
        b = t @ (e[i + 1] * back[i + 1])
        back[i] = b / b.sum()
    p = ahead * back
    p = p[:, 1] / p.sum(axis=1)
    assert np.allclose(_Chain(model).marginals(at, weight, n), p[at])


def test_empty_digest_constant():
    assert hashlib.sha256(b"").hexdigest() == S._EMPTY
