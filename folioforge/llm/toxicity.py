"""Toxicity by a linear-chain conditional random field over word tokens.

Labels are per document, so labelled tokens come first: a greedy cover finds the word beginnings that occur in
toxic documents and hardly in others, and their occurrences in toxic documents are the tokens labelled toxic. A
two-state chain (clean, toxic) with these features, a bias and transitions is trained by the gradient of its
log-likelihood on windows around such tokens. Scoring runs forward and backward over the whole text: stretches
of words without features multiply as powers of one matrix, exactly. Marginals of featured words give the
offending offsets; a logistic curve fitted on the training documents turns their sum into a document score.

Training reads a bounded, deterministic sample: `max_each` labelled documents of each class (the smallest id hashes
outside the held-out fold), of those the whole texts. Executors count their word beginnings and find their featured
words; the driver gets the beginnings that can be features with their documents, and the places of featured words, but
no texts. Scoring covers all documents and whole texts.

Defined cases: null and empty texts score as texts without features; without toxic training rows every score is
0; contradictory labels count as toxic; rows without doc_id are scored and never held out; repeated rows are
scored each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import narrow, ship, stored
from .textscan import BYTE, U, data_of, mix, slices, word_hashes, word_spans

SCORED = "doc_id long, score double, spans array<struct<start: int, end: int, p: double>>"
#: Byte lengths of word beginnings that can be features; the whole word is one as well.
PREFIXES = range(3, 13)
#: Tasks among which word beginnings are dealt by hash.
BUCKETS = 64
LETTER = np.zeros(256, bool)
LETTER[97:123] = True
LETTER[128:] = True
_WHOLE = U(0xA5A5A5A55A5A5A5A)


@dataclass
class Model:
    hashes: np.ndarray  # sorted feature hashes
    weights: np.ndarray  # of each feature for the toxic state
    bias: float = 0.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: tuple[float, float] = (0.0, -30.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def _lowered(texts: list[str | None]) -> pa.Array:
    """Lower case, character by character where that keeps offsets."""
    out = []
    for t in texts:
        low = (t or "").lower()
        if len(low) != len(t or ""):
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in t)
        out.append(low)
    return pa.array(out, pa.large_string())


def _words(texts: pa.Array):
    data, at = data_of(texts)
    first, last = word_spans(LETTER[data], at[:-1])
    return data, at, first, last


def _beginnings(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(word numbers, hash of beginning, its length) for each length, the whole word last."""
    h, left = np.zeros(len(first), np.uint64), np.arange(len(first))
    at = first.copy()
    for n in range(1, PREFIXES.stop):
        live = at < last[left]
        left, at, h = left[live], at[live], h[live]
        h = (h ^ BYTE[data[at]]) * U(0x9E3779B97F4A7C15)
        at = at + 1
        if n >= PREFIXES.start:
            yield left, mix(h), n
    yield np.arange(len(first)), word_hashes(data, first, last) ^ _WHOLE, 99


def _counted(ids: np.ndarray, is_toxic: np.ndarray):
    """Word beginnings of the sample, packed by bucket: one entry per toxic document that has it, counts for the others."""
    order = np.argsort(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n in slices(batch.column(1)):
                number = order[np.searchsorted(ids, batch.column(0).slice(lo, n).to_numpy(), sorter=order)]
                data, at, first, last = _words(_lowered(batch.column(1).slice(lo, n).to_pylist()))
                doc = number[np.searchsorted(at, first, "right") - 1]
                found = []
                for words, h, size in _beginnings(data, first, last):
                    key, own = _pairs(h, doc[words])
                    bad = is_toxic[own.astype(np.int64)]
                    clean, count = np.unique(key[~bad], return_counts=True)
                    found.append((np.r_[key[bad], clean], np.full(int(bad.sum()) + len(clean), size),
                                  np.r_[own[bad].astype(np.int64), np.full(len(clean), -1)], np.r_[np.ones(int(bad.sum()), np.int64), count]))
                h, size, own, count = (np.concatenate(x) for x in zip(*found, strict=True))
                bucket = (h % U(BUCKETS)).astype(np.int64)
                rows = []
                for b in np.unique(bucket):
                    k = bucket == b
                    rows.append((int(b), h[k].tobytes(), size[k].astype(np.uint8).tobytes(), own[k].astype(np.int32).tobytes(), count[k].astype(np.int32).tobytes()))
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=["bucket", "keys", "sizes", "docs", "counts"])

    return run


def _marking(n1: int, n0: int):
    """Of one bucket the word beginnings that occur in toxic documents and hardly in others, with their toxic documents."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        join = lambda c, t: np.frombuffer(b"".join(pdf[c]), t)
        h, size, doc, count = join("keys", np.uint64), join("sizes", np.uint8), join("docs", np.int32), join("counts", np.int32)
        order = np.lexsort((doc, size, h))
        h, size, doc, count = h[order], size[order], doc[order], count[order].astype(np.int64)
        start = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (size[1:] != size[:-1])])
        end = np.r_[start[1:], len(h)]
        neg = np.add.reduceat(np.where(doc < 0, count, 0), start)
        pos = np.add.reduceat((doc >= 0).astype(np.int64), start)
        good = np.flatnonzero((pos >= 4) & ((pos + 0.5) / (n1 + 1) >= 20 * (neg + 0.5) / (n0 + 1)) & (neg <= 0.02 * pos + 0.5))
        docs = [doc[end[k] - pos[k]:end[k]].tobytes() for k in good]
        return pd.DataFrame({"size": size[start[good]].astype(np.int32), "key": h[start[good]].view(np.int64), "docs": docs})

    return run


def _cover(parts: list[tuple[int, int, np.ndarray]], toxic: np.ndarray, most: int = 400) -> np.ndarray:
    """Hashes of word beginnings (length, hash, toxic documents) that together mark the toxic documents, by greedy cover."""
    if not parts:
        return np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(parts)), [len(p[2]) for p in parts])
    docs = np.concatenate([p[2] for p in parts])
    length = np.array([p[0] for p in parts])
    need, chosen = np.where(toxic, 1.0, 0.0), []
    for _ in range(most):
        gain = np.bincount(owner, need[docs], len(parts))
        top = gain.max()
        if top < 1.0:
            break
        near = np.flatnonzero(gain >= 0.999 * top)
        one = near[np.argmax(np.where(length[near] == 99, 0, length[near]))]  # longest beginning of equal cover
        chosen.append(parts[one][1])
        need[parts[one][2]] *= 0.6
    return np.unique(np.array(chosen, np.uint64))


def _pairs(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return np.stack([h[keep], doc[keep].astype(np.uint64)])


def _featured(texts: pa.Array, hashes: np.ndarray):
    """(document, word number in it, feature, first byte, last byte) of every match, and words of each document."""
    data, at, first, last = _words(texts)
    upto = np.searchsorted(first, at)
    table = np.zeros(1 << 16, bool)
    table[(hashes >> U(48)).astype(np.int64)] = True
    words, features = [], []
    for w, h, _ in _beginnings(data, first, last):
        maybe = np.flatnonzero(table[(h >> U(48)).astype(np.int64)])
        k = np.searchsorted(hashes, h[maybe])
        hit = (k < len(hashes)) & (hashes[np.minimum(k, len(hashes) - 1)] == h[maybe]) if len(hashes) else np.zeros(len(maybe), bool)
        words.append(w[maybe[hit]])
        features.append(k[hit])
    w, f = np.concatenate(words), np.concatenate(features)
    order = np.lexsort((f, w))
    w, f = w[order], f[order]
    d = np.searchsorted(upto, w, "right") - 1
    return d, w - upto[d], f, first[w], last[w], np.diff(upto), data, at


def _places(hashes: np.ndarray):
    """Of each document its number of words, and the word numbers and features of its featured words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n in slices(batch.column(1)):
                d, w, f, _, _, n_words, _, _ = _featured(_lowered(batch.column(1).slice(lo, n).to_pylist()), hashes)
                at = np.searchsorted(d, np.arange(n + 1))
                pack = lambda x: pa.array([x[at[i]:at[i + 1]].astype(np.int64).tobytes() for i in range(n)], pa.binary())  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), pa.array(n_words.astype(np.int64)), pack(w), pack(f)], names=["doc_id", "n_words", "words", "features"])

    return run


def _windows(d, w, f, n_words, gold, n_features: int, side: int = 6):
    """Windows of 2 * side + 1 words around featured words: a table of each word's features, and gold states."""
    seen: dict[tuple[int, int], list[int]] = {}
    for x, y, z in zip(d.tolist(), w.tolist(), f.tolist(), strict=True):
        seen.setdefault((x, y), []).append(z)
    keys = list(seen)
    table = np.full((len(keys), 2 * side + 1, max(map(len, seen.values()), default=1)), n_features, np.int64)
    states = np.zeros((len(keys), 2 * side + 1), np.int64)
    for i, (x, y) in enumerate(keys):
        for j in range(-side, side + 1):
            own = seen.get((x, y + j))
            if own:
                table[i, j + side, :len(own)] = own
                states[i, j + side] = gold[x]
    return table, states


def _train(table: np.ndarray, states: np.ndarray, n_features: int, steps: int = 150) -> tuple[np.ndarray, float, np.ndarray]:
    """Gradient ascent (with moments) of the chain's log-likelihood; weights shrink by a quadratic penalty."""
    theta = np.zeros(n_features + 1 + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    size, width = states.shape
    gold = np.zeros_like(theta)
    np.add.at(gold, table[states == 1].ravel(), 1.0)
    gold[n_features] = states.sum()
    np.add.at(gold, n_features + 1 + (2 * states[:, :-1] + states[:, 1:]).ravel(), 1.0)
    for step in range(1, steps + 1):
        w = np.append(theta[:n_features], 0.0)
        emit = np.zeros((size, width, 2))
        emit[:, :, 1] = w[table].sum(axis=2) + theta[n_features]
        moves = theta[n_features + 1:].reshape(2, 2)
        e, t = np.exp(emit - emit.max(axis=2, keepdims=True)), np.exp(moves)
        ahead, back = np.zeros_like(e), np.ones_like(e)
        ahead[:, 0] = e[:, 0]
        for i in range(1, width):
            a = (ahead[:, i - 1] @ t) * e[:, i]
            ahead[:, i] = a / a.sum(axis=1, keepdims=True)
        for i in range(width - 2, -1, -1):
            b = (e[:, i + 1] * back[:, i + 1]) @ t.T
            back[:, i] = b / b.sum(axis=1, keepdims=True)
        p = ahead * back
        p /= p.sum(axis=2, keepdims=True)
        pair = ahead[:, :-1, :, None] * t * (e[:, 1:] * back[:, 1:])[:, :, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        grad = gold.copy()
        hit = np.zeros(n_features + 1)
        np.add.at(hit, table.ravel(), np.repeat(p[:, :, 1].ravel(), table.shape[2]))
        grad[:n_features] -= hit[:n_features]
        grad[n_features] -= p[:, :, 1].sum()
        grad[n_features + 1:] -= pair.sum(axis=(0, 1)).ravel()
        grad = grad / size - 1e-3 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return theta[:n_features], float(theta[n_features]), theta[n_features + 1:].reshape(2, 2)


class _Chain:
    """Forward-backward over a document of which only featured words are given."""

    def __init__(self, model: Model):
        self.move = np.exp(model.moves)
        self.plain = self.move * np.exp([0.0, model.bias])
        self.model = model
        self.kept: dict[int, np.ndarray] = {0: np.eye(2)}

    def power(self, n: int) -> np.ndarray:
        if n not in self.kept:
            half = self.power(n // 2)
            out = half @ half
            if n % 2:
                out = out @ self.plain
            if len(self.kept) > 4096:
                self.kept = {0: np.eye(2)}
            self.kept[n] = out / out.sum()
        return self.kept[n]

    def marginals(self, at: list[int], weight: list[float], n_words: int) -> list[float]:
        """Of each featured word; at: their word numbers in order, weight: sums of feature weights."""
        e = [np.exp([0.0, min(60.0, w + self.model.bias)]) for w in weight]
        ahead = []
        now = None
        for i, k in enumerate(at):
            if now is None:
                if k:
                    start = np.exp([0.0, self.model.bias]) @ self.power(k - 1) @ self.move
                else:
                    start = np.ones(2)
            else:
                start = now @ self.power(k - at[i - 1] - 1) @ self.move
            now = start * e[i]
            now = now / now.sum()
            ahead.append(now)
        back = self.power(n_words - 1 - at[-1]) @ np.ones(2)
        out = [0.0] * len(at)
        for i in range(len(at) - 1, -1, -1):
            p = ahead[i] * back
            out[i] = float(p[1] / p.sum())
            if i:
                back = self.power(at[i] - at[i - 1] - 1) @ (self.move @ (e[i] * back))
                back = back / back.sum()
        return out


def _marginals(d, w, f, n_words, model: Model) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[float]]]:
    """Per document with featured words: its number, its matches, the first match of each such word, and their marginals."""
    chain = _Chain(model)
    cuts = np.flatnonzero(np.diff(d)) + 1
    for own in np.split(np.arange(len(d)), cuts) if len(d) else []:
        doc = int(d[own[0]])
        number, start = np.unique(w[own], return_index=True)
        weight = np.add.reduceat(model.weights[f[own]], start)
        yield doc, own, start, chain.marginals(number.tolist(), weight.tolist(), int(n_words[doc]))


def _mass(texts: pa.Array, model: Model):
    """Per document: sum of marginals, and (first byte, last byte, marginal) of featured words."""
    d, w, f, lo, hi, n_words, data, at = _featured(texts, model.hashes)
    mass, spans = np.zeros(len(n_words)), {}
    for doc, own, start, p in _marginals(d, w, f, n_words, model):
        mass[doc] = sum(p)
        spans[doc] = [(int(lo[own[s]] - at[doc]), int(hi[own[s]] - at[doc]), q) for s, q in zip(start, p, strict=True)]
    return mass, spans, data, at


def _curve(mass: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic curve over log(0.01 + mass), by damped Newton steps with a small penalty."""
    x = np.stack([np.log(0.01 + mass), np.ones(len(mass))], axis=1)
    y = toxic.astype(float)
    b = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ b))
        g = x.T @ (y - p) - 0.05 * b
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
        b = b + np.clip(np.linalg.solve(h, g), -2, 2)
    return float(b[0]), float(b[1])


def fit(docs: DataFrame, labels: DataFrame, max_each: int = 3000) -> Model:
    """Trains on at most max_each documents of each class outside the held-out fold, chosen by id hash."""
    own = narrow(labels, {"doc_id": "long", "toxic": "int"}).filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    pick = lambda y: own.filter(F.col("toxic") == y).orderBy(*order).limit(max_each)
    chosen = pick(1).union(pick(0))  # at most 2 * max_each ids: broadcast under that bound
    rows = narrow(docs, {"doc_id": "long", "text": "string"}).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("text").alias("text"))
    rows = stored(ship(rows), "sample")
    got = rows.select("doc_id", "toxic").orderBy(*order).toArrow()
    ids, toxic = np.array(got.column("doc_id").to_pylist(), np.int64), np.array(got.column("toxic").to_pylist(), np.int64) == 1
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0))
    if not toxic.any() or toxic.all():
        return nothing
    texts = rows.select("doc_id", "text")
    counted = texts.mapInArrow(_counted(ids, toxic), "bucket int, keys binary, sizes binary, docs binary, counts binary")
    marking = counted.groupBy("bucket").applyInPandas(_marking(int(toxic.sum()), int((~toxic).sum())), "size int, key long, docs binary").toArrow().to_pylist()
    parts = sorted(((r["size"], r["key"] % (1 << 64), np.frombuffer(r["docs"], np.int32)) for r in marking), key=lambda x: x[:2])
    hashes = _cover(parts, toxic)
    if not len(hashes):
        return nothing
    places = {r["doc_id"]: r for r in texts.mapInArrow(_places(hashes), "doc_id long, n_words long, words binary, features binary").toArrow().to_pylist()}
    n_words = np.array([places[i]["n_words"] for i in ids.tolist()])
    w, f = (np.frombuffer(b"".join(places[i][c] for i in ids.tolist()), np.int64) for c in ("words", "features"))
    d = np.repeat(np.arange(len(ids)), [len(places[i]["words"]) // 8 for i in ids.tolist()])
    table, states = _windows(d, w, f, n_words, toxic.astype(int), len(hashes))
    model = Model(hashes, *_train(table, states, len(hashes)))
    mass = np.zeros(len(ids))
    for doc, _, _, p in _marginals(d, w, f, n_words, model):
        mass[doc] = sum(p)
    model.curve = _curve(mass, toxic)
    return model


def score(docs: DataFrame, model: Model, span_at: float = 0.5, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, score, spans) and the carried columns, one row per input row.

    spans are code point offsets of words whose marginal reaches span_at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        for batch in batches:
            for lo, n in slices(batch.column(1)):
                part = batch.slice(lo, n)
                mass, found, data, at = _mass(_lowered(part.column(1).to_pylist()), model)
                value = 1 / (1 + np.exp(-np.clip(model.curve[0] * np.log(0.01 + mass) + model.curve[1], -700, 700)))
                spans: list[list[dict]] = [[] for _ in range(n)]
                for doc, own in found.items():
                    heads = np.cumsum((data[at[doc]:at[doc + 1]] & 0xC0) != 0x80)  # code points up to each byte
                    spans[doc] = [{"start": int(heads[a]) - 1, "end": int(heads[b - 1]), "p": p} for a, b, p in own if p >= span_at]
                made = [part.column(0), pa.array(value if len(model.hashes) else np.zeros(n)), pa.array(spans, kind), part.column(2)]
                own = ["text"] if "text" in carry else []
                yield pa.RecordBatch.from_arrays(made + [part.column(1)] * len(own), names=["doc_id", "score", "spans", "carry", *own])

    rest = F.struct(*[F.col(f"`{c}`") for c in carry if c != "text"], F.lit(0).alias("__none"))  # text goes to Python once, as what is scored
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), rest.alias("carry"))
    own = ", text string" if "text" in carry else ""
    out = ship(rows).mapInArrow(run, f"{SCORED}, carry {rows.schema['carry'].dataType.simpleString()}{own}")
    return out.select("doc_id", "score", "spans", *[F.col("text" if c == "text" else f"carry.`{c}`").alias(c) for c in carry])
