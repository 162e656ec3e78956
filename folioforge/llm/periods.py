"""Periodic runs of words by refinement of equal-factor classes.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no neighbouring word extends. The
positions of a document are classed by the factor of `length` words that begins there. Classes of one length are refined to
the next: two positions stay together if their next positions are together. Wherever neighbouring members of a class are
exactly `length` apart a square begins, and squares that begin at consecutive positions are one run. (If a member lies
between, the square's root is itself a power, and the run is found at the smaller length.)

The first lengths are refined for all documents of a batch at once, since prose has no repeated factors beyond a few words. What is
left is refined by the smaller half: of the parts into which a class falls all but the largest are the next step's
splitters, so that each move of a position at least halves its class, and members are linked lists whose gaps are kept in
sets by width. Runs of `power` periods put POWER - 1 members into each class, and smaller classes are dropped.

Defined cases: a null text has no words; a text of white space neither; rows that repeat a doc_id, or have none, are texts of their own;
an empty table gives an empty result; columns other than doc_id and text are ignored. Work space is that of one slice of
texts, or of the longest text.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import narrow, ship
from .textscan import SPACE, U, data_of, mix, slices, word_hashes, word_spans

#: Lengths that are refined for a whole slice at once.
TOGETHER = 12
RUN = "struct<start:bigint,length:bigint,period:bigint>"
MADE = f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed_text string"


def _merged(begins: np.ndarray, period: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs whose squares begin at the sorted positions."""
    if not len(begins):
        return []
    cut = np.flatnonzero(np.diff(begins) != 1)
    first, last = begins[np.r_[0, cut + 1]], begins[np.r_[cut, len(begins) - 1]]
    return [(int(a), int(b - a) + 2 * period, period) for a, b in zip(first, last, strict=True)]


class Classes:
    """Classes of equal factors of one document, from a given length on, up to length `most`.

    Links are arrays of numbers, -1 for none, and only gaps of at most `most` are kept, so a position takes some hundred bytes.
    """

    def __init__(self, positions: list[int], classes: list[int], n: int, length: int, least: int, most: int):
        self.n, self.length, self.least, self.most = n, length, least, most
        self.of, self.before, self.after = (array("q", [-1]) * n for _ in range(3))
        self.alive = len(positions)
        for i, c in zip(positions, classes, strict=True):
            self.of[i] = c
        self.gaps: dict[int, set[int]] = {}
        self.head: dict[int, int] = {}
        self.size: dict[int, int] = {}
        members: dict[int, list[int]] = {}
        for i, c in zip(positions, classes, strict=True):
            members.setdefault(c, []).append(i)
        self.fresh = max(members, default=0) + 1
        for c, own in members.items():
            self._link(c, own)
        # No class is known to be a largest half yet, so all are splitters; a position whose next one has no class goes.
        self.small = members
        self.gone = [i + 1 for i in positions if i + 1 < n and self.of[i + 1] < 0]

    def _gap(self, a: int, b: int, there: bool) -> None:
        if b - a > self.most:
            return
        if there:
            self.gaps.setdefault(b - a, set()).add(a)
        else:
            self.gaps[b - a].discard(a)

    def _link(self, c: int, own: list[int]) -> None:
        self.head[c], self.size[c] = own[0], len(own)
        for i in own:
            self.of[i] = c
        for a, b in zip(own, own[1:], strict=False):
            self.after[a], self.before[b] = b, a
            self._gap(a, b, True)

    def _unlink(self, i: int) -> None:
        c, a, b = self.of[i], self.before[i], self.after[i]
        self.before[i] = self.after[i] = -1
        self.size[c] -= 1
        if a >= 0:
            self._gap(a, i, False)
            self.after[a] = b
        else:
            self.head[c] = b
        if b >= 0:
            self._gap(i, b, False)
            self.before[b] = a
            if a >= 0:
                self._gap(a, b, True)

    def _members(self, c: int) -> list[int]:
        out, i = [], self.head[c]
        for _ in range(self.size[c]):
            out.append(i)
            i = self.after[i]
        return out

    def _drop(self, own: list[int], gone: list[int]) -> None:
        for i in own:
            self._unlink(i)
            self.of[i] = -1
        self.alive -= len(own)
        gone += own

    def squares(self) -> list[int]:
        return sorted(self.gaps.get(self.length, ()))

    def refine(self) -> None:
        """To classes of factors that are one word longer."""
        gone: list[int] = []
        last = [i for i in dict.fromkeys([*(j - 1 for j in self.gone), self.n - self.length]) if i >= 0 and self.of[i] >= 0]
        touched = {self.of[i] for i in last}
        self._drop(last, gone)
        parts: dict[int, dict[int, list[int]]] = {}
        for d, own in self.small.items():
            for j in own:
                c = self.of[j - 1] if j else -1
                if c >= 0:
                    parts.setdefault(c, {}).setdefault(d, []).append(j - 1)
        small: dict[int, list[int]] = {}
        for c, by in parts.items():
            touched.discard(c)
            rest = self.size[c] - sum(map(len, by.values()))
            pieces = sorted(by.values(), key=len)
            if rest == 0:
                stays = pieces.pop()  # keeps the class
                largest = len(stays)
            else:
                largest = max(rest, len(pieces[-1]))
            spared = rest == 0 or rest == largest  # the part that keeps the class is a largest one
            for own in pieces:
                for i in own:
                    self._unlink(i)
                fresh, self.fresh = self.fresh, self.fresh + 1
                self._link(fresh, own)
                if len(own) < self.least:
                    self._drop(own, gone)
                elif spared or len(own) < largest:
                    small[fresh] = own
                else:
                    spared = True  # of equal largest parts the first is no splitter
            if 0 < self.size[c] < self.least:
                self._drop(self._members(c), gone)
            elif rest and rest < largest:
                small[c] = self._members(c)
        for c in touched:
            if 0 < self.size[c] < self.least:
                self._drop(self._members(c), gone)
        self.small, self.gone = small, gone
        self.length += 1


def word_runs(words: np.ndarray, at: np.ndarray, least_length: int, power: int) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each document; words are numbers, at where each document's begin (one more than documents)."""
    n = np.diff(at)
    doc = np.repeat(np.arange(len(n)), n)
    found: list[list[tuple[int, int, int]]] = [[] for _ in n]
    least = max(2, power - 1)
    most = n // power  # longest period that can have so many
    keep = lambda c, i: i[np.bincount(c, minlength=1)[c] >= least]
    classes = np.full(len(words) + 1, -1, np.int64)

    def classed(key: np.ndarray, i: np.ndarray) -> np.ndarray:
        c = np.unique(key, return_inverse=True)[1]
        alive = keep(c, i)
        new = np.full(len(words) + 1, -1, np.int64)
        new[i] = c
        out = np.full(len(words) + 1, -1, np.int64)
        out[alive] = new[alive]
        return out

    def put(begins: np.ndarray, period: int) -> None:
        for start, length, q in _merged(begins, period):
            if length >= max(least_length, power * q):
                d = int(doc[start])
                found[d].append((start - int(at[d]), length, q))

    i = np.arange(len(words))
    classes = classed(mix(words + mix(doc.astype(np.uint64) + U(1))), i) if len(words) else classes
    last = np.zeros(len(words) + 1, bool)
    last[at[1:][n > 0] - 1] = True
    length = 1
    while True:
        i = np.flatnonzero(classes[:-1] >= 0)
        i = i[length <= most[doc[i]]]
        if not len(i) or length > TOGETHER:
            break
        s = i[np.argsort(classes[i], kind="stable")]
        near = (classes[s[1:]] == classes[s[:-1]]) & (s[1:] - s[:-1] == length)
        put(np.sort(s[:-1][near]), length)
        i = i[~last[i]]
        i = i[classes[i + 1] >= 0]
        wide = int(classes.max()) + 1
        classes = classed(classes[i] * wide + classes[i + 1], i)
        length += 1
    for d in np.unique(doc[i]):
        own = i[doc[i] == d] if len(n) < 3 else i[np.searchsorted(i, at[d]):np.searchsorted(i, at[d + 1])]
        state = Classes((own - at[d]).tolist(), classes[own].tolist(), int(n[d]), length, least, int(most[d]))
        while state.alive and state.length <= most[d]:
            if begins := state.squares():
                put(np.array(begins) + at[d], state.length)
            state.refine()
    for own in found:
        own.sort(key=lambda r: (r[0], r[2]))
    return found


def periodic_runs(docs: DataFrame, least_length: int = 6, power: int = 4) -> DataFrame:
    """(doc_id, n_words, runs, collapsed_text), one row per input row.

    runs: of length >= max(least_length, power * period), by start, then period. collapsed_text: the words in no run but in its
    first period, joined by one space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n in slices(batch.column(1)):
                texts = batch.column(1).slice(lo, n)
                data, at = data_of(texts)
                first, last = word_spans(~SPACE[data], at[:-1])
                upto = np.searchsorted(first, at)
                runs = word_runs(word_hashes(data, first, last), upto, least_length, power)
                kept = []
                for k, own in enumerate(runs):
                    words = data[at[k]:at[k + 1]].tobytes().split()
                    if own:
                        stays = np.ones(len(words), bool)
                        for start, length, q in own:
                            stays[start + q:start + length] = False
                        words = [words[x] for x in np.flatnonzero(stays)]
                    kept.append(b" ".join(words))
                listed = [[{"start": a, "length": b, "period": q} for a, b, q in own] for own in runs]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), pa.array(np.diff(upto)), pa.array(listed, kind), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed_text"])

    return ship(narrow(docs, {"doc_id": "long", "text": "string"})).mapInArrow(run, MADE)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def planted(doc_id: Column, text: Column) -> Column:
    """The text with its tail made periodic where the id's checksum is divisible by ten, as the query's contract states."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")

    def bent(w: Column) -> Column:
        a = F.pmod(g, F.size(w).cast("long"))
        p = F.lit(1) + F.floor((F.size(w) - a) / (F.lit(3) + g % 8)).cast("long")
        return F.array_join(F.transform(w, lambda x, i: F.when(i >= a, F.get(w, (a + (i - a) % p).cast("int"))).otherwise(x)), " ")

    new = F.get(F.transform(F.array(words_of(text)), lambda w: F.when(F.size(w) > 0, bent(w)).otherwise(F.lit(""))), 0)
    return F.when(h % 10 == 0, new).otherwise(text)
