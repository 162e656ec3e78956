"""SentencePiece encoding as a max-plus scan, and decoding.

A segmentation into pieces is the encoder's own exactly when every two neighbouring pieces stay apart, that is when the model
merges their joined text back into these two. So the best path of a lattice whose states are pieces and whose
moves weigh 0 (stays apart) or minus infinity is the model's encoding. A document is split into chunks; the states at
a boundary are the pieces that end at it or reach across it. Each chunk yields its transfer matrix between the states of
its two boundaries on its own; matrices combine associatively in the max-plus semiring; and once that has fixed
the boundary states, each chunk is traced back on its own.

Where no piece holds two neighbouring characters, as before a space or a comma, nothing merges across: the place is a start, and
the lattice narrows to one state there. What lies between two starts is traced once per distinct string and kept.

Defined cases: null and empty texts have no pieces; rows without doc_id or repeating one are encoded each (giant ones
by row); characters without a piece become byte pieces; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow, ship, stored

MARK = "▁"
State = tuple[int, int]  # (piece id, place where it ends); (-1, place): a start, where nothing before matters


class PieceModel:
    def __init__(self, path: str, cached: int = 250_000):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.score = [sp.get_score(i) for i in range(n)]
        self.ids = {t: i for i, t in enumerate(self.text) if not special(i)}
        self.bytes = {int(t[3:5], 16): i for i, t in enumerate(self.text) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.longest = max(map(len, self.ids))
        if any(MARK in t.lstrip(MARK) for t in self.ids):
            raise ValueError("a piece of this model goes on across the start of a word")
        #: Every beginning of a piece, with the piece's id or -1.
        self.begins = {t[:n]: -1 for t in self.ids for n in range(1, len(t))} | self.ids
        #: Neighbouring characters that some piece holds; between any others is a start.
        self.pairs = {t[i:i + 2] for t in self.ids for i in range(len(t) - 1) if t[i] in self.ids and t[i + 1] in self.ids}
        self.raw = [bytes([self.byte_of[i]]) if i in self.byte_of else t.encode() for i, t in enumerate(self.text)]
        self.cached = cached
        self.apart: dict[tuple[int, int], bool] = {}
        #: Kept ids (little-endian 32-bit numbers) of what follows the mark of a word, up to the next word, and of stretches
        #: between starts; each with the entries before, of which those still asked for move over.
        self.words: dict[str, bytes] = {}
        self.words_before: dict[str, bytes] = {}
        self.stretches: dict[str, bytes] = {}
        self.stretches_before: dict[str, bytes] = {}

    def merged(self, text: str) -> list[int]:
        """The model's merges applied to a short text: the best-scored neighbouring pair first, leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = self.ids.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.score[k] > best):
                    best, at = self.score[k], i
            if best is None:
                return [self.ids[p] for p in parts]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def joins(self, a: int, b: int) -> bool:
        """Whether piece b may follow piece a."""
        key = (a, b)
        found = self.apart.get(key)
        if found is None:
            if len(self.apart) > 2_000_000:
                self.apart.clear()
            found = self.apart[key] = self.merged(self.text[a] + self.text[b]) == [a, b]
        return found

    # A character without a piece stands alone: nothing merges with it, so it is a start and an end at once.

    def is_start(self, text: str, p: int) -> bool:
        """Whether no piece covers both sides of place p, so that all states there are one."""
        return p == 0 or text[p - 1:p + 1] not in self.pairs

    def reach(self, text: str, lo: int, hi: int, states: list[State], end: bool):
        """The lattice from the given states to place hi: masks of the states that reach each (piece, place), and predecessors.

        Without `end`, the last pieces may go past hi, as far as the text given does.
        """
        masks: dict[int, dict[int, int]] = {}
        back: dict[State, list[State]] = {}
        out: dict[State, int] = {}
        for i, (piece, at) in enumerate(states):
            if at >= hi:
                out[piece, at] = out.get((piece, at), 0) | 1 << i
                back.setdefault((piece, at), [])
            else:
                own = masks.setdefault(at, {})
                own[piece] = own.get(piece, 0) | 1 << i
                back.setdefault((piece, at), [])
        top = hi if end else len(text)
        for p in range(lo, hi):
            here = masks.get(p)
            if not here:
                continue
            if self.is_start(text, p) and not (len(here) == 1 and -1 in here):
                every = 0
                for piece, m in here.items():
                    every |= m
                    if piece != -1:
                        back.setdefault((-1, p), []).append((piece, p))
                here = masks[p] = {-1: every}
            if text[p] not in self.ids:
                steps = [(-2, p + 1)]
            else:
                steps = []
                for e in range(p + 1, min(top, p + self.longest) + 1):
                    k = self.ids.get(text[p:e])
                    if k is not None:
                        steps.append((k, e))
            for k, e in steps:
                for piece, m in here.items():
                    if piece < 0 or k < 0 or self.joins(piece, k):
                        if e < hi:
                            own = masks.setdefault(e, {})
                            own[k] = own.get(k, 0) | m
                        else:
                            out[k, e] = out.get((k, e), 0) | m
                        back.setdefault((k, e), []).append((piece, p))
        return masks, out, back

    def trace(self, text: str, lo: int, hi: int, state: State, to: State, end: bool) -> list[int]:
        """Pieces from one state (not included) to another."""
        if state == to:
            return []
        masks, out, back = self.reach(text, lo, hi, [state], end)
        pieces: list[int] = []
        if to[0] == -1:  # a start: whichever piece ends there
            to = next(s for s in out if s[1] == to[1])
            if to == state:
                return []
        now = to
        while now != state:
            before = [b for b in back[now] if b == state or back.get(b)]
            piece, p = now
            if piece == -2:
                pieces += [self.bytes[b] for b in reversed(text[p - 1].encode())]
            elif piece >= 0:
                pieces.append(piece)
            now = before[0]
        return pieces[::-1]

    def trace_words(self, text: str, lo: int, hi: int, state: State, to: State, end: bool) -> list[int]:
        """As trace(), with kept words for all between the first and the last start of a word."""
        cuts = [p for p in range(max(lo, state[1]) + 1, hi) if text[p] == MARK and text[p - 1] != MARK]
        if len(cuts) < 2:
            return self.trace(text, lo, hi, state, to, end)
        out = self.trace(text, lo, cuts[0], state, (-1, cuts[0]), True)
        for a, b in zip(cuts, cuts[1:], strict=False):
            out += np.frombuffer(self.word(text[a + 1:b]), "<i4").tolist()
        return out + self.trace(text, cuts[-1], hi, (-1, cuts[-1]), to, end)

    def word(self, rest: str) -> bytes:
        """Ids of a mark and what follows it up to the next start of a word."""
        found = self.words.get(rest)
        if found is None:
            found = self.words_before.get(rest)
            if found is None:
                text, at, parts = MARK + rest, 0, []
                pairs = self.pairs
                for p in range(1, len(text)):
                    if text[p - 1:p + 1] not in pairs:
                        parts.append(self._stretch(text[at:p]))
                        at = p
                parts.append(self._stretch(text[at:]))
                found = b"".join(parts)
            if len(self.words) >= self.cached:
                self.words_before, self.words = self.words, {}
            self.words[rest] = found
        return found

    def _stretch(self, text: str) -> bytes:
        """Ids of what lies between two neighbouring starts."""
        found = self.stretches.get(text)
        if found is None:
            found = self.stretches_before.get(text)
            if found is None:
                ids = self._best(text) if text[0] in self.ids else [self.bytes[b] for b in text.encode()]
                found = np.array(ids, "<i4").tobytes()
            if len(self.stretches) >= self.cached:
                self.stretches_before, self.stretches = self.stretches, {}
            self.stretches[text] = found
        return found

    def _best(self, text: str) -> list[int]:
        """The best path from a start to the end of a text in which every character has a piece.

        Only one path has weight 0, so the lattice is walked depth first, longest pieces first, and states from which the
        end can't be reached are remembered.
        """
        n, begins, apart = len(text), self.begins, self.apart
        path: list[int] = []
        stack: list[tuple] = []
        dead: set[State] = set()
        at, piece, steps = 0, -1, None
        while at < n:
            if steps is None:
                steps = []
                for e in range(at + 1, n + 1):
                    k = begins.get(text[at:e])
                    if k is None:
                        break
                    if k >= 0:
                        steps.append((k, e))
            while steps:
                k, e = steps.pop()
                if (k, e) not in dead and (piece < 0 or (apart[piece, k] if (piece, k) in apart else self.joins(piece, k))):
                    stack.append((at, piece, steps))
                    path.append(k)
                    at, piece, steps = e, k, None
                    break
            else:
                dead.add((piece, at))
                if not stack:
                    raise ValueError(f"no path through {text!r}")
                at, piece, steps = stack.pop()
                path.pop()
        return path

    def encode(self, text: str) -> bytes:
        """Piece ids of a whole text as little-endian 32-bit numbers."""
        if not text:
            return b""
        plain = "  " not in text and text[0] != " " and MARK not in text
        parts = text.split(" ") if plain else [p[1:] for p in self._parts(prepared(text))]
        found = list(map(self.words.get, parts))
        return b"".join([self.word(w) if ids is None else ids for w, ids in zip(parts, found, strict=True)])

    def _parts(self, text: str) -> list[str]:
        cuts = [0] + [p for p in range(1, len(text)) if text[p] == MARK and text[p - 1] != MARK] + [len(text)]
        return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def boundary(self, text: str, at: int) -> list[State]:
        """All states at a place: pieces that end there or reach across it. text must show self.longest characters around."""
        if self.is_start(text, at):
            return [(-1, at)]
        found = []
        for s in range(max(0, at - self.longest), at):
            for e in range(at, min(len(text), s + self.longest) + 1):
                k = self.ids.get(text[s:e])
                if k is not None:
                    found.append((k, e))
        return sorted(set(found))

    def decode(self, ids: list[int]) -> str:
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=1)
def loaded(path: str) -> PieceModel:
    """The model of this worker process, kept with its words from task to task."""
    return PieceModel(path)


def prepared(text: str) -> str:
    """The text as the lattice sees it: a mark for each space and one in front."""
    return MARK + text.replace(" ", MARK)


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of two transfer matrices; associative."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def transfer(model: PieceModel, text: str, lo: int, hi: int, last: bool) -> tuple[list[State], list[State], np.ndarray]:
    """States at both boundaries of text[lo:hi] and the matrix between them; text shows its surroundings."""
    before = [(-1, lo)] if lo == 0 else model.boundary(text, lo)
    after = model.boundary(text, hi) if not last else None
    top = max(e for _, e in before)
    a = _start_of_word(text, range(top + 1, hi))
    b = _start_of_word(text, range(hi - 1, max(top, a) if a else top, -1)) if a else None
    if b:  # all states meet at a start, and every start leads to the next
        head = model.reach(text, lo, a, before, True)[1]
        every = 0
        for m in head.values():
            every |= m
        out = {s: every for s in model.reach(text, b, hi, [(-1, b)], last)[1]}
    else:
        out = model.reach(text, lo, hi, before, last)[1]
    if after is None:
        after = sorted(out) or [(-1, hi)]
    masks = {}
    for s in after:
        masks[s] = 0
        for (piece, e), m in out.items():
            if (piece, e) == s or (s[0] == -1 and e == s[1]):
                masks[s] |= m
    m = np.full((len(before), len(after)), -np.inf)
    for j, s in enumerate(after):
        for i in range(len(before)):
            if masks[s] >> i & 1:
                m[i, j] = 0.0
    return before, after, m


def _start_of_word(text: str, places: range) -> int | None:
    return next((p for p in places if text[p] == MARK and text[p - 1] != MARK), None)


def resolve(matrices: list[np.ndarray]) -> list[int]:
    """Index of the best path's state at each boundary, by prefix products from the left and choice from the right."""
    ahead = [matrices[0]]
    for m in matrices[1:]:
        ahead.append(max_plus(ahead[-1], m))
    at = [int(np.argmax(ahead[-1][0]))]
    for k in range(len(matrices) - 1, 0, -1):
        at.append(int(np.argmax(ahead[k - 1][0] + matrices[k][:, at[-1]])))
    return at[::-1]


#: Characters of a chunk; longer documents are split, and their chunks are dealt out on their own.
CHUNK = 32_768


def _chunks(docs: DataFrame, chunk: int, longest: int) -> DataFrame:
    """Chunks of documents longer than a chunk, each with the characters around it that its boundaries need.

    A document is cut in one pass over its characters; only chunks travel.
    """
    text = F.concat(F.lit(MARK), F.replace("text", F.lit(" "), F.lit(MARK)))
    rows = docs.select(F.monotonically_increasing_id().alias("doc"), "doc_id", text.alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, doc_id, own in zip(*batch.columns, strict=True):
                own = own.as_py()
                begins = range(0, len(own), chunk)
                for first in range(0, len(begins), 64):
                    some = begins[first:first + 64]
                    froms = [max(lo - 2 * longest, 0) for lo in some]
                    n, same = len(some), [doc.as_py()] * len(some)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(same, pa.int64()), pa.array([doc_id.as_py()] * n, pa.int64()), pa.array(range(first, first + n), pa.int32()), pa.array([len(begins)] * n, pa.int32()),
                        pa.array(some, pa.int64()), pa.array([len(own)] * n, pa.int64()), pa.array([own[f:f + chunk + 4 * longest] for f in froms], pa.string()), pa.array(froms, pa.int64()),
                    ], names=["doc", "doc_id", "k", "n", "lo", "total", "around", "from_"])

    return rows.mapInArrow(cut, "doc long, doc_id long, k int, n int, lo long, total long, around string, from_ long")


def _matrices(path: str, chunk: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loaded(path)
        for pdf in parts:
            rows = []
            for r in pdf.itertuples():
                lo = r.lo - r.from_
                hi = min(r.lo + chunk, r.total) - r.from_
                before, after, m = transfer(model, r.around, lo, hi, r.k == r.n - 1)
                shift = lambda ss: [x for p, e in ss for x in (p, e + r.from_)]  # noqa: B023, E731
                rows.append((r.doc, r.k, shift(before), shift(after), m.ravel().tolist()))
            yield pd.DataFrame(rows, columns=["doc", "k", "before", "after", "m"])

    return run


def _resolve(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("k")
    pairs = lambda x: [tuple(map(int, x[i:i + 2])) for i in range(0, len(x), 2)]
    before, after = [pairs(x) for x in pdf["before"]], [pairs(x) for x in pdf["after"]]
    ms = [np.array(m, float).reshape(len(b), len(a)) for m, b, a in zip(pdf["m"], before, after, strict=True)]
    at = resolve(ms)
    to = [a[i] for a, i in zip(after, at, strict=True)]
    come = [before[0][0], *to[:-1]]
    return pd.DataFrame({"doc": pdf["doc"], "k": pdf["k"], "p0": [s[0] for s in come], "e0": [s[1] for s in come], "p1": [s[0] for s in to], "e1": [s[1] for s in to]})


def _backtrace(path: str, chunk: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loaded(path)
        for pdf in parts:
            rows = []
            for r in pdf.itertuples():
                f = int(r.from_)
                hi = min(r.lo + chunk, r.total) - f
                ids = model.trace_words(r.around, r.lo - f, hi, (int(r.p0), int(r.e0) - f), (int(r.p1), int(r.e1) - f), r.k == r.n - 1)
                rows.append((r.doc, r.doc_id, r.k, r.n, np.array(ids, "<i4").tobytes()))
            yield pd.DataFrame(rows, columns=["doc", "doc_id", "k", "n", "ids"])

    return run


def encode_parts(docs: DataFrame, path: str, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """encode_documents() in two frames: documents of one chunk, and the chunks of longer ones."""
    own = ship(narrow(docs, {"doc_id": "long", "text": "string"})).withColumn("text", F.coalesce("text", F.lit("")))
    longest = loaded(path).longest
    fits = F.length("text") <= chunk

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                ids = [model.encode(t) for t in part.column(2).to_pylist()]
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([0] * n, pa.int32()), pa.array([1] * n, pa.int32()), pa.array(ids, pa.binary())], names=["doc", "doc_id", "k", "n", "ids"])

    schema = "doc long, doc_id long, k int, n int, ids binary"
    short = own.filter(fits).select((-1 - F.monotonically_increasing_id()).alias("doc"), "doc_id", "text").mapInArrow(whole, schema)
    chunks = stored(_chunks(own.filter(~fits), chunk, longest).repartition("doc", "k"), "chunks")  # stored: a task run again finds the same numbers
    matrices = chunks.mapInPandas(_matrices(path, chunk), "doc long, k int, before array<long>, after array<long>, m array<double>")
    fixed = matrices.groupBy("doc").applyInPandas(_resolve, "doc long, k int, p0 long, e0 long, p1 long, e1 long")
    traced = chunks.join(fixed, ["doc", "k"]).mapInPandas(_backtrace(path, chunk), schema)
    return short, traced


def encode_documents(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """(doc, doc_id, k, n, ids): piece ids of chunk k of n as little-endian 32-bit numbers; doc tells rows apart."""
    short, traced = encode_parts(docs, path, chunk)
    return short.unionByName(traced)


def summary(short: DataFrame, traced: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, text_sha256) of both parts of encoded documents; the last is of the text decoded again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        model = loaded(path)
        for batch in batches:
            rows = []
            for parts in batch.column(1):
                ids = b"".join(parts.as_py())
                text = model.decode(np.frombuffer(ids, "<i4").tolist())
                rows.append((len(ids) // 4, zlib.crc32(ids), hashlib.sha256(text.encode()).hexdigest()))
            n, crc, digest = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(digest, pa.string())], names=["doc_id", "n_ids", "ids_crc32", "text_sha256"])

    more = traced.groupBy("doc").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"))
    out = "doc_id long, n_ids long, ids_crc32 long, text_sha256 string"
    return short.select("doc_id", F.array("ids")).mapInArrow(run, out).unionByName(more.select("doc_id", "parts.ids").mapInArrow(run, out))
