"""Token ids of a lower-casing BPE with word ends, by the public tokenizer's own tables.

The tokenizer file decides everything: its normalizer, split pattern, vocabulary and merges. A text whose
characters are all plain (below) has the same ids word by word, so each distinct word is merged once and kept;
distinct words of a batch are merged together, one merge step of every word at a time. Any other text goes
through the tokenizer library as a whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

#: Characters for which NFC and lower-casing act on single characters and white space is plain.
_OTHER = re.compile("[^\t\n\x0b\x0c\r -~\xa1\xab\xbb\xbf-\xff]|<\\|")
#: The tokenizer's split pattern; on plain characters its letter and number classes are these.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
_LONGEST = 40


class WordBPE:
    def __init__(self, path: str, cached: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.words: dict[str, bytes] = {}
        self.cached = cached
        shown = _byte_characters()
        self.first = np.array([vocab[c] for c in shown], np.int64)
        self.last = np.array([vocab[c + "</w>"] for c in shown], np.int64)
        self.n = len(vocab) + 16
        keys = np.array([vocab[a] * self.n + vocab[b] for a, b in pairs], np.int64)
        new = np.array([vocab[a + b] for a, b in pairs], np.int64)
        _, keep = np.unique(keys, return_index=True)
        self._build(keys[keep], keep.astype(np.int64), new[keep])

    def _build(self, keys: np.ndarray, ranks: np.ndarray, new: np.ndarray) -> None:
        """Open-addressing table of the merges: (key, rank, new id)."""
        self.shift = 64 - 18
        size = 1 << 18
        self.t_key = np.full(size + 64, -1, np.int64)
        self.t_rank = np.full(size + 64, 1 << 40, np.int64)
        self.t_new = np.zeros(size + 64, np.int64)
        self.probes = 1
        at = self._slot(keys)
        left = np.arange(len(keys))
        step = 0
        while len(left):
            slot = at[left] + step
            free = self.t_key[slot] == -1
            _, one = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            one = one[free[one]]
            put = left[one]
            self.t_key[slot[one]], self.t_rank[slot[one]], self.t_new[slot[one]] = keys[put], ranks[put], new[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            step += 1
            self.probes = max(self.probes, step)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def _find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and new id of each pair; a large rank if it doesn't merge."""
        shape = a.shape
        keys = (a * self.n + b).ravel()
        hit = self._slot(keys)
        todo = np.flatnonzero(self.t_key[hit] != keys)
        for _ in range(self.probes - 1):
            todo = todo[self.t_key[hit[todo]] != -1]
            if not len(todo):
                break
            hit[todo] += 1
            todo = todo[self.t_key[hit[todo]] != keys[todo]]
        same = self.t_key[hit] == keys
        return np.where(same, self.t_rank[hit], 1 << 40).reshape(shape), self.t_new[hit].reshape(shape)

    def merge(self, parts: list[bytes]) -> list[bytes]:
        """Ids (little-endian) of each part, which is one match of the split pattern in UTF-8."""
        out: list[bytes] = [b""] * len(parts)
        by_len: dict[int, list[int]] = {}
        for i, p in enumerate(parts):
            by_len.setdefault(len(p), []).append(i)
        for n, where in by_len.items():
            if n > _LONGEST:
                for i in where:
                    out[i] = np.array(self.full.encode(parts[i].decode(), add_special_tokens=False).ids, "<u4").tobytes()
                continue
            raw = np.frombuffer(b"".join(parts[i] for i in where), np.uint8).reshape(len(where), n)
            tok = self.first[raw]
            tok[:, -1] = self.last[raw[:, -1]]
            self._merge_rows(tok, where, out)
        return out

    def _merge_rows(self, tok: np.ndarray, where: list[int], out: list[bytes]) -> None:
        rows = np.array(where)
        rank, new = self._find(tok[:, :-1], tok[:, 1:])
        while len(rows):
            if tok.shape[1] == 1:
                done = np.ones(len(rows), bool)
            else:
                p = rank.argmin(axis=1)
                done = rank[np.arange(len(rows)), p] >= 1 << 40
            data, n = tok[done].astype("<u4").tobytes(), 4 * tok.shape[1]
            for k, row in enumerate(rows[done].tolist()):
                out[row] = data[k * n:k * n + n]
            if done.all():
                return
            go = ~done
            rows, tok, rank, new, p = rows[go], tok[go], rank[go], new[go], p[go]
            line = np.arange(len(rows))
            tok[line, p] = new[line, p]
            cols = np.arange(tok.shape[1] - 1)
            tok = np.take_along_axis(tok, cols + (cols > p[:, None]), 1)
            if tok.shape[1] == 1:
                rank = new = tok[:, :0]
                continue
            cols = cols[:-1]
            src = cols + (cols >= p[:, None])
            rank, new = np.take_along_axis(rank, src, 1), np.take_along_axis(new, src, 1)
            for q in (p - 1, p):
                ok = np.flatnonzero((q >= 0) & (q < tok.shape[1] - 1))
                rank[ok, q[ok]], new[ok, q[ok]] = self._find(tok[ok, q[ok]], tok[ok, q[ok] + 1])

    def _learn(self, words: list[str]) -> None:
        parts = [[w] if w.isalpha() else _SPLIT.findall(w) for w in words]
        own = list(set().union(*parts)) if parts else []
        ids = dict(zip(own, self.merge([p.encode() for p in own]), strict=True))
        self.words.update((w, ids[ps[0]] if len(ps) == 1 else b"".join([ids[p] for p in ps])) for w, ps in zip(words, parts, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        out: list[bytes | None] = [None] * len(texts)
        if len(self.words) > self.cached:  # bounded memory: forget, then learn this batch's words
            self.words.clear()
        known, words = self.words.get, self.words
        late: list[tuple[int, list, list[int], list[str]]] = []  # text, its ids so far, places and words that lack them
        missing: set[str] = set()
        for i, t in enumerate(texts):
            if _OTHER.search(t):
                out[i] = np.array(self.full.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
                continue
            ws = t.lower().split()
            found = list(map(known, ws))
            if None not in found:
                out[i] = b"".join(found)
                continue
            places, k = [], -1
            for _ in range(found.count(None)):
                k = found.index(None, k + 1)
                places.append(k)
            own = [ws[k] for k in places]
            missing.update(own)
            late.append((i, found, places, own))
        if missing:
            self._learn(list(missing))
        for i, found, places, own in late:
            for k, w in zip(places, own, strict=True):
                found[k] = words[w]
            out[i] = b"".join(found)
        return out  # type: ignore[return-value]


@lru_cache(maxsize=1)
def loaded(path: str) -> WordBPE:
    """The tokenizer of this worker process, kept with its words from task to task."""
    return WordBPE(path)


def _byte_characters() -> list[str]:
    """The visible character that stands for each byte: printable Latin-1 ones for themselves, the rest from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]

