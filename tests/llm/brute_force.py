"""Plain statements of what the operators compute, for small tables."""

import collections
import re

import numpy as np


def table_texts(spark, folder):
    return dict(sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()))


def near_components(texts):
    """Shingle sets, and the smallest id reachable of each document."""
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    low = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                if a < b and sets[a] and low[a] != low[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    low[a] = low[b] = min(low[a], low[b])
                    changed = True
    return sets, low


def without_substrings(texts, length=50):
    """Of each document the bytes that stay, and a mark for each byte that goes."""
    first, out = {}, {}
    for i, t in sorted(texts.items()):
        b = t.encode()
        for k in range(len(b) - length + 1):
            first.setdefault(b[k:k + length], i)
    for i, t in texts.items():
        b = t.encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < i:
                gone[k:k + length] = b"\1" * length
        out[i] = bytes(x for x, g in zip(b, gone, strict=True) if not g), gone
    return out


def within_one_word(a, b):
    """Whether two lists of words differ by one replaced, inserted or deleted word."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def without_lines(texts, least=8):
    """Texts without the lines that an earlier line repeats."""
    rows = [(i, n, line, " ".join(re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" ").split(" "))) for i, t in sorted(texts.items()) for n, line in enumerate(t.split("\n"))]
    first = {}
    for i, n, _, flat in rows:
        first.setdefault(flat, (i, n))
    long_ = [(flat.split(" "), at) for flat, at in first.items() if flat.count(" ") >= least - 1]
    by_length = collections.defaultdict(list)
    for words, at in long_:
        by_length[len(words)].append((words, at))
    near = set()
    for words, at in long_:
        for k in (-1, 0, 1):
            if any(before < at and within_one_word(words, other) for other, before in by_length[len(words) + k]):
                near.add(" ".join(words))
                break
    kept = collections.defaultdict(list)
    for i, n, line, flat in rows:
        if flat == "" or (flat not in near and first[flat] == (i, n)):
            kept[i].append(line)
    return {i: "\n".join(kept[i]) for i in texts}


def packed_well(texts, rows, capacity=2048):
    """Pieces are the tokenizer's ids, sequences are gapless and hardly more than the volume asks for."""
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for i, t in texts.items():
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for k, lo in enumerate(range(0, len(ids), capacity)):
            want[i, k] = (lo, len(ids[lo:lo + capacity]), zlib.crc32(ids[lo:lo + capacity].tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= -(-sum(n for _, n, _ in want.values()) // capacity) + 1
