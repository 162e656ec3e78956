"""Removal of byte strings that an earlier document holds, by suffix arrays.

Every string of `length` bytes (a window) is assigned to one anchor in it: the 24-byte string of smallest hash,
leftmost first. Equal windows have equal anchors, so windows of different anchors need never meet. Per anchor, the
runs of windows assigned to it are pieces of text of less than 2 * length bytes.

1. Each document's anchors go, in packed arrays, to the anchors' buckets, which find those in two documents or more.
2. Only pieces of such anchors are cut from the texts and go to the anchors' buckets. Equal pieces of one anchor
   collapse to the smallest doc_id. Where an anchor keeps several different pieces, these are joined to one text and
   sorted by the grouping construction (suffix_array.py); windows that are neighbours in that order and equal in all
   bytes form a class, and the smallest doc_id of a class decides. (A single piece has no other to compare with.)
3. Windows of a class that starts in a smaller document are removed; overlapping ones join into spans.

Documents with equal texts count once before that: of such a text, later copies go as a whole. Anchors with pieces in
more than HOT documents are dealt by window instead of by anchor, so that no bucket holds a third of all pieces.

Defined cases: a null text has no bytes; texts shorter than a window lose nothing; rows without doc_id take no part
and lose nothing; rows that repeat a doc_id are one document, so they don't remove each other's bytes, but each loses
what its own text repeats: copies and ranges are keyed by doc_id and text (`variant`); an empty table gives an empty result; other columns are ignored. Removal may cut within a character; kept bytes are hashed as they are,
and kept text replaces what is no longer a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bloom_probe, bloom_words, filter_bits, join_back, narrow, ship, stored
from .suffix_array import suffix_array
from .textscan import BYTE, U, data_of, mix, powers, release, slices

ANCHOR = 24
#: Text bytes whose anchors one bucket takes on average.
BUCKET_BYTES = 12_000_000
HOT = 20_000
#: Parts of the documents between buckets and documents; bounds the rows that buckets return.
MOST_PARTS = 4096
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
#: A place in a text, which Spark and Arrow bound to 2**31 bytes; the rest of an anchor's key is its hash's first 33 bits.
_PLACE = U((1 << 31) - 1)


def rolling(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of every string of k bytes, from a running sum of BYTE[b] * base**-i that base**i scales back."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * powers(len(data), _INVERSE), out=total[1:])
    return mix((total[k:] - total[:-k]) * powers(len(data) - k + 1, _BASE))


def windows(data: np.ndarray, at: np.ndarray, length: int):
    """Runs of windows with one anchor: (first window, windows, document, anchor hash), for texts that lie in a row."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.astype(np.uint64)
    h = rolling(data, ANCHOR)
    key = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    span = length - ANCHOR + 1
    width = 1
    while width * 2 <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if span > width:
        key = np.minimum(key[:len(key) - (span - width)], key[span - width:])
    place = (key & _PLACE).astype(np.int64)  # anchor of each window
    lens = np.diff(at)
    doc = np.repeat(np.arange(len(lens)), lens)[:len(place)]
    good = np.arange(len(place)) + length <= at[doc + 1]
    w = np.flatnonzero(good)
    if not len(w):
        return none, none, none, none.astype(np.uint64)
    a, d = place[w], doc[w]
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (d[1:] != d[:-1])])
    return w[new], np.diff(np.r_[new, len(w)]), d[new], h[a[new]]


def _by_bucket(bucket: np.ndarray):
    """(bucket, places of its entries) of each bucket that occurs."""
    order = np.argsort(bucket, kind="stable")
    own = bucket[order]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else own
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(own)], strict=False):
        yield int(own[a]), order[a:b]


def _anchors_out(length: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, k in slices(batch.column(1)):
                data, at = data_of(batch.column(1).slice(lo, k))
                ids = batch.column(0).slice(lo, k).to_numpy()
                _, _, doc, h = windows(data, at, length)
                rows = []
                for b, own in _by_bucket((h >> U(33)).astype(np.int64) % n):
                    docs, counts = np.unique(doc[own], return_counts=True)
                    rows.append((b, ids[docs].tobytes(), counts.astype(np.uint32).tobytes(), (h[own] & U(0xFFFFFFFF)).astype(np.uint32).tobytes()))
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=["bucket", "docs", "counts", "anchors"])

    return run


def _packed(docs: np.ndarray, values: np.ndarray, parts: int) -> pd.DataFrame:
    """Values (rows of 64-bit numbers, sorted by document) packed by part of the documents: few rows for any number of them."""
    part = (mix(docs.view(np.uint64)) % U(parts)).astype(np.int64)
    rows = []
    for b, own in _by_bucket(part):
        ids, counts = np.unique(docs[own], return_counts=True)
        rows.append((b, ids.tobytes(), counts.astype(np.int64).tobytes(), values[own].tobytes()))
    return pd.DataFrame(rows, columns=["part", "docs", "counts", "own"])


def _by_document(width: int):
    """One row per document of a part, with all its values from all buckets."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        docs = np.repeat(np.frombuffer(b"".join(pdf["docs"]), np.int64), np.frombuffer(b"".join(pdf["counts"]), np.int64))
        values = np.frombuffer(b"".join(pdf["own"]), np.uint64).reshape(-1, width)
        order = np.argsort(docs, kind="stable")
        docs, values = docs[order], values[order]
        cut = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
        ends = np.r_[cut[1:], len(docs)]
        return pd.DataFrame({"id": docs[cut], "own": [values[i:j].tobytes() for i, j in zip(cut, ends, strict=True)]})

    return run


PACKED = "part int, docs binary, counts binary, own binary"


def _repeated(parts: int):
    """The anchors of one bucket that two documents or more have (by 32 further bits: a superset), for each of these."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        release()
        docs = np.repeat(np.frombuffer(b"".join(pdf["docs"]), np.int64), np.frombuffer(b"".join(pdf["counts"]), np.uint32))
        h = np.frombuffer(b"".join(pdf["anchors"]), np.uint32)
        order = np.argsort(h, kind="stable")
        key, d = h[order], docs[order]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[start, len(key)])
        live = np.repeat(np.minimum.reduceat(d, start) < np.maximum.reduceat(d, start), size)
        hot = np.repeat(size > HOT, size)[live]
        d, key = d[live], key[live]
        full = key.astype(np.uint64) | (hot.astype(np.uint64) << U(32)) | (U(int(pdf["bucket"].iloc[0])) << U(33))
        order = np.lexsort((full, d))
        d, full = d[order], full[order]
        keep = np.ones(len(d), bool)
        keep[1:] = (d[1:] != d[:-1]) | (full[1:] != full[:-1])
        return _packed(d[keep], full[keep], parts)

    return run


def _pieces_out(length: int, n: int, told: bool):
    """Pieces of repeated anchors, packed by bucket: document, variant if told, first byte, bytes, and the key whose pieces must meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, k in slices(batch.column(1)):
                data, at = data_of(batch.column(1).slice(lo, k))
                ids = batch.column(0).slice(lo, k).to_numpy()
                first, count, doc, h = windows(data, at, length)
                if not len(first):
                    continue
                variants = batch.column(3).slice(lo, k).to_numpy()
                wanted = np.unique(np.frombuffer(b"".join(batch.column(2).slice(lo, k).to_pylist()), np.uint64))
                mine = (h & U(0xFFFFFFFF)) | ((h >> U(33)).astype(np.int64) % n).astype(np.uint64) << U(33)
                hot = np.isin(mine | (U(1) << U(32)), wanted)
                live = np.flatnonzero(hot | np.isin(mine, wanted))
                first, count, doc, h, hot = first[live], count[live], doc[live], h[live], hot[live]
                if hot.any():  # each window on its own, keyed by its content
                    c = count[hot]
                    w = np.repeat(first[hot], c) + np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
                    content = rolling(data, length)[w]
                    first, count = np.r_[first[~hot], w], np.r_[count[~hot], np.ones(len(w), np.int64)]
                    doc, h = np.r_[doc[~hot], np.repeat(doc[hot], c)], np.r_[h[~hot], content]
                size = count + length - 1
                rows = []
                for b, own in _by_bucket((h % U(n)).astype(np.int64)):
                    s = size[own]
                    inside = np.arange(int(s.sum())) - np.repeat(np.cumsum(s) - s, s)
                    rows.append((b, h[own].tobytes(), ids[doc[own]].tobytes(), variants[doc[own]].tobytes() if told else b"", (first[own] - at[doc[own]]).astype(np.int64).tobytes(),
                                 s.astype(np.uint16).tobytes(), data[np.repeat(first[own], s) + inside].tobytes()))
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                                     names=["bucket", "anchors", "docs", "variants", "firsts", "sizes", "bytes"])

    return run


def window_minima(pieces: list[bytes], owner: np.ndarray, length: int) -> list[np.ndarray]:
    """For each window of each piece, the smallest owner of an equal window.

    A window whose hash no other window has is equal to none, so pieces are first narrowed to the stretch from their
    first to their last window with a shared hash. One suffix array over these stretches decides by their bytes.
    """
    size = np.array([len(p) for p in pieces])
    n_win = size - length + 1
    out = [np.full(n, o) for n, o in zip(n_win.tolist(), owner.tolist(), strict=True)]
    at = np.cumsum(size) - size
    step = np.arange(int(n_win.sum())) - np.repeat(np.cumsum(n_win) - n_win, n_win)
    h = rolling(np.frombuffer(b"".join(pieces), np.uint8), length)[np.repeat(at, n_win) + step]
    _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count[inverse] > 1)
    which = np.repeat(np.arange(len(size)), n_win)[shared]
    turn = np.flatnonzero(np.r_[True, which[1:] != which[:-1]]) if len(which) else which
    stretches: dict[bytes, int] = {}
    places = []
    for a, b in zip(turn.tolist(), np.r_[turn[1:], len(which)].tolist() if len(which) else [], strict=True):
        i, lo, hi = int(which[a]), int(step[shared[a]]), int(step[shared[b - 1]]) + length
        text = pieces[i][lo:hi]
        stretches[text] = min(int(owner[i]), stretches.get(text, int(owner[i])))
        places.append((i, lo, text))
    found = dict(zip(stretches, _sorted_minima(list(stretches), np.array(list(stretches.values())), length), strict=True)) if stretches else {}
    for i, lo, text in places:
        out[i][lo:lo + len(text) - length + 1] = found[text]
    return out


def _sorted_minima(pieces: list[bytes], owner: np.ndarray, length: int) -> list[np.ndarray]:
    """For each window of each piece, the smallest owner of an equal window, by one suffix array over all pieces."""
    sizes = np.array([len(p) for p in pieces])
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int64)
    at = np.r_[0, np.cumsum(sizes + 1)]
    text += 2
    text[at[1:] - 1] = 1
    sa = suffix_array(text)
    piece = np.searchsorted(at, sa, "right") - 1
    fits = sa + length < at[piece + 1]
    sa, piece = sa[fits], piece[fits]
    view = np.lib.stride_tricks.sliding_window_view(text.astype(np.uint16), length)
    same = np.zeros(len(sa), bool)
    for lo in range(1, len(sa), 100_000):
        hi = min(lo + 100_000, len(sa))
        same[lo:hi] = (view[sa[lo:hi]] == view[sa[lo - 1:hi - 1]]).all(axis=1)
    start = np.flatnonzero(~same)
    low = np.repeat(np.minimum.reduceat(owner[piece], start), np.diff(np.r_[start, len(sa)]))
    out = np.zeros(len(text), np.int64)
    out[sa] = low
    return [out[at[i]:at[i] + sizes[i] - length + 1] for i in range(len(pieces))]


def _piece_hashes(text: bytes, at: np.ndarray, size: np.ndarray, length: int, most: int = 2_000_000) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    power = powers(2 * length)
    out = np.empty(len(size), np.uint64)
    lo = 0
    while lo < len(size):  # work space is bounded by `most` bytes of text
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most)))
        s = size[lo:hi]
        begin = at[lo:hi] - at[lo]
        inside = np.arange(int(s.sum())) - np.repeat(begin, s)
        out[lo:hi] = np.add.reduceat(BYTE[raw[at[lo]:at[lo] + len(inside)]] * power[inside], begin)
        lo = hi
    return mix(out + size.astype(np.uint64))


def _merged(doc: np.ndarray, variant: np.ndarray | None, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching ranges of each document's variant joined: documents in order, and (first, end[, variant])."""
    order = np.lexsort((lo, doc) if variant is None else (lo, variant, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    other = doc[1:] != doc[:-1]
    if variant is not None:
        variant = variant[order]
        other |= variant[1:] != variant[:-1]
    turn = np.cumsum(np.r_[False, other])
    del other
    wide = int(hi.max()) + 1
    reach = np.maximum.accumulate(turn * wide + hi)
    new = np.flatnonzero(np.r_[True, turn[1:] * wide + lo[1:] > reach[:-1]])
    end = reach[np.r_[new[1:], len(doc)] - 1] - turn[new] * wide
    return doc[new], np.stack([lo[new], end] if variant is None else [lo[new], end, variant[new]], axis=1)


def _decide(length: int, parts: int, told: bool, block: int = 400_000):
    """Removed byte ranges of one bucket's pieces, packed by part of the documents.

    block bounds the bytes that one suffix array sorts, unless one anchor has more: its lists take some 250 times as much.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        release()
        join = lambda c, t: np.frombuffer(b"".join(pdf[c]), t)
        h, doc, first = join("anchors", np.uint64), join("docs", np.int64), join("firsts", np.int64)
        tags = (doc, join("variants", np.int64)) if told else (doc,)
        size, text = join("sizes", np.uint16).astype(np.int64), b"".join(pdf["bytes"])
        at = np.cumsum(size) - size
        content = _piece_hashes(text, at, size, length)
        order = np.lexsort((doc, content, h))
        hs, cs = h[order], content[order]
        new = np.r_[True, (hs[1:] != hs[:-1]) | (cs[1:] != cs[:-1])]
        which = np.cumsum(new) - 1
        rep = order[np.flatnonzero(new)]  # one per distinct piece: the one with the smallest doc
        owner, anchor = doc[rep], h[rep]
        turn = np.r_[True, anchor[1:] != anchor[:-1], True]
        alone = turn[:-1] & turn[1:]
        ranges = []
        own = np.flatnonzero(alone[which] & (doc[order] > owner[which]))  # equal pieces of a smaller doc, nothing else to compare
        ranges.append((*(t[order[own]] for t in tags), first[order[own]], first[order[own]] + size[order[own]]))
        several = np.flatnonzero(~alone)
        begin = np.searchsorted(which, several)
        end = np.searchsorted(which, several, "right")
        lo = 0
        while lo < len(several):  # blocks of whole anchors
            hi, used = lo + 1, size[rep[several[lo]]]
            while hi < len(several) and (used < block or anchor[several[hi]] == anchor[several[hi - 1]]):
                used += size[rep[several[hi]]]
                hi += 1
            pieces = [text[at[r]:at[r] + size[r]] for r in rep[several[lo:hi]]]
            for k, low in enumerate(window_minima(pieces, owner[several[lo:hi]], length), lo):
                rows = order[begin[k]:end[k]]
                gone = low[None, :] < doc[rows][:, None]
                r, w = np.nonzero(gone)
                if len(r):
                    start = first[rows[r]] + w
                    ranges.append((*(t[rows[r]] for t in tags), start, start + length))
            lo = hi
        *tag, lo_, hi_ = (np.concatenate(x) for x in zip(*ranges, strict=True))
        if not len(lo_):
            return pd.DataFrame({"part": [], "docs": [], "counts": [], "own": []})
        docs, pairs = _merged(tag[0], tag[1] if told else None, lo_, hi_)
        return _packed(docs, pairs, parts)

    return run


def _cut(told: bool):
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, k in slices(batch.column(1)):
                rows = []
                part = batch.slice(lo, k)
                for i, t, packed, variant in zip(*(part.column(c).to_pylist() for c in (0, 1, 2, 4)), strict=True):
                    data = np.frombuffer((t or "").encode(), np.uint8)
                    pairs = np.frombuffer(packed, np.int64).reshape(-1, 3 if told else 2)
                    if told:
                        pairs = pairs[pairs[:, 2] == variant]
                    change = np.bincount(pairs[:, 0], minlength=len(data) + 1) - np.bincount(pairs[:, 1], minlength=len(data) + 1)
                    gone = np.cumsum(change)[:len(data)] > 0
                    kept = data[~gone].tobytes()
                    spans = int((gone & ~np.r_[False, gone[:-1]]).sum())
                    rows.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
                if rows:
                    cols = list(zip(*rows, strict=True))
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                    made = [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([*made, part.column(3)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "carry"])

    return run


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"


def _split(df: DataFrame, ids: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Rows of df that may have a doc_id in ids (all that do), and the rest, without a shuffle."""
    bits = filter_bits(n)
    marked = bloom_probe(df, bloom_words(ids, [F.xxhash64("id")], bits), [F.xxhash64("doc_id")], bits, "__in")
    return marked.filter("__in").drop("__in"), marked.filter("not __in").drop("__in")


def _digest() -> Column:
    return F.unhex(F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256))


def _same_texts(own: DataFrame) -> tuple[DataFrame, int, DataFrame, int]:
    """(id) of documents with several texts; (id), or if there are such (id, digest), of texts that an earlier document has as a whole; counts."""
    rows = stored(own.filter("doc_id IS NOT NULL").select("doc_id", _digest().alias("digest")), "texts")
    total = rows.count()
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")).filter("n > 1")
    several = rows.groupBy(F.col("doc_id").alias("id")).agg(F.min(F.xxhash64("digest")).alias("a"), F.max(F.xxhash64("digest")).alias("b")).filter("a <> b")
    several = stored(several.select("id"), "several", total)
    n_several = several.count()
    later = stored(join_back(rows, groups, ["digest"], "n", max(1, total)).filter("doc_id > low").select(F.col("doc_id").alias("id"), *(["digest"] if n_several else [])).distinct(), "later", total)
    return several, n_several, later, later.count()


def _with_variant(own: DataFrame, several: DataFrame, n: int) -> DataFrame:
    """Adds the number that tells the texts of one doc_id apart: of the digest where there are several, else 0."""
    none = F.lit(0).cast("long").alias("variant")
    if not n:
        return own.select("*", none)
    maybe, rest = _split(own, several, n)
    found = maybe.join(several, F.col("doc_id") == F.col("id"), "left")
    return rest.select("*", none).unionByName(found.select(*own.columns, F.when(F.col("id").isNotNull(), F.xxhash64(_digest())).otherwise(none).alias("variant")))


def substring_dedup(docs: DataFrame, length: int = 50, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text) and the carried columns, one row per input row."""
    rest = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(0)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), rest.alias("carry"))
    ship(own)
    n_text = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-n_text // BUCKET_BYTES))
    several, n_several, later, n_later = _same_texts(own)
    told = n_several > 0
    kind = own.schema["carry"].dataType.simpleString()
    own = _with_variant(own, several, n_several)
    maybe, rest = _split(own, later, n_later)
    same_id = same_text = F.col("doc_id") == F.col("id")
    if told:
        maybe = maybe.withColumn("__digest", _digest())
        same_text = same_id & (F.col("__digest") == F.col("digest"))
    firsts = rest.unionByName(maybe.join(later, same_text, "left_anti").drop("__digest"))
    whole = maybe.join(later, same_text, "left_semi")

    used = firsts.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length)).select("doc_id", "text", "variant")
    found = used.mapInArrow(_anchors_out(length, n), "bucket int, docs binary, counts binary, anchors binary")
    parts = min(n, MOST_PARTS)
    repeated = found.repartition(n, "bucket").groupBy("bucket").applyInPandas(_repeated(parts), PACKED)
    wanted = stored(repeated.groupBy("part").applyInPandas(_by_document(1), "id long, own binary"), "anchors")
    touched, _ = _split(used, wanted.select("id"), wanted.count())
    cut = touched.join(wanted, same_id).select("doc_id", "text", "own", "variant")
    pieces = cut.mapInArrow(_pieces_out(length, n, told), "bucket int, anchors binary, docs binary, variants binary, firsts binary, sizes binary, bytes binary")
    ranges = pieces.repartition(n, "bucket").groupBy("bucket").applyInPandas(_decide(length, parts, told), PACKED)
    ranges = stored(ranges.groupBy("part").applyInPandas(_by_document(3 if told else 2), "id long, own binary").withColumnRenamed("own", "ranges"), "ranges")

    changed, same = _split(firsts, ranges.select("id"), ranges.count())
    joined = changed.join(ranges, same_id, "left").select("doc_id", "text", "ranges", "carry", "variant")
    some = joined.filter("ranges IS NOT NULL").mapInArrow(_cut(told), f"{RESULT}, carry {kind}")
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long")
    zero = F.lit(0).cast("long")
    untouched = same.unionByName(joined.filter("ranges IS NULL").drop("ranges")).unionByName(whole.filter(size < length).drop("__digest")).select(
        "doc_id", size.alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("kept_sha256"), text.alias("kept_text"), "carry")
    removed = whole.filter(size >= length).select(
        "doc_id", size.alias("n_bytes"), size.alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.lit(_EMPTY).alias("kept_sha256"), F.lit("").alias("kept_text"), "carry")
    out = some.unionByName(untouched).unionByName(removed)
    return out.select(*[c for c in out.columns if c != "carry"], *[F.col(f"carry.`{c}`").alias(c) for c in carry])


#: SHA-256 of no bytes.
_EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
