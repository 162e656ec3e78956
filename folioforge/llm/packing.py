"""Best-fit packing with certified bin counts.

Documents become token counts once; only (doc_id, piece, start, length) rows move after that. They are dealt by
hash to partitions of bounded size, each packed by best-fit decreasing. Dual feasible functions give a lower bound
of each partition's bins; a partition that meets its bound is certified, and all but its emptiest sequence are final. In
the others, only full sequences are. Pieces of all other sequences, those with gaps, are exchanged between partitions
and packed again, as long as that saves sequences.

Defined cases: null and empty texts are the end token alone (length 1); rows repeated with one doc_id are packed
as often as they come; null doc_ids are packed; pieces of equal length go in order of doc_id and piece, and of bins with equal
room the one that got it last is taken; texts longer than a sequence are cut into whole sequences and a
rest; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow, ship, stored
from .textscan import release

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long, certified boolean"
END = b"\0\0\0\0"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each whole text's ids and the end id, cut only if too long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .word_bpe import loaded

        bpe = loaded(tokenizer)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo in range(0, len(ids), 256):
                texts = [t or "" for t in batch.column(1).slice(lo, 256).to_pylist()]
                rows: list[tuple] = []
                for doc, enc in zip(ids[lo:lo + 256], bpe.encode(texts), strict=True):
                    enc += END
                    for k, at in enumerate(range(0, len(enc), 4 * capacity)):
                        cut = enc[at:at + 4 * capacity]
                        rows.append((doc, k, at // 4, len(cut) // 4, zlib.crc32(cut)))
                cols = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
            release()

    return ship(narrow(docs, {"doc_id": "long", text: "string"})).mapInArrow(run, PIECES)


def lower_bound(counts: np.ndarray) -> int:
    """Least number of bins by dual feasible functions; counts[s] items of size s, capacity len(counts) - 1."""
    cap = len(counts) - 1
    sizes = np.arange(cap + 1, dtype=np.int64)
    weight = counts * sizes
    best = -(-int(weight.sum()) // cap)
    n_up, w_up = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]]), np.concatenate([[0], np.cumsum(weight)])
    for low in range(1, cap // 2 + 1):  # items over cap - low fill a bin, those under low count nothing
        middle = int(w_up[cap - low + 1] - w_up[low])
        best = max(best, int(n_up[cap - low + 1]) - (-middle // cap))
    for k in range(1, 65):  # rounding to k-ths
        q, r = divmod((k + 1) * sizes, cap)
        scaled = np.where(r == 0, sizes * k, q * cap)  # times k * cap
        best = max(best, -(-int((counts * scaled).sum()) // (k * cap)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: bin and offset of each item, and the number of bins."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, made = 0, 0
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fit = open_rooms >> size
        if fit:
            r = size + (fit & -fit).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_rooms ^= 1 << r
        else:
            r, b = capacity, made
            made += 1
        bins[i], offsets[i] = b, capacity - r
        if left := r - size:
            if not room[left]:
                open_rooms |= 1 << left
            room[left].append(b)
    return bins, offsets, made


def _packer(capacity: int, turn: int):
    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        release()
        pdf = pdf.sort_values(["doc_id", "piece"], kind="stable")
        lengths = pdf["length"].to_numpy(np.int64)
        bins, offsets, made = best_fit(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1))
        fill = np.bincount(bins, lengths, made).astype(np.int64)
        final = fill == capacity
        if made == bound:  # certified: all but the emptiest sequence, which others may fill
            final |= np.arange(made) != fill.argmin()
        base = (turn << 58) + (int(key[0]) << 28)
        return pdf.assign(sequence_id=base + bins, offset=offsets, certified=final[bins])[
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified"]]

    return pack


def pack(pieces: DataFrame, capacity: int = 2048, per_partition: int = 100_000, rounds: int = 2) -> DataFrame:
    """Pieces with sequence_id, offset and certified; per_partition bounds the rows that one task packs."""
    rows = stored(pieces, "pieces")
    left, done, turn = rows, None, 0
    while True:
        n = left.count()
        parts = max(1, -(-n // per_partition))
        dealt = left.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", F.lit(turn)), F.lit(parts)))
        packed = stored(dealt.groupBy("part").applyInPandas(_packer(capacity, turn), PACKED), f"packed{turn}")
        if turn:
            count = lambda d: d.select("sequence_id").distinct().count()
            if count(packed) >= count(open_):
                return done.unionByName(open_)
        fixed, open_ = packed.filter("certified"), packed.filter("not certified")
        done = fixed if done is None else done.unionByName(fixed)
        turn += 1
        if parts == 1 or turn > rounds or open_.isEmpty():
            return done.unionByName(open_)
        left = open_.select("doc_id", "piece", "start", "length", "ids_crc32")
