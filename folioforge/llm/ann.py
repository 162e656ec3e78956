"""Nearest neighbours by a block matrix join.

Vectors become unit vectors in int8 with a scale and the exact norm of their rounding error. Blocks of
queries meet blocks of vectors in tiles: an int8 product (in runs of 1,024 dimensions, which float32 holds exactly) gives every cosine
within a known bound, and only pairs whose upper bound reaches the k-th lower bound survive. Survivors are
recomputed in double precision from the original vectors; the tiles' best lists are merged by heaps.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do
rows with a null id; vectors meet only vectors of their dimension; ties go to the smaller id; a repeated id is a
candidate as often as it comes, but never for a query of that id, and each query row has its own result; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import narrow, ship, stored

CODED = "vec_id long, dim int, raw binary, code binary, scale double, error double"
FOUND = "query_row long, query_id long, vec_id long, score double"
#: Dimensions whose products of int8 codes sum up exactly in float32: 127 * 127 * 1024 is less than 2**24.
RUN = 1024


def component(vectors: DataFrame, column: str) -> str:
    """float if the vectors hold floats, else double: the type in which original components travel."""
    return "float" if isinstance(getattr(vectors.schema[column].dataType, "elementType", None), T.FloatType) else "double"


def encode(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Original components, int8 codes, scale and the norm of what rounding changed."""
    kind = component(vectors, column)
    dtype = {"float": np.float32, "double": np.float64}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = v.values if v.is_valid else None
                if i is None or values is None or not len(values) or values.null_count:
                    continue
                x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                norm = np.sqrt((x * x).sum()) if np.isfinite(x).all() else 0.0
                if not norm > 0 or not np.isfinite(norm):
                    top = np.abs(x).max() if np.isfinite(x).all() else 0.0
                    if not top > 0:
                        continue
                    unit = x / top
                    unit /= np.sqrt((unit * unit).sum())
                else:
                    unit = x / norm
                scale = np.abs(unit).max() / 127.0
                code = np.rint(unit / scale).astype(np.int8)
                rows.append((i, len(x), x.astype(dtype).tobytes(), code.tobytes(), scale, float(np.linalg.norm(unit - scale * code))))
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.float64(), pa.float64())
                cols = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["vec_id", "dim", "raw", "code", "scale", "error"])

    return ship(narrow(vectors, {"vec_id": "long", column: f"array<{kind}>"})).mapInArrow(run, CODED)


def cosine(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosine of q with each row of v in double precision, summed component by component in order."""
    dot, nv, nq = np.zeros(len(v)), np.zeros(len(v)), 0.0
    with np.errstate(all="ignore"):
        for k in range(len(q)):
            dot += v[:, k] * q[k]
            nv += v[:, k] * v[:, k]
            nq += q[k] * q[k]
        out = dot / np.sqrt(nv * nq)
        bad = ~np.isfinite(out) | (nv * nq < 1e-280)
    if bad.any():  # components whose squares leave the range of doubles
        a, b = q / np.abs(q).max(), v[bad] / np.abs(v[bad]).max(axis=1, keepdims=True)
        out[bad] = (b @ a) / np.sqrt((a @ a) * (b * b).sum(axis=1))
    return np.clip(out, -1.0, 1.0)


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of the rows of two matrices of codes held in float32."""
    out = (a[:, :RUN] @ b[:, :RUN].T).astype(np.float64)
    for lo in range(RUN, a.shape[1], RUN):
        out += a[:, lo:lo + RUN] @ b[:, lo:lo + RUN].T
    return out


def _tile(k: int, kind: str):
    dtype = {"float": np.float32, "double": np.float64}[kind]

    def tile(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(queries) and len(vectors):
            ids = vectors["vec_id"].to_numpy(np.int64)
            codes = np.frombuffer(b"".join(vectors["code"]), np.int8).reshape(len(ids), -1).astype(np.float32)
            raw = np.frombuffer(b"".join(vectors["raw"]), dtype).reshape(len(ids), -1)
            scale, error = vectors["scale"].to_numpy(), vectors["error"].to_numpy()
            for lo in range(0, len(queries), 256):
                part = queries.iloc[lo:lo + 256]
                own = np.frombuffer(b"".join(part["code"]), np.int8).reshape(len(part), -1).astype(np.float32)
                near = code_products(own, codes) * (part["scale"].to_numpy()[:, None] * scale[None, :])
                e = part["error"].to_numpy()[:, None]
                slack = e * (1 + error[None, :]) + error[None, :] + 1e-12
                for i, (row, qid, qraw) in enumerate(zip(part["row"], part["vec_id"], part["raw"], strict=True)):
                    low, high = near[i] - slack[i], near[i] + slack[i]
                    other = ids != qid
                    low = np.where(other, low, -np.inf)
                    n = min(k, int(other.sum()))
                    if not n:
                        continue
                    bar = np.partition(low, len(low) - n)[len(low) - n]
                    live = np.flatnonzero(other & (high >= bar))
                    score = cosine(np.frombuffer(qraw, dtype).astype(np.float64), raw[live].astype(np.float64))
                    best = np.lexsort((ids[live], -score))[:k]
                    out += [(row, qid, ids[live[j]], score[j]) for j in best]
        return pd.DataFrame(out, columns=["query_row", "query_id", "vec_id", "score"])

    return tile


def _merge(k: int):
    def merge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heaps: dict[tuple[int, int], list[tuple[float, int]]] = {}
        for pdf in parts:
            for r, q, v, s in zip(pdf["query_row"], pdf["query_id"], pdf["vec_id"], pdf["score"], strict=True):
                h = heaps.setdefault((q, r), [])
                item = (s, -v)
                heapq.heappush(h, item) if len(h) < k else heapq.heappushpop(h, item)
        rows = [(q, r + 1, -v, s) for (q, _), h in heaps.items() for r, (s, v) in enumerate(sorted(h, reverse=True))]
        yield pd.DataFrame(rows, columns=["query_id", "rank", "vec_id", "score"])

    return merge


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, query_block: int = 4096, vector_block: int = 16384, column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by cosine of each row whose id `every` divides.

    Every tile of at most about query_block x vector_block pairs is one task's work; each side is dealt by hash,
    so equal vectors spread over all blocks.
    """
    coded = stored(encode(vectors, column), "codes")
    total = coded.count()
    asked = stored(coded.filter(F.pmod("vec_id", F.lit(every)) == 0).withColumn("row", F.monotonically_increasing_id()), "asked")
    n_q = max(1, -(-asked.count() // query_block))
    n_v = max(1, -(-total // vector_block), min(12, -(-total // 2048)))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = asked.withColumn("qb", F.pmod(F.xxhash64("row"), F.lit(n_q)).cast("int")).withColumn("vb", spread(n_v))
    others = coded.withColumn("vb", F.pmod(F.xxhash64("vec_id", "code"), F.lit(n_v)).cast("int")).withColumn("qb", spread(n_q))
    keys = ["dim", "qb", "vb"]
    found = queries.groupBy(*keys).cogroup(others.groupBy(*keys)).applyInPandas(_tile(k, component(vectors, column)), FOUND)
    return found.repartition("query_row").mapInPandas(_merge(k), "query_id long, rank int, vec_id long, score double")
