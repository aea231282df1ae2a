"""Nearest neighbours by cosine: a block matrix join over int8 tiles whose error bounds make it exact."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

K = 5
#: Vectors of a tile, on either side, on average: blocks are dealt by a hash of the id. Larger ones copy each vector to fewer tiles.
QUERY_BLOCK, ROW_BLOCK = 8192, 8192
#: Queries of a tile that are multiplied at once, and components of a product that float32 adds up exactly (127 * 127 * PART < 2**24).
STRIP, PART = 1024, 1024


def _quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows of unit vectors, a step for each row, and the length of each row's rounding error."""
    step = np.maximum(np.abs(x).max(axis=1), 1e-30) / 127
    q = np.rint(x / step[:, None]).astype(np.int8)
    return q, step, np.linalg.norm(x - q * step[:, None], axis=1)


def _length(x: np.ndarray) -> np.ndarray:
    """Euclidean length of each row, components added from first to last."""
    return np.sqrt(np.add.accumulate(x * x, axis=1)[:, -1])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows."""
    out = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], PART):
        out += a[:, i : i + PART].astype(np.float32) @ b[:, i : i + PART].astype(np.float32).T
    return out


def tile(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int = K) -> list[tuple[int, int, float]]:
    """The k nearest of the rows (cid, c) for each query: (number of the query's row, id, cosine), ties to the smaller id.

    The products of the int8 rows are exact whole numbers, and |a.b - a'.b'| <= |a - a'| + |b - b'| (1 + |a - a'|) for unit a, b. A pair
    survives if its upper bound reaches the k-th largest lower bound of its query; its cosine is computed from the original vectors.
    Of equal vectors only the k smallest ids other than the query's own can be answers, so a group of copies costs no more than one vector.
    """
    order = np.argsort(cid, kind="stable")
    cid, c = cid[order], c[order]
    _, first, of = np.unique(c.view(np.dtype((np.void, c.dtype.itemsize * c.shape[1]))).ravel(), return_index=True, return_inverse=True)
    members = np.argsort(of, kind="stable")
    begin = np.searchsorted(of[members], np.arange(len(first) + 1))
    sizes = np.diff(begin)
    u = c[first]
    un, qn = _length(u), _length(q)
    a, sa, ea = _quantised(q / qn[:, None])
    b, sb, eb = _quantised(u / un[:, None])
    out = []
    for i in range(len(qid)):
        if i % STRIP == 0:
            strip = slice(i, i + STRIP)
            near_of = _products(a[strip], b) * sa[strip, None] * sb
            slack_of = ea[strip, None] + eb * (1 + ea[strip, None]) + 1e-9
        near, slack = near_of[i % STRIP], slack_of[i % STRIP]
        # rows of the query's own id are no candidates, wherever they are
        own = of[np.searchsorted(cid, qid[i]) : np.searchsorted(cid, qid[i], "right")]
        counts = sizes - np.bincount(own, minlength=len(first))
        low = np.where(counts > 0, near - slack, -np.inf)
        rank = np.argsort(-low, kind="stable")[:k]
        enough = np.searchsorted(np.cumsum(counts[rank]), k)
        least = low[rank[enough]] if enough < len(rank) else -np.inf
        at = np.flatnonzero((near + slack >= least) & (counts > 0))
        score = np.add.accumulate(q[i] * u[at], axis=1)[:, -1] / (qn[i] * un[at])
        found = []
        for s, j in zip(score.tolist(), at.tolist(), strict=True):
            ids = cid[members[begin[j] : begin[j + 1]]]
            lo, hi = np.searchsorted(ids, qid[i]), np.searchsorted(ids, qid[i], "right")
            found += [(-s, int(v)) for v in (*ids[: min(lo, k)], *ids[hi : hi + max(k - lo, 0)])]
        out += [(i, v, -s) for s, v in heapq.nsmallest(k, found)]
    return out


def nearest(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = K, query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """(query_id, rank, id, score): the k nearest rows by cosine of every row that `queries` selects, its own id left out.

    Vectors that are null, zero, of no component, or hold a null or non-finite one take no part, neither as query nor as row; vectors of
    another length than a query are no candidates of it. With fewer candidates than k all are returned. Ties go to the smaller id; rows
    that repeat an id are candidates each on their own, and each of them asks on its own, with its own vector; a null id takes no part.
    Every block of queries meets every block of rows once, in a group of its own; each tile gives its k best for a query, and those are merged.
    """
    kind = "array<float>" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    v = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast(kind).alias("v"), queries.alias("q"))
    v = v.where("size(v) > 0 and not exists(v, x -> x is null or isnan(x) or abs(x) = double('inf')) and exists(v, x -> x <> 0)")
    v = cut(v.withColumns({"dim": F.size("v"), "row": F.monotonically_increasing_id()}))
    n, m = v.agg(F.count(F.lit(1)), F.count_if("q")).first()
    rows, blocks = max(1, -(-n // row_block)), max(1, -(-m // query_block))
    every = lambda x: F.explode(F.sequence(F.lit(0), F.lit(x - 1)))
    place = lambda x: F.pmod(F.xxhash64("row"), F.lit(x)).cast("int")
    right = v.select("id", "v", "dim", place(rows).alias("r"), every(blocks).alias("b"))
    left = v.where("q").select("row", "id", "v", "dim", place(blocks).alias("b"), every(rows).alias("r"))

    def run(key: tuple, x: pa.Table, y: pa.Table) -> pa.Table:
        matrix = lambda t: t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(t.num_rows, -1)
        found = tile(x["id"].to_numpy(), matrix(x), y["id"].to_numpy(), matrix(y), k) if x.num_rows and y.num_rows else []
        at, near, scores = zip(*found, strict=True) if found else ((), (), ())
        own = x.select(["row", "id"]).take(pa.array(at, pa.int64()))
        return pa.table({"row": own["row"], "query_id": own["id"], "id": pa.array(near, pa.int64()), "score": pa.array(scores, pa.float64())})

    key = ["dim", "r", "b"]
    best = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "row long, query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
