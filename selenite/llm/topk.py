"""Exact top-k search by columnar branch and bound.

Candidates lie dimension by dimension. Inner products grow block of dimensions by block of dimensions; after each block a
candidate's score is bounded by what it has plus the product of the remaining lengths (Cauchy-Schwarz), and only candidates
whose bound reaches the k-th best exact score so far are kept, moved together, for the next block.

Queries and candidates are dealt into blocks of bounded size; each pair of blocks is one group, which returns k rows a query. The
first block of candidates is searched first: a query's k-th best there is the floor that it starts from in all others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_for, cut

DIMS, CANDIDATES, QUERIES, SPREAD = 16, 8192, 16384, 32
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_FOUND = "query_id long, vec_id long, score long, place binary"


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x), x as double, as doubles, which hold these whole numbers exactly; null where the vector or a component is
    null, or a component isn't finite, before or after scaling."""
    whole = F.transform(vector, lambda x: x.cast("double") * scale)
    sound = F.coalesce(F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    # a floor to long would not hold large ones; from 2**52 on doubles are whole
    return F.when(sound, F.transform(whole, lambda x: F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)))


def place_of(n: int) -> bytes:
    """Bytes that sort as whole numbers of any size do."""
    m = abs(n)
    size = (m.bit_length() + 7) // 8
    out = size.to_bytes(4, "big") + m.to_bytes(size, "big")
    return b"\x01" + out if n >= 0 else b"\x00" + bytes(255 - x for x in out)


def _matrix(vectors: pa.ChunkedArray, dims: int) -> np.ndarray:
    """[dimension, vector], short vectors padded with 0."""
    out = np.zeros((dims, len(vectors)))
    at = 0
    for chunk in vectors.chunks:
        lens = np.diff(chunk.offsets.to_numpy(zero_copy_only=False)).astype(np.int64)
        flat = chunk.flatten().to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(lens)), lens)
        out[np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens), rows + at] = flat
        at += len(lens)
    return out


def _rest(m: np.ndarray, ends: list[int]) -> list[np.ndarray]:
    """For each end of a block of dimensions, the length of what remains of each vector."""
    squares = np.concatenate([np.cumsum((m.astype(np.float64) ** 2)[::-1], axis=0)[::-1], np.zeros((1, m.shape[1]))])
    return [np.sqrt(squares[e]) for e in ends]


def best(ids: np.ndarray, c: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int, floors: list[int | None] | None = None, dims: int = DIMS) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of each query's k best candidates, ties to the smaller id; a query's own id is left out.

    c, q: [dimension, vector] of whole numbers. floors: scores below which a candidate can't count for the query.
    """
    most = max(float(np.abs(c).max(initial=0)), float(np.abs(q).max(initial=0)))
    square = len(c) * (most * most)  # infinite rather than an error
    if square >= float(1 << 62):
        return _best_wide(ids, c, query_ids, q, k)
    kind = np.float32 if square < 1 << 24 else np.float64 if square < 1 << 53 else np.int64  # exact in each
    ends = [*range(dims, len(c), dims), len(c)]
    c_rest, q_rest = _rest(c, ends), _rest(q, ends)
    c, q = np.ascontiguousarray(c.astype(kind)), np.ascontiguousarray(q.astype(kind).T)
    out = []
    for first in range(0, len(q), 64):
        part = q[first : first + 64, : ends[0]] @ c[: ends[0]]
        for row, n in enumerate(range(first, min(first + 64, len(q)))):
            score = part[row]
            live = np.flatnonzero(ids != query_ids[n]) if (ids == query_ids[n]).any() else None
            score = score if live is None else score[live]
            floor = floors[n] if floors is not None else None
            bound = lambda s, b, at: s + (c_rest[b] if at is None else c_rest[b][at]) * q_rest[b][n] * (1 + 1e-9) + (1e-3 + np.abs(s) * 1e-15)  # noqa: E731, B023
            top = bound(score, 0, live)
            if len(ends) > 1 and (floor is not None or len(score) > 4 * k):
                if len(score) > 4 * k:  # the most promising ones raise the floor
                    tried = np.argpartition(-top, 4 * k)[: 4 * k]
                    whole = q[n] @ c[:, tried if live is None else live[tried]]
                    own = np.partition(whole, len(whole) - k)[len(whole) - k]
                    floor = own if floor is None else max(floor, own)
                kept = np.flatnonzero(top >= floor)
                live, score = (kept if live is None else live[kept]), score[kept]
                for b in range(1, len(ends)):
                    score = score + q[n, ends[b - 1] : ends[b]] @ c[ends[b - 1] : ends[b], live]
                    kept = np.flatnonzero(bound(score, b, live) >= floor)
                    live, score = live[kept], score[kept]
            else:
                live = np.arange(len(ids)) if live is None else live
                score = q[n] @ c[:, live]
            if len(score) > k:
                cutoff = np.partition(score, len(score) - k)[len(score) - k]
                kept = score >= cutoff
                live, score = live[kept], score[kept]
            for i in np.lexsort((ids[live], -score))[:k]:
                out.append((int(query_ids[n]), int(ids[live[i]]), int(score[i])))
    return out


def _best_wide(ids: np.ndarray, c: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """best() for numbers whose inner products 64 bits may not hold: doubles, with their error bounded, name the candidates that can be
    among the k best, and whole numbers of any size decide."""
    scaled = [m / max(np.ldexp(1.0, int(np.frexp(np.abs(m).max(initial=1.0))[1]) - 1), 1.0) for m in (c, q)]  # components under 2
    lengths = [np.sqrt((m**2).sum(axis=0)) for m in scaled]
    out = []
    for n, query in enumerate(query_ids):
        live = np.flatnonzero(ids != query)
        about = scaled[1][:, n] @ scaled[0][:, live]
        off = (len(c) + 2) * 2.0**-50 * (lengths[0][live] * lengths[1][n] + 2.0**-400)
        if len(live) > k:
            floor = np.partition(about - off, len(live) - k)[len(live) - k]
            live = live[about + off >= floor]
        own = [int(x) for x in q[:, n]]
        exact = sorted((-sum(a * int(b) for a, b in zip(own, c[:, i], strict=True)), int(ids[i])) for i in live)
        out += [(int(query), i, -s) for s, i in exact[:k]]
    return out


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, query_id: str = "vec_id", vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k highest inner products of quantised() vectors.

    Ties go to the smaller vec_id; all candidates if fewer than k. A candidate with the query's own id takes no part for it.
    Scores are exact and rank as such; one that a long can't hold is shown as the nearest long. Vectors null or with null or
    non-finite components and rows without an id take no part. A vector shorter than another counts as padded with zeros; an
    empty one scores 0. Repeated candidates each take a place; a repeated query id is asked once, with its smallest vector.
    Empty tables give no rows; further columns are left out.
    """
    sizes = {r["kind"]: r["n"] for r in candidates.select(F.lit("c").alias("kind")).unionAll(queries.select(F.lit("q").alias("kind"))).groupBy("kind").agg(F.count("*").alias("n")).collect()}
    n_c, n_q = blocks_for(sizes.get("c", 0), CANDIDATES, SPREAD), blocks_for(sizes.get("q", 0), QUERIES, 1)
    q = queries.select(F.col(query_id).cast("long").alias("id"), quantised(F.col(vector)).alias("v")).filter("id IS NOT NULL AND v IS NOT NULL").groupBy("id").agg(F.min("v").alias("v"))
    q = q.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(n_q)))
    c = candidates.select(F.col(vec_id).cast("long").alias("id"), quantised(F.col(vector)).alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    # the order of the hash deals rows that share an id to many blocks too
    c = c.withColumn("cb", F.pmod(F.xxhash64("id", "v"), F.lit(n_c)))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            dims = max(1, *(int(np.diff(ch.offsets.to_numpy(zero_copy_only=False)).max(initial=0)) for t in (left, right) for ch in t["v"].chunks))
            floors = right["floor"].to_pylist()
            rows = best(left["id"].to_numpy(), _matrix(left["v"], dims), right["id"].to_numpy(), _matrix(right["v"], dims), k, floors)
        scores = [min(_MOST, max(_LEAST, r[2])) for r in rows]
        return pa.table({"query_id": pa.array([r[0] for r in rows], pa.int64()), "vec_id": pa.array([r[1] for r in rows], pa.int64()), "score": pa.array(scores, pa.int64()), "place": pa.array([place_of(r[2]) for r in rows], pa.binary())})

    def over(blocks: Column, cs: DataFrame, qs: DataFrame) -> DataFrame:
        left = cs.select("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_q - 1).cast("long"))).alias("qb"), "id", "v")
        right = qs.select(F.explode(blocks).alias("cb"), "qb", "id", "v", "floor")
        return left.groupBy("cb", "qb").cogroup(right.groupBy("cb", "qb")).applyInArrow(search, _FOUND)

    one = F.array(F.lit(0).cast("long"))
    start = cut(over(one, c.filter("cb = 0"), q.withColumn("floor", F.lit(None).cast("long"))))
    # a score at the end of what a long holds may stand for another
    floors = start.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor")).filter((F.col("n") >= k) & (F.col("floor") > _LEAST) & (F.col("floor") < _MOST))
    q = q.join(floors.select(F.col("query_id").alias("id"), "floor"), "id", "left")
    rest = over(F.sequence(F.lit(1).cast("long"), F.lit(n_c - 1).cast("long")), c.filter("cb > 0"), q)
    ranked = start.unionByName(rest).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("place"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
