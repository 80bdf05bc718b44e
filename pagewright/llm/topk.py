"""Exact top-k inner-product search by a three-phase uniform threshold.

The dimensions are dealt to LISTS lists; a candidate's score is the sum of its partial scores in all lists.

1. Every task gathers, for each query and list, its candidates with the highest partial scores and resolves those few.
   The k-th highest score found anywhere is a lower bound of the true k-th highest one: a safe cutoff.
2. The cutoffs (a number per query of the block) are broadcast. Who scores at least the cutoff must have at least
   cutoff / LISTS in one list, so each task collects the entries at or above that uniform threshold; all others are out.
3. For the entries left, the entries of the other lists are added, and of those at or above the cutoff each task sends
   its k best for a query (of equal scores the smaller ids), however many tie, to be ranked.

Queries are taken in blocks of at most about QUERY_BLOCK rows (one broadcast of bounded size at a time); candidates
stream by and are never gathered. Vectors that are null, or hold null or non-finite components, take no part, nor do
rows without an id. Components missing from a shorter vector count as 0; an empty vector scores 0. Repeated rows
compete each on its own; a repeated query row is answered once. An empty table gives no rows. Components so large that
an inner product may not fit a long are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LISTS = 2
QUERY_BLOCK = 16384
#: Scores held at once are QUERY_TILE x ROW_TILE.
QUERY_TILE, ROW_TILE = 1024, 2048
LOWEST = -(1 << 62)


def quantised(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component as a double; null where the vector takes no part."""
    xs = embedding.cast("array<double>")
    good = F.forall(xs, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(xs.isNotNull() & good, F.transform(xs, lambda x: F.floor(x * scale).cast("long")))


def _matrix(col: pa.Array, width: int = 0) -> np.ndarray:
    lengths = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    d = max(int(lengths.max(initial=0)), width)
    out = np.zeros((len(col), d), np.int64)
    out[np.arange(d)[None, :] < lengths[:, None]] = flat
    return out


def _exact(q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the narrowest type whose sums of products are exact."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(q.shape[1], 1)
    if top >= 2**62:
        raise OverflowError("inner products may not fit a long")
    kind = np.float32 if top < 2**24 else np.float64 if top < 2**53 else np.int64
    return q.astype(kind), v.astype(kind)


def _tiles(batches: Iterator[pa.RecordBatch], ids: np.ndarray, q: np.ndarray):
    """For each tile: the first query's number, the queries' and candidates' ids and vectors, LISTS column ranges."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROW_TILE):
            part = batch.slice(at, ROW_TILE)
            v = _matrix(part.column(1), q.shape[1])
            wide = np.pad(q, ((0, 0), (0, v.shape[1] - q.shape[1])))
            a, b = _exact(wide, v)
            cuts = [round(i * v.shape[1] / LISTS) for i in range(LISTS + 1)]
            v_ids = part.column(0).to_numpy()
            for first in range(0, len(ids), QUERY_TILE):
                own = ids[first : first + QUERY_TILE, None] == v_ids[None, :]
                tile = a[first : first + QUERY_TILE]
                yield first, v_ids, tile, b, own, [(tile[:, x:y] @ b[:, x:y].T).astype(np.int64) for x, y in zip(cuts, cuts[1:])]


def _local_lists(queries, k: int):
    """Phase 1: (query number, score) of each query's k best candidates among the heads of this task's lists."""

    def run(batches):
        ids, q = queries.value
        best = np.full((len(ids), k), LOWEST, np.int64)
        for first, _, tile, b, own, partial in _tiles(batches, ids, q):
            heads = []
            for s in partial:
                s[own] = LOWEST
                n = min(k, s.shape[1])
                heads.append(np.argpartition(s, s.shape[1] - n, axis=1)[:, -n:])
            heads = np.sort(np.concatenate(heads, axis=1), axis=1)
            score = np.einsum("qhd,qd->qh", b[heads], tile).astype(np.int64)
            again = np.zeros(heads.shape, bool)
            again[:, 1:] = heads[:, 1:] == heads[:, :-1]
            score[again | np.take_along_axis(own, heads, axis=1)] = LOWEST
            rows = slice(first, first + len(tile))
            both = np.concatenate((best[rows], score), axis=1)
            best[rows] = -np.sort(-both, axis=1)[:, :k]
        n, at = np.nonzero(best > LOWEST)
        yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(best[n, at])], ["n", "score"])

    return run


def _kept(best: list[np.ndarray], rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> None:
    """Puts entries (of query number rows) into best, the k best ids and scores of each query; of equal scores the smaller ids."""
    own = np.unique(rows)
    held = np.repeat(own, k)
    all_rows = np.concatenate((held, rows))
    all_ids, all_scores = np.concatenate((best[0][own].ravel(), ids)), np.concatenate((best[1][own].ravel(), scores))
    order = np.lexsort((all_ids, -all_scores, all_rows))
    sorted_rows = all_rows[order]
    at = np.arange(len(order)) - np.searchsorted(sorted_rows, sorted_rows)
    order, at = order[at < k], at[at < k]
    best[0][all_rows[order], at], best[1][all_rows[order], at] = all_ids[order], all_scores[order]


def _sufficient(queries, cutoffs, k: int):
    """Phases 2 and 3: (query number, candidate, score) of each query's k best in this task at or above its cutoff."""

    def run(batches):
        ids, q = queries.value
        cut_of = cutoffs.value
        best = [np.zeros((len(ids), k), np.int64), np.full((len(ids), k), LOWEST, np.int64)]
        for first, v_ids, tile, _, own, partial in _tiles(batches, ids, q):
            cut = cut_of[first : first + len(tile), None]
            threshold = -(-cut // LISTS)
            seen = [s >= threshold for s in partial]
            at_q, at_v = np.nonzero(np.logical_or.reduce(seen) & ~own)
            # What a list didn't send is below its threshold: an upper bound for the sum.
            high = sum(np.where(x[at_q, at_v], s[at_q, at_v], threshold[at_q, 0]) for s, x in zip(partial, seen, strict=True))
            left = high >= cut[at_q, 0]
            at_q, at_v = at_q[left], at_v[left]
            # The remaining entries of those that are left make their scores exact.
            score = sum(s[at_q, at_v] for s in partial)
            good = score >= cut[at_q, 0]
            if good.any():
                _kept(best, first + at_q[good], v_ids[at_v[good]], score[good], k)
        n, at = np.nonzero(best[1] > LOWEST)
        yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(best[0][n, at]), pa.array(best[1][n, at])], ["n", "vec_id", "score"])

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer inner products over all other ids.

    vectors has vec_id long and v array<bigint> (null: takes no part).
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).select("vec_id", "v")
    wanted = rows.where(is_query).distinct()
    blocks = max(1, -(-wanted.count() // QUERY_BLOCK))
    parts = []
    for block in range(blocks):
        taken = wanted.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow().combine_chunks()
        if not taken.num_rows:
            continue
        batch = taken.to_batches()[0]
        ids = batch.column(0).to_numpy()
        queries = spark.sparkContext.broadcast((ids, _matrix(batch.column(1))))
        lists = rows.mapInArrow(_local_lists(queries, k), "n long, score long")
        best = Window.partitionBy("n").orderBy(F.desc("score"))
        kth = lists.withColumn("r", F.row_number().over(best)).where(F.col("r") == k).select("n", "score")
        cut = np.full(len(ids), LOWEST, np.int64)
        found = kth.toArrow()
        cut[found["n"].to_numpy()] = found["score"].to_numpy()
        cutoffs = spark.sparkContext.broadcast(cut)
        hits = rows.mapInArrow(_sufficient(queries, cutoffs, k), "n long, vec_id long, score long")
        order = Window.partitionBy("n").orderBy(F.desc("score"), F.asc("vec_id"))
        top = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame(pa.table({"n": np.arange(len(ids)), "query_id": ids}))
        parts.append(top.join(F.broadcast(names), "n").select("query_id", "rank", "vec_id", "score"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
