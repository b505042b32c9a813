"""Exact top-k inner products with a vector-approximation file.

Every component is quantised to a cell of its dimension's range; the cells of a
vector bound each of its inner products from both sides. Vectors are spread over
bounded blocks by a hash of their id. For each block of queries against a block
of vectors, the cells are scanned first, then exact vectors are read in the
order of their bounds until the k-th result can no longer be beaten (for inner
products the largest upper bound comes first, as the smallest lower bound does
for distances). The k best of each block are merged by a window with a group
limit, so every result is exact and no task holds more than two blocks.

Defined cases
* null vectors, and vectors with null or non-finite components, take no part;
* rows that share a vec_id count once, with the smallest vector; a null vec_id
  takes no part (it cannot be named in a result);
* vectors of another length than the query's are no candidates;
* equal scores: the smaller vec_id first; fewer than k candidates: all of them;
* scores are 64-bit integers; blocks whose products could leave 64 bits are scored
  with unbounded ones, and a score among a block's k best that does leave them, or
  a component of 2**62 or more, raises an error;
* other columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK = 8192
QUERY_BLOCK = 2048
CELLS = 16
SCALE = 64
LARGEST = 1 << 62


def _usable(vector: Column) -> Column:
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def quantised(embeddings: DataFrame) -> DataFrame:
    """(vec_id, dim, v): integer components floor(64 x), one row per usable vec_id."""
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("x")))
    whole = F.transform("x", lambda x: F.floor(x * SCALE))
    checked = F.when(F.exists("x", lambda x: F.abs(x) * SCALE >= LARGEST), F.raise_error(F.lit("a component is too large for exact 64-bit scores"))).otherwise(whole)
    return rows.groupBy("vec_id").agg(F.min("x").alias("x")).select("vec_id", F.size("x").alias("dim"), checked.cast("array<bigint>").alias("v"))


def _cell_matrix(v: np.ndarray, low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """The approximation file of a block: one byte per component."""
    return np.minimum((v - low) // width, CELLS - 1).astype(np.uint8)


def _best_first(score: np.ndarray, ids: np.ndarray) -> np.ndarray | list[int]:
    if score.dtype == object:
        return sorted(range(len(score)), key=lambda i: (-score[i], ids[i]))
    return np.lexsort((ids, -score))


def nearest(queries: np.ndarray, cells: np.ndarray, vectors: np.ndarray, ids: np.ndarray, own: np.ndarray, low: np.ndarray, width: np.ndarray, k: int, wide: bool = False):
    """The k best (position, score) of each query; ``wide`` scores with unbounded integers."""
    half = (width - 1) / 2.0
    centre = low + cells * width + half
    middle = queries.astype(float) @ centre.T
    radius = np.abs(queries).astype(float) @ half
    # The bounds are rounded: half of one for small components, and what their sums of products can lose for large ones.
    dim = queries.shape[1]
    slack = 0.5 + 2.0**-51 * (dim + 8) * dim * float(np.abs(queries).max(initial=0)) * float((np.abs(centre) + half).max(initial=0))
    read = 0
    for q in range(len(queries)):
        upper = middle[q] + radius[q]
        upper[ids == own[q]] = -math.inf
        count = int((ids != own[q]).sum())
        want = min(k, count)
        if not want:
            yield q, np.empty(0, np.int64), np.empty(0, np.int64)
            continue
        # No vector below the k-th largest lower bound can be a result.
        sure = np.partition(upper, len(upper) - want)[len(upper) - want] - 2 * radius[q]
        order = np.flatnonzero(upper >= sure - 2 * slack)
        order = order[np.argsort(-upper[order], kind="stable")]
        order = order[ids[order] != own[q]]
        best_at, best = np.empty(0, np.int64), np.empty(0, np.int64)
        at, step = 0, max(64, 2 * want)
        while at < len(order):
            if len(best) == want and upper[order[at]] < float(best[-1]) - 2 * slack:
                break
            part = order[at : at + step]
            score = vectors[part].astype(object) @ queries[q].astype(object) if wide else vectors[part] @ queries[q]
            best_at, best = np.concatenate([best_at, part]), np.concatenate([best, score])
            rank = _best_first(best, ids[best_at])[:want]
            best_at, best = best_at[rank], best[rank]
            at += len(part)
        read += at
        yield q, best_at, best


def _block_results(k: int):
    def run(rows: pa.Table) -> pa.Table:
        side, ids = rows.column("side").to_numpy(), rows.column("vec_id").to_numpy()
        v = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in rows.column("v").chunks]).reshape(len(ids), -1)
        vectors, queries = v[side == 0], v[side == 1]
        vids, qids = ids[side == 0], ids[side == 1]
        out = []
        if len(vectors) and len(queries):
            wide = v.shape[1] * int(np.abs(vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) >= 1 << 62
            low = vectors.min(axis=0)
            width = (vectors.max(axis=0) - low) // CELLS + 1
            cells = _cell_matrix(vectors, low, width)
            for s in range(0, len(queries), 256):
                part = slice(s, s + 256)
                for q, at, score in nearest(queries[part], cells, vectors, vids, qids[part], low, width, k, wide):
                    if any(not -(1 << 63) <= x < 1 << 63 for x in (score if wide else ())):
                        raise ValueError("scores leave 64 bits")
                    out.append((np.full(len(at), qids[s + q]), vids[at], score.astype(np.int64)))
        parts = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 3
        return pa.table({n: pa.array(p, pa.int64()) for n, p in zip(("query_id", "vec_id", "score"), parts)})

    return run


def top_k(embeddings: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score of the k largest integer inner products of each query row."""
    rows = quantised(embeddings)
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    blocks, query_blocks = max(1, math.ceil(sizes.n / BLOCK)), max(1, math.ceil(sizes.q / QUERY_BLOCK))
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks))
    query_block = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(query_blocks))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    vectors = rows.select("dim", block.alias("a"), each(query_blocks).alias("b"), F.lit(0).alias("side"), "vec_id", "v")
    queries = rows.where(is_query).select("dim", each(blocks).alias("a"), query_block.alias("b"), F.lit(1).alias("side"), "vec_id", "v")
    found = vectors.union(queries).where("dim > 0").groupBy("dim", "a", "b").applyInArrow(_block_results(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def report(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, F.col("vec_id") % 20 == 0)


ORACLE = """
WITH e AS (SELECT vec_id, min(list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY 1),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
