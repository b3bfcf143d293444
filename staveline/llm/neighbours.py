"""Nearest neighbours by a block matrix join with int8 tiles and error bounds."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staveline.session import settled

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096
TILE = 256
# Columns whose int8 products add up to less than 2^24.
SLICE = 1000

FOUND = "query_id long, vec_id long, score double"


def _quantised(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the norms of the rows as quantised and of what they miss."""
    scale = np.abs(rows).max(axis=1) / 127
    small = np.rint(rows / scale[:, None]).astype(np.int8)
    restored = small * scale[:, None]
    missed = np.linalg.norm(rows - restored, axis=1)
    return small, scale, np.linalg.norm(restored, axis=1), missed


def _vectors(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _tile(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of this block for each query of this block, exactly.

    <x, y> differs from the product of the quantised rows by no more than
    |x'||ey| + |ex||y'| + |ex||ey|; integer products are exact in float32, as
    those of a slice of the columns are below 2^24, and slices are added in double
    precision. A pair whose upper bound is below the k-th best lower
    bound of its query cannot be among the k best; all others are recomputed.
    """
    if not queries.num_rows or not candidates.num_rows:
        return _pairs([])
    q, c = _vectors(queries, "vector"), _vectors(candidates, "c_vector")
    q_ids = queries.column("vec_id").to_numpy()
    c_ids = candidates.column("c_id").to_numpy()
    order = np.argsort(c_ids, kind="stable")
    c, c_ids = c[order], c_ids[order]
    q8, q_scale, q_norm, q_miss = _quantised(q)
    c8, c_scale, c_norm, c_miss = _quantised(c)
    right = c8.T.astype(np.float32)
    found: list[tuple[int, int, float]] = []
    for at in range(0, len(q), TILE):
        rows = slice(at, at + TILE)
        near = np.zeros((len(q8[rows]), len(c_ids)))
        for column in range(0, len(right), SLICE):
            part = slice(column, column + SLICE)
            near += q8[rows, part].astype(np.float32) @ right[part]
        near *= q_scale[rows, None] * c_scale[None, :]
        slack = (
            q_norm[rows, None] * c_miss[None, :]
            + q_miss[rows, None] * (c_norm + c_miss)[None, :]
            + 1e-9 * (q_norm + q_miss)[rows, None] * (c_norm + c_miss)[None, :]
        )
        near[q_ids[rows, None] == c_ids[None, :]] = -np.inf
        lower = near - slack
        take = min(k, len(c_ids))
        kth = np.partition(lower, len(c_ids) - take, axis=1)[:, len(c_ids) - take]
        survives = (near + slack >= kth[:, None]) & np.isfinite(near)
        for i in range(survives.shape[0]):
            j = np.flatnonzero(survives[i])
            scores = (c[j] * q[at + i]).sum(axis=1)
            best = np.lexsort((c_ids[j], -scores))[:k]
            found.extend((int(q_ids[at + i]), int(c_ids[j[b]]), float(scores[b])) for b in best)
    return _pairs(found)


def _pairs(found: list[tuple[int, int, float]]) -> pa.Table:
    ids, others, scores = zip(*found) if found else ((), (), ())
    return pa.table({
        "query_id": pa.array(ids, pa.int64()),
        "vec_id": pa.array(others, pa.int64()),
        "score": pa.array(scores, pa.float64()),
    })


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of vectors that are whole, finite and not zero; one per vec_id."""
    items = F.col("vector")
    finite = F.forall(
        items, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return (
        vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
        .filter(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))
        .filter(F.exists(items, lambda x: x != 0))
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
    )


def nearest(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """The ``k`` nearest rows by inner product of each row whose vec_id ``every`` divides.

    Queries and candidates are dealt into blocks of about the given rows; each pair
    of blocks is one tile, which finds the k best of its candidates for each of its
    queries; heaps merge the tiles of a query. So a task holds two blocks, whatever
    the table, and recall is 1: the bounds drop no pair that could be among the best.

    Returns query_id, rank (from 1, ties to the smaller vec_id), vec_id and score.
    Vectors that are null, empty, zero, or hold null or non-finite numbers, and rows
    without a vec_id, take no part. Of rows with the same vec_id the smallest vector
    counts. Vectors may be of any length; those of different lengths are not compared.
    Other columns are not read. An empty table gives an empty table.
    """
    usable = settled(_usable(vectors).withColumn("dim", F.size("vector")), "vectors")
    rows = usable.count()
    n_candidates = max(1, -(-rows // candidate_block))
    n_queries = max(1, -(-rows // (every * query_block)))
    asked = usable.filter(F.col("vec_id") % every == 0)
    q = asked.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(n_queries)).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(n_candidates - 1))).alias("cb"),
        "dim",
        "vec_id",
        "vector",
    )
    c = usable.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("c_qb"),
        F.pmod(F.xxhash64("vec_id"), F.lit(n_candidates)).cast("int").alias("c_cb"),
        # Names of their own: a cogroup mixes up columns that both sides share.
        (F.col("dim") + 0).alias("c_dim"),
        (F.col("vec_id") + 0).alias("c_id"),
        F.slice("vector", 1, F.size("vector")).alias("c_vector"),
    )

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        return _tile(left, right, k)

    tiles = q.groupBy("dim", "qb", "cb").cogroup(c.groupBy("c_dim", "c_qb", "c_cb")).applyInArrow(tile, FOUND)

    def merged(group: pa.Table) -> pa.Table:
        pairs = zip(group.column("score").to_pylist(), group.column("vec_id").to_pylist())
        best = heapq.nsmallest(k, ((-score, vec_id) for score, vec_id in pairs))
        return pa.table({
            "query_id": pa.array([group.column("query_id")[0].as_py()] * len(best), pa.int64()),
            "rank": pa.array(range(1, len(best) + 1), pa.int32()),
            "vec_id": pa.array([v for _, v in best], pa.int64()),
            "score": pa.array([-s for s, _ in best], pa.float64()),
        })

    result = "query_id long, rank int, vec_id long, score double"
    return tiles.groupBy("query_id").applyInArrow(merged, result)
