"""Exact nearest neighbours by largest inner product, as a block matrix join with int8 tiles.

Query and candidate blocks meet in tiles. In a tile every vector is brought to a size of about one by a power of two
and rounded to int8 with its own scale; the integer products give each inner product up to a bound that
follows from the rounding residuals. A pair whose
upper bound stays below the k-th largest lower bound of its query in the tile can't be among its k
nearest. Products that may leave the range of normal doubles have no bound and survive. The surviving pairs are computed again in double precision on the original vectors, added up in
the order of the components, and the tiles' lists are merged by heaps.

Of candidates with equal vectors only the ``k + 1`` smallest ids take part: ties go to the smaller id, so
no other can be found, and a vector that is very common costs no more than a rare one. The method compares
every query with every candidate, so rows moved grow with the number of blocks on the other side.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialise, small

QUERY_BLOCK, CANDIDATE_BLOCK, _STEP = 2048, 8192, 256
#: Powers of two of a product up to which sums over any usual number of components stay normal doubles.
_SURE = 900


def _rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scales, norms of the rounded vectors and of the residuals; no vector is zero."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.linalg.norm(back, axis=1), np.linalg.norm(x - back, axis=1)


def _power(x: np.ndarray) -> np.ndarray:
    """The power of two just above each vector's largest component."""
    return np.frexp(np.abs(x).max(axis=1))[1]


def tile(queries: tuple[np.ndarray, np.ndarray], candidates: tuple[np.ndarray, np.ndarray], k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per step of queries: query ids, candidate ids and scores of each query's k best in this tile."""
    (ids, x), (names, y) = queries, candidates
    up_x, up_y = _power(x), _power(y)
    a, scale_a, norm_a, rest_a = _rounded(np.ldexp(x, -up_x[:, None]))
    b, scale_b, norm_b, rest_b = _rounded(np.ldexp(y, -up_y[:, None]))
    kind = np.float32 if x.shape[1] <= 1000 else np.float64  # either holds the integer products exactly
    b = b.astype(kind).T
    for s in range(0, len(ids), _STEP):
        part = slice(s, s + _STEP)
        near = (a[part].astype(kind) @ b).astype(np.float64) * scale_a[part, None] * scale_b
        error = norm_a[part, None] * rest_b + rest_a[part, None] * norm_b + rest_a[part, None] * rest_b
        error += 1e-12 * norm_a[part, None] * norm_b  # rounding here and in the sums of the score
        up = up_x[part, None] + up_y
        sure = np.abs(up) <= _SURE
        up = np.where(sure, up, 0)
        near, error = np.ldexp(near, up), np.ldexp(error, up)
        own = ids[part, None] == names
        low = np.where(own | ~sure, -np.inf, near - error)
        keep = min(k, len(names))
        least = np.partition(low, len(names) - keep, axis=1)[:, len(names) - keep]
        i, j = np.nonzero((~sure | (near + error >= least[:, None])) & ~own)
        score = np.zeros(len(i))
        with np.errstate(over="ignore", invalid="ignore", under="ignore"):
            for d in range(x.shape[1]):  # the sum in the order of the components
                score += x[s + i, d] * y[j, d]
        order = np.lexsort((names[j], -np.nan_to_num(score, nan=0.0, posinf=np.inf, neginf=-np.inf), ~np.isnan(score), i))
        i, j, score = i[order], j[order], score[order]
        starts = np.flatnonzero(np.diff(i, prepend=-1))
        rank = np.arange(len(i)) - np.repeat(starts, np.diff(np.append(starts, len(i))))
        best = rank < k
        yield ids[s + i[best]], names[j[best]], score[best]


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    flat = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return ids, flat.reshape(len(ids), -1)


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest of every query: ``query_id, rank, vec_id, score``.

    ``is_query`` is a condition on ``vec_id``. Candidates are all rows but those of the query's own id. Vectors that are null,
    empty or zero, or hold a null or a value that isn't finite, take no part, nor do rows without an id. Vectors
    of one length are compared with each other. Rows that repeat an id count once, with the smallest
    vector. Ties go to the smaller id; a product that overflows is infinite, or not a number, which Spark and SQL
    order above all numbers. Queries have fewer rows where there are fewer candidates; an empty table
    gives none. Other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))) & F.exists("embedding", lambda x: x != 0.0))
    rows = materialise(rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("n", F.size("embedding")), "vectors")
    blocks = lambda cond, size: F.ceil(F.count(F.when(cond, 1)) / size).cast("int")
    # a row per length of vectors: bounded by the longest vector
    lengths = small(materialise(rows.groupBy("n").agg(blocks(is_query, QUERY_BLOCK).alias("across"), blocks(F.lit(True), CANDIDATE_BLOCK).alias("down")).where("across > 0"), "lengths"))
    same = Window.partitionBy("h", "embedding").orderBy("vec_id")
    candidates = rows.withColumn("h", F.xxhash64("embedding")).withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).select("vec_id", "embedding", "n")
    block = lambda df, own, count, other, others: df.join(lengths, "n").withColumn(own, F.expr(f"int(pmod(xxhash64(vec_id), {count}))")).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(others) - 1))).select(*(F.col(x).alias(x) for x in ("vec_id", "embedding", "n", "i", "j")))
    q, c = block(rows.where(is_query), "i", "across", "j", "down"), block(candidates, "j", "down", "i", "across")

    def tiles(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        found = [np.concatenate(x) for x in zip(*tile(_matrix(left), _matrix(right), k), strict=True)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heap = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            best = sorted(heap, reverse=True)
            if best:
                yield pa.RecordBatch.from_arrays([pa.array([at] * len(best), pa.int64()), pa.array(range(1, len(best) + 1), pa.int32()), pa.array([-x[2] for x in best], pa.int64()), pa.array([float("nan") if x[0] else x[1] for x in best], pa.float64())], names=["query_id", "rank", "vec_id", "score"])

        for batch in batches:
            for query, vec, score in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if query != at:
                    yield from flush()
                    at, heap = query, []
                (heapq.heappush if len(heap) < k else heapq.heappushpop)(heap, (score != score, 0.0 if score != score else score, -vec))
        yield from flush()

    found = q.groupBy("n", "i", "j").cogroup(c.groupBy("n", "i", "j")).applyInArrow(tiles, "query_id long, vec_id long, score double")
    return found.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(merge, "query_id long, rank int, vec_id long, score double")
