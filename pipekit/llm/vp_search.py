"""Largest inner products by vantage-point trees, one for each shard of the vectors.

With one more component, sqrt(M^2 - |x|^2) for a row x (M: the largest norm) and 0 for a query, the Euclidean distance
falls as the inner product grows, so a metric tree finds largest inner products. A node keeps a vantage point and
splits its rows at the median distance to it. By the triangle inequality a query can skip a child whose rows all lie
farther than its current k-th best; ``factor`` scales that bound: above 1 more is skipped and something may be missed,
at 1 the search is exact, ties included. Scores are inner products of the original vectors in double precision.

Queries are met with all shards in blocks: a task holds one shard and one block. A shard's k best for a query go on,
never more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pipekit.session import durable

SHARD_ROWS = 8192
QUERY_ROWS = 1024
BLOCK_ROWS = 8 * QUERY_ROWS
LEAF = 192
FACTOR = 1.15


class Tree:
    """A vantage-point tree over rows of one shard, as nested tuples: leaf rows, or (vantage, radius, inner, outer)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, most: float):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        lift = np.sqrt(np.maximum(most * most - (self.x * self.x).sum(axis=1), 0))
        self.p = np.hstack([self.x, lift[:, None]])
        self.root = self._split(np.arange(len(self.ids)))

    def _split(self, rows: np.ndarray):
        # Iterative halving: a level halves the rows, so nesting stays logarithmic even where all distances tie.
        if len(rows) <= LEAF:
            return rows
        vantage = rows[0]
        d = np.sqrt(((self.p[rows] - self.p[vantage]) ** 2).sum(axis=1))
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        inner, outer = rows[order[:half]], rows[order[half:]]
        return vantage, float(d[order[half - 1]]), float(d[order[half]]), self._split(inner), self._split(outer)

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores), k columns for each query, best first; -1 where there are fewer rows."""
        best = np.full((len(q), k), -np.inf)
        at = np.full((len(q), k), -1, dtype=np.int64)
        base = np.zeros((len(q), 1))
        lifted = np.hstack([q, base])
        norm = (q * q).sum(axis=1)
        most = float((self.p[0] * self.p[0]).sum()) if len(self.p) else 0.0

        def reach(some: np.ndarray) -> np.ndarray:
            """Distance of the k-th best so far; rounding is allowed for, so that ties are never skipped."""
            gap = norm[some] + most - 2 * best[some, -1]
            return np.sqrt(np.maximum(gap, 0)) * (1 + 1e-9) + 1e-7

        def visit(node, some: np.ndarray) -> None:
            if not len(some):
                return
            if isinstance(node, np.ndarray):
                s = q[some] @ self.x[node].T
                s[self.ids[node][None, :] == query_ids[some][:, None]] = -np.inf
                both = np.hstack([best[some], s])
                where = np.hstack([at[some], np.broadcast_to(node, s.shape)])
                where[both == -np.inf] = -1
                tie = np.where(where < 0, np.iinfo(np.int64).max, where)  # rows stand in id order
                order = np.lexsort((tie, -both), axis=1)[:, :k]
                best[some] = np.take_along_axis(both, order, axis=1)
                at[some] = np.take_along_axis(where, order, axis=1)
                return
            vantage, inner_most, outer_least, inner, outer = node
            d = np.sqrt(((lifted[some] - self.p[vantage]) ** 2).sum(axis=1))
            near = d <= (inner_most + outer_least) / 2
            for first, second, low in ((inner, outer, outer_least - d), (outer, inner, d - inner_most)):
                go = near if first is inner else ~near
                mine, bound = some[go], low[go]
                visit(first, mine)
                visit(second, mine[bound * factor <= reach(mine)])

        visit(self.root, np.arange(len(q)))
        return at, best


def is_valid(x: F.Column) -> F.Column:
    """Not null, every component finite, not all zero; never null itself."""
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    return F.coalesce(x.isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` kept, with a number of its own for each."""
    return durable(rows.withColumn("row", F.monotonically_increasing_id()), name)


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and x (array<double>) of the rows with a valid embedding and an id."""
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    return rows.where(F.col("vec_id").isNotNull() & is_valid(F.col("x")))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as rows."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = FACTOR) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` its k largest inner products among ``vectors``
    (both vec_id, embedding), its own vec_id left out; ties go to the smaller vec_id.

    Invalid rows (see :func:`valid_vectors`) take no part, nor do rows with a null vec_id. Vectors only meet vectors
    of the same length. A repeated vec_id counts each time as a row of its own, on both sides: a query row has its k
    hits whatever its id, and a repeated row among ``vectors`` is a hit each time.
    """
    points, asked = numbered(valid_vectors(vectors), "vp-points"), numbered(valid_vectors(queries), "vp-queries")
    n, most = points.agg(F.count("*"), F.max(F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)))).first()
    if not n:
        return asked.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id",
                            F.lit(0.0).alias("score")).where("false")
    shards, blocks = -(-n // SHARD_ROWS), max(1, -(-asked.count() // BLOCK_ROWS))

    def dealt(rows: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        """Rows in ``parts`` by their number, not their id, which may repeat; each once for each part of the other side."""
        every = F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))
        return rows.select(F.size("x").alias("dim"), F.pmod(F.xxhash64("row"), F.lit(parts)).alias(own), "row", "vec_id", "x",
                           F.explode(every).alias(other)).groupBy("dim", "shard", "block")

    side, spread = dealt(points, "shard", shards, "block", blocks), dealt(asked, "block", blocks, "shard", shards)

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            x, q = (matrix(t.column("x").combine_chunks()) for t in (left, right))
            ids, query_ids = (t.column("vec_id").to_numpy() for t in (left, right))
            query_rows = right.column("row").to_numpy()
            tree = Tree(ids, x, most)
            of, at, score = [], [], []
            for first in range(0, len(q), QUERY_ROWS):
                places, scores = tree.search(query_ids[first:first + QUERY_ROWS], q[first:first + QUERY_ROWS], k, factor)
                rows, columns = np.nonzero(places >= 0)
                of.append(first + rows)
                at.append(places[rows, columns])
                # Each score anew, pair by pair: a matrix product may round equal vectors differently.
                score.append((q[of[-1]] * tree.x[at[-1]]).sum(axis=1))
            of, at, score = np.concatenate(of), np.concatenate(at), np.concatenate(score)
            return pa.table({"row": query_rows[of], "query_id": query_ids[of], "vec_id": tree.ids[at], "score": score})
        return pa.table({"row": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()),
                         "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})

    found = side.cogroup(spread).applyInArrow(search, "row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
