"""Near-duplicate vectors by an inverted multi-index (Babenko and Lempitsky, 2012).

Each half of the unit vectors has a codebook of its own; the product of both is a grid of cells. Rows are listed under
their label and nearest cell. A row looks for partners in its ``probes`` nearest cells, in the order of multi-sequence
traversal: cells by rising sum of both half distances. The number of probes is set by trial: vectors of the fitting
sample are turned by exactly the link angle into random directions, and cells are added until the target share of
these hardest partners is found. Candidates are verified by cosine in double precision on the original vectors.

Equal vectors under one label are one class with a multiplicity, so copies are never paired. Cells are cut into blocks
of bounded size, and a task sees one block of rows against one block of visitors. Links counted in a task are summed;
of the links themselves only a spanning forest leaves it, which has the same components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipekit.llm.common import components
from pipekit.llm.vp_search import is_valid, matrix
from pipekit.session import durable

WORDS = 16
SAMPLE = 4096
TARGET = 0.99
BLOCK_ROWS = 2048


def fit_codebook(x: np.ndarray, words: int, rounds: int = 15) -> np.ndarray:
    """Lloyd's k-means from spread-out starts."""
    rng = np.random.default_rng(5)
    centres = x[rng.choice(len(x), size=min(words, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        for k in range(len(centres)):
            if (near == k).any():
                centres[k] = x[near == k].mean(axis=0)
    return centres


def cell_order(x: np.ndarray, first: np.ndarray, second: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` nearest cells of each row, in the order of multi-sequence traversal.

    A cell at places (a, b) of the two sorted lists comes after the (a + 1) * (b + 1) - 1 cells before it in both, so
    only places with (a + 1) * (b + 1) <= count can be among the first ``count``."""
    half = x.shape[1] // 2
    d1 = ((x[:, None, :half] - first[None]) ** 2).sum(axis=2)
    d2 = ((x[:, None, half:] - second[None]) ** 2).sum(axis=2)
    o1, o2 = np.argsort(d1, axis=1, kind="stable"), np.argsort(d2, axis=1, kind="stable")
    a, b = np.divmod(np.arange(len(first) * len(second)), len(second))
    front = (a + 1) * (b + 1) <= count
    a, b = a[front], b[front]
    sums = np.take_along_axis(d1, o1, axis=1)[:, a] + np.take_along_axis(d2, o2, axis=1)[:, b]
    pick = np.argsort(sums, axis=1, kind="stable")[:, :count]
    rows = np.arange(len(x))[:, None]
    return o1[rows, a[pick]] * len(second) + o2[rows, b[pick]]


class MultiIndex:
    """Two codebooks and the number of cells to visit; of fixed size whatever the table."""

    def __init__(self, sample: np.ndarray, least: float, words: int = WORDS, target: float = TARGET):
        x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        half = x.shape[1] // 2
        self.first, self.second = fit_codebook(x[:, :half], words), fit_codebook(x[:, half:], words)
        rng = np.random.default_rng(6)
        side = rng.standard_normal(x.shape)
        side -= (side * x).sum(axis=1, keepdims=True) * x
        length = np.linalg.norm(side, axis=1, keepdims=True)
        turned = least * x + np.sqrt(max(0.0, 1 - least * least)) * side / np.where(length > 0, length, 1)
        cells = len(self.first) * len(self.second)
        # A pair is found from either side; both must miss it for a loss.
        rank = np.minimum(self._rank(x, turned, cells), self._rank(turned, x, cells))
        self.probes = min(cells, int(np.quantile(rank, target, method="higher")) + 1)

    def _rank(self, x: np.ndarray, y: np.ndarray, cells: int) -> np.ndarray:
        return (cell_order(x, self.first, self.second, cells) == self.cells(y, 1)).argmax(axis=1)

    def cells(self, x: np.ndarray, count: int | None = None) -> np.ndarray:
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        return cell_order(x, self.first, self.second, count or self.probes)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Positions of links that join two trees each, over nodes 0 to n - 1."""
    parent, keep = list(range(n)), []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x != y:
            parent[x] = y
            keep.append(k)
    return np.array(keep, dtype=np.int64)


def near_vectors(vectors: DataFrame, least: float = 0.93, words: int = WORDS, sample: int = SAMPLE,
                 target: float = TARGET) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label).

    Rows link when their labels are equal and not null and their cosine is at least ``least``. Rows with a null vec_id,
    label or embedding, a zero vector, or a null or non-finite component link with nothing; so do vectors of other
    lengths. Repeated vec_ids are rows of their own. An empty table gives an empty result.
    """
    # -0.0 and 0.0 are one value.
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                           F.transform(F.col("embedding").cast("array<double>"), lambda v: v + F.lit(0.0)).alias("x"))
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & is_valid(F.col("x"))
    rows = given.where(fit)
    classes = durable(rows.groupBy("label", "x").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")),
                      "vec-classes")
    picked = classes.select("x", F.size("x").alias("dim")).orderBy(F.xxhash64("x")).limit(sample).toArrow()
    if not picked.num_rows:
        return given.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                            F.lit(True).alias("kept"))
    by_dim = {}
    for dim in sorted({d for d in picked.column("dim").to_pylist() if d > 1}):
        of = picked.filter(pc.equal(picked.column("dim"), dim))
        by_dim[dim] = MultiIndex(matrix(of.column("x").combine_chunks()), least, words, target)
    index = vectors.sparkSession.sparkContext.broadcast(by_dim)  # some hundred centres for each vector length

    def listed(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                dims = pc.list_value_length(part.column("x")).to_numpy()
                cells = [[0]] * part.num_rows  # a length outside the sample: one cell for all
                for dim in np.unique(dims):
                    of = np.flatnonzero(dims == dim)
                    if int(dim) in index.value:
                        got = index.value[int(dim)].cells(matrix(part.column("x").take(pa.array(of))))
                        for k, c in zip(of, got, strict=True):
                            cells[k] = c.tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(dims.astype(np.int32)), pa.array(cells, pa.list_(pa.int32()))],
                    names=["node", "dim", "cells"])

    noded = durable(classes.withColumn("node", F.xxhash64("label", "rep", "x")), "vec-nodes")
    cells = durable(noded.select("node", "x").mapInArrow(listed, "node long, dim int, cells array<int>"), "vec-cells")
    whole = noded.select("node", "label", "copies", "x").join(cells, "node")
    home = whole.select("label", "dim", F.col("cells")[0].alias("cell"), "node", "copies", "x")
    visits = whole.select("label", "dim", F.posexplode("cells").alias("turn", "cell"), "node", "copies", "x", "cells")
    key = ["label", "dim", "cell"]
    counts = durable(home.groupBy(key).agg(F.count("*").alias("rows")).join(
        visits.groupBy(key).agg(F.count("*").alias("calls")), key).select(
        *key, F.ceil(F.col("rows") / BLOCK_ROWS).alias("rb"), F.ceil(F.col("calls") / BLOCK_ROWS).alias("cb")), "vec-blocks")

    def blocked(df: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("node"), F.col(own)).cast("long")
        spread = F.sequence(F.lit(0).cast("long"), F.col(other).cast("long") - 1)
        return df.join(counts, key).withColumn(own, mine).withColumn(other, F.explode(spread))

    def verify(_, left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "links": pa.array([], pa.int64()),
                          "tree": pa.array([], pa.bool_())})
        if not left.num_rows or not right.num_rows:
            return empty
        x, y = (matrix(t.column("x").combine_chunks()) for t in (left, right))
        node_x, node_y = (t.column("node").to_numpy() for t in (left, right))
        nx, ny = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
        found = []
        for first in range(0, len(y), 512):  # a margin for rounding in the matrix product, then each pair by itself
            c = (y[first:first + 512] @ x.T) / (ny[first:first + 512, None] * nx[None])
            j, i = np.nonzero(c >= least - 1e-6)
            j = j + first
            if not len(i):
                continue
            exact = (x[i] * y[j]).sum(axis=1) / (nx[i] * ny[j])
            found.append(np.stack([i, j])[:, (exact >= least) & (node_x[i] != node_y[j])])
        if not found:
            return empty
        i, j = np.concatenate(found, axis=1)
        # The row's own cells tell whether it also finds the visitor; of two finds the smaller visitor's counts.
        homes = np.array([c[0] for c in right.column("cells").to_pylist()])
        mutual = np.array([homes[b] in own for own, b in zip(left.column("cells").take(pa.array(i)).to_pylist(), j, strict=True)],
                          dtype=bool) if len(i) else np.zeros(0, dtype=bool)
        once = ~mutual | (node_y[j] < node_x[i])
        i, j = i[once], j[once]
        cx, cy = left.column("copies").to_numpy(), right.column("copies").to_numpy()
        la = np.bincount(i, weights=cy[j], minlength=len(x)).astype(np.int64)
        lb = np.bincount(j, weights=cx[i], minlength=len(y)).astype(np.int64)
        tree = _forest(i, j + len(x), len(x) + len(y))
        some_a, some_b, none = np.flatnonzero(la), np.flatnonzero(lb), np.zeros(0, dtype=np.int64)
        a = np.concatenate([node_x[some_a], node_y[some_b], node_x[i[tree]] if len(tree) else none])
        b = np.concatenate([node_x[some_a], node_y[some_b], node_y[j[tree]] if len(tree) else none])
        links = np.concatenate([la[some_a], lb[some_b], np.zeros(len(tree), dtype=np.int64)])
        return pa.table({"a": a, "b": b, "links": links,
                         "tree": np.arange(len(links)) >= len(some_a) + len(some_b)})

    rows_side = blocked(whole.withColumn("cell", F.col("cells")[0]), "rb", "cb")
    call_side = blocked(visits, "cb", "rb")
    block = [*key, "rb", "cb"]
    found = durable(rows_side.select(*block, "node", "copies", "x", "cells").groupBy(block).cogroup(
        call_side.select(*block, "node", "copies", "x", "cells").toDF(*[f"c_{c}" for c in block], "node", "copies", "x",
                         "cells").groupBy([f"c_{c}" for c in block])).applyInArrow(
        verify, "a long, b long, links long, tree boolean"), "vec-found")
    sums = found.where("not tree").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("others"))
    comps = components(found.where("tree").select("a", "b"), "vec-comps")
    named = noded.select("node", "label", "x", "rep", "copies").join(sums, "node", "left").join(comps, "node", "left")
    named = durable(named.withColumn("comp", F.coalesce("comp", "node")), "vec-named")
    least_id = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    marks = named.join(least_id, "comp").select(
        "label", "x", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = rows.join(marks, ["label", "x"]).select("vec_id", "n_links", "component_id")
    out = linked.union(given.where(~fit).select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
