"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are grown on a bounded sample (a node splits its points at the median of their
projections on the line between two of them); every row of the table is put into one leaf
of each tree. A query walks all trees with one shared priority queue: the branch that the
query misses by the least margin, in whatever tree, is opened next, until enough leaves
are reached. How many are enough is measured: for some queries the exact neighbours are
found by brute force, and the number of leaves is the one that holds the asked share of
them. Rows of the reached leaves are ranked by the exact inner product.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simtrail.llm.vectors import by_length, matrix, sample_matrix, usable
from simtrail.session import stage

# Most rows or queries of a leaf that meet in one task; larger leaves are cut.
GROUP = 4096


class Tree:
    """Inner nodes: normal, cut, children (a leaf is ~number)."""

    def __init__(self, points: np.ndarray, leaves: int, rng: np.random.Generator):
        self.normals, self.cuts, self.children, self.leaves = [], [], [], 0
        self.root = self._grow(points, leaves, rng)
        d = points.shape[1]
        self.normals = np.array(self.normals).reshape(-1, d)
        self.cuts = np.array(self.cuts)
        self.children = np.array(self.children, np.int64).reshape(-1, 2)

    def _grow(self, points: np.ndarray, leaves: int, rng: np.random.Generator) -> int:
        if leaves > 1 and len(points) >= 4:
            a, b = points[rng.choice(len(points), 2, replace=False)]
            normal = a - b
            size = float(np.sqrt((normal**2).sum()))
            if size > 0:
                side = points @ (normal / size)
                cut = float(np.median(side))
                low = side < cut
                if 0 < low.sum() < len(points):
                    me = len(self.normals)
                    self.normals.append(normal / size)
                    self.cuts.append(cut)
                    self.children.append([0, 0])
                    self.children[me] = [self._grow(points[low], leaves // 2, rng), self._grow(points[~low], leaves - leaves // 2, rng)]
                    return me
        self.leaves += 1
        return ~(self.leaves - 1)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.full(len(x), self.root, np.int64)
        while (inner := at >= 0).any():
            rows = np.nonzero(inner)[0]
            node = at[rows]
            side = np.einsum("ij,ij->i", x[rows], self.normals[node]) >= self.cuts[node]
            at[rows] = self.children[node, side.astype(np.int64)]
        return ~at


class Forest:
    def __init__(self, points: np.ndarray, trees: int, leaves: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.trees = [Tree(points, leaves, rng) for _ in range(trees)]

    def leaves_by_margin(self, q: np.ndarray, most: int) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of one queue over all trees: least margin missed on the way first."""
        sides = [t.normals @ q - t.cuts for t in self.trees]
        heap = [(0.0, i, t.root) for i, t in enumerate(self.trees)]
        heapq.heapify(heap)
        out: list[tuple[int, int]] = []
        while heap and len(out) < most:
            missed, i, node = heapq.heappop(heap)
            while node >= 0:
                side = float(sides[i][node])
                near, far = (1, 0) if side >= 0 else (0, 1)
                heapq.heappush(heap, (max(missed, abs(side)), i, int(self.trees[i].children[node, far])))
                node = int(self.trees[i].children[node, near])
            out.append((i, ~node))
        return out


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, added up in one fixed order (equal vectors score equal)."""
    return (q * x).sum(1)


def best_of(qid: np.ndarray, q: np.ndarray, rid: np.ndarray, x: np.ndarray, k: int, floor: np.ndarray):
    """(query, row, score) of each query's ``k`` best rows other than itself that reach its floor."""
    rough = q @ x.T
    slack = 1e-9 * (1 + np.abs(rough).max(initial=0))
    rough[qid[:, None] == rid[None, :]] = -np.inf
    bar, best = floor - slack, rough
    order = np.argsort(rid, kind="stable")
    first = np.nonzero(np.diff(rid[order], prepend=rid[order][:1] - 1))[0]
    if len(first) < len(rid):  # rows with the same id are one candidate
        best = np.maximum.reduceat(rough[:, order], first, axis=1)
    if best.shape[1] > k:
        bar = np.maximum(bar, np.partition(best, best.shape[1] - k, axis=1)[:, best.shape[1] - k] - slack)
    at, col = np.nonzero((rough >= bar[:, None]) & np.isfinite(rough))
    score = exact_scores(q[at], x[col])
    order = np.lexsort((rid[col], -score, at))
    at, col, score = at[order], col[order], score[order]
    if len(first) < len(rid):
        once = np.sort(np.unique(np.stack([at, rid[col]], 1), axis=0, return_index=True)[1])
        at, col, score = at[once], col[once], score[once]
    place = np.arange(len(at)) - np.searchsorted(at, at)
    keep = place < k
    return qid[at[keep]], rid[col[keep]], score[keep]


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _batch(found) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, FOUND, strict=True)], schema=FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query; a row found in several trees counts once."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """Exact neighbours of a bounded set of queries (sent to every task): k rows a query and task are shuffled."""
    sent = rows.sparkSession.sparkContext.broadcast((ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qid, q = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                part = batch.slice(at, GROUP)
                none = np.full(len(qid), -np.inf)
                yield _batch(best_of(qid, q, part.column("id").to_numpy(), matrix(part.column("vec")), k, none))

    return _ranked(rows.mapInArrow(run, "query_id long, vec_id long, score double"), k)


def nearest(
    df: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", trees: int = 4,
    leaf_rows: int = 1024, sample: int = 20_000, share: float = 0.97, measured: int = 128,
) -> DataFrame:
    """The ``k`` rows with the largest inner product for every row whose id is divisible by ``every``.

    Returns query_id, rank (from 1), vec_id, score: nearest first, ties to the smaller id, a query's own id left
    out, all candidates if there are fewer than ``k``. Scores are exact; ``share`` is the part of the exact
    neighbours, measured on ``measured`` queries over all rows, that the searched leaves must hold.

    Ids or vectors that are null, zero vectors and vectors with null or non-finite components take no part; vectors of
    different lengths are no candidates of each other (each length is searched on its own). Rows with the same id are one
    candidate per length (its best score counts). Equal vectors fall into the same leaves; large leaves are cut into parts of ``GROUP`` rows. Tables
    without usable vectors give no rows.
    """
    spark = df.sparkSession
    rows = stage(usable(df, id_col, vec_col), "vectors")
    found = [_nearest(some, every, k, trees, leaf_rows, sample, share, measured) for some in by_length(rows)]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if len(found) == 1:
        return found[0]
    # an id with vectors of several lengths is one query
    return _ranked(reduce(DataFrame.union, found).drop("rank"), k)


def _nearest(
    rows: DataFrame, every: int, k: int, trees: int, leaf_rows: int, sample: int, share: float, measured: int
) -> DataFrame:
    """:func:`nearest` on vectors (id, vec) of one length."""
    spark, n = rows.sparkSession, rows.count()
    sample_ids, points = sample_matrix(rows, n, sample)
    sample_ids, once = np.unique(sample_ids, return_index=True)
    points = points[once]
    leaves = max(1, min(n // leaf_rows, len(points) // 8))
    forest = Forest(points, trees, leaves)
    total = sum(t.leaves for t in forest.trees)

    queries = rows.where(F.col("id") % every == 0)
    some_ids, some = sample_matrix(queries, max(1, n // every), measured)
    probes = total
    if total > trees and len(some):
        truth = brute_force(rows, some_ids, some, k).join(rows.withColumnRenamed("id", "vec_id"), "vec_id").toArrow()
        probes = _enough(forest, dict(zip(some_ids.tolist(), some, strict=True)), truth, total, share)
    homes = [t.leaf_of(points) for t in forest.trees]
    sent = spark.sparkContext.broadcast((forest, sample_ids, points, homes))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value[0]
        for batch in batches:
            x = matrix(batch.column("vec"))
            for i, tree in enumerate(known.trees):
                leaf = pa.array(tree.leaf_of(x), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), i), pa.int32()), leaf, *batch.columns], names=["tree", "leaf", "id", "vec"]
                )

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pids, p, leaves_of = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids, q = part.column("id").to_numpy(), matrix(part.column("vec"))
                ways = [known.leaves_by_margin(v, probes) for v in q]
                # the k-th best sample row of the searched leaves: rows below it can't be among the k nearest found
                scores = q @ p.T
                scores[ids[:, None] == pids[None, :]] = -np.inf
                floor = np.full(len(q), -np.inf)
                for r, way in enumerate(ways):
                    open_leaves = [np.zeros(t.leaves, bool) for t in known.trees]
                    for t, leaf in way:
                        open_leaves[t][leaf] = True
                    met = np.zeros(len(pids), bool)
                    for is_open, home in zip(open_leaves, leaves_of, strict=True):
                        met |= is_open[home]
                    seen = scores[r, met]
                    if len(seen) > k:
                        floor[r] = np.partition(seen, len(seen) - k)[len(seen) - k]
                which = np.repeat(np.arange(len(q)), [len(w) for w in ways])
                flat = np.array([x for w in ways for x in w], np.int64).reshape(-1, 2)
                cols = [pa.array(flat[:, 0], pa.int32()), pa.array(flat[:, 1], pa.int32()), pa.array(ids[which])]
                cols += [part.column("vec").take(pa.array(which)), pa.array(floor[which])]
                yield pa.RecordBatch.from_arrays(cols, names=["tree", "leaf", "id", "vec", "floor"])

    shape = "tree int, leaf int, id long, vec array<double>"
    index = stage(rows.mapInArrow(place, shape), "index")
    asked = stage(queries.mapInArrow(route, shape + ", floor double"), "asked")
    cuts = lambda t, name: t.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias(name))
    # at most one row per leaf of the forest (no more than trees * sample / 8)
    parts = F.broadcast(cuts(index, "rows").join(cuts(asked, "queries"), ["tree", "leaf"]))
    dealt = lambda t, own, other: (
        t.join(parts, ["tree", "leaf"])
        .withColumn(own, F.pmod(F.xxhash64("id"), F.col(own)).cast("int"))
        .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
    )
    keys = ["tree", "leaf", "rows", "queries"]
    left, right = dealt(asked, "queries", "rows").groupBy(keys), dealt(index, "rows", "queries").groupBy(keys)

    def search(q: pa.Table, x: pa.Table) -> pa.Table:
        if not q.num_rows or not x.num_rows:
            return FOUND.empty_table()
        found = best_of(q["id"].to_numpy(), matrix(q["vec"]), x["id"].to_numpy(), matrix(x["vec"]), k, q["floor"].to_numpy())
        return pa.Table.from_batches([_batch(found)])

    return _ranked(left.cogroup(right).applyInArrow(search, "query_id long, vec_id long, score double"), k)


def _enough(forest: Forest, queries: dict[int, np.ndarray], truth: pa.Table, total: int, share: float) -> int:
    """The number of leaves at which the asked share of the exact neighbours is reached."""
    where = [t.leaf_of(matrix(truth["vec"])) for t in forest.trees]
    ranks, order = [], {}
    for i, qid in enumerate(truth["query_id"].to_pylist()):
        if qid not in order:
            order[qid] = {way: r for r, way in enumerate(forest.leaves_by_margin(queries[qid], total), 1)}
        ranks.append(min(order[qid][t, int(leaf[i])] for t, leaf in enumerate(where)))
    return int(np.quantile(ranks, share, method="higher")) if ranks else total
