"""Embedding whitening by a bit-sliced scatter matrix.

Entries become integers, y = floor(scale * entry). A task takes rows in slices: each dimension is
shifted by its own least value in the slice, and the bit planes of the shifted numbers are packed
across rows into 64-bit words. The cross-product of two dimensions is then a sum of
popcount(plane & plane) weighted by powers of two, so it is exact; the shifts are undone in integer
arithmetic. Spark adds the products up as decimals. With C the cross-products, S the sums and n the
rows, the covariance (n * C - S S') / n^2 is centred as an integer before its one division, and only
then does eigh see floating-point numbers. A common shift of all entries changes none of this.

Vectors of different lengths are separate fit lists. Driver and tasks hold matrices of the vector
dimension only, never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simtrail.llm.common import fresh_name, slices
from simtrail.llm.vectors import matrix

# Rows of a slice (whole 64-bit words), and words alive at once while planes are combined.
SLICE, ALIVE = 4096, 1 << 19
# An entry times the scale must stay below this, so that sums of squares fit 38 digits.
LIMIT = 2.0**40
OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def as_integers(vectors: np.ndarray, scale: float) -> np.ndarray:
    y = np.floor(vectors * scale)
    if y.size and np.abs(y).max() >= LIMIT:
        raise ValueError(f"an entry times {scale:g} is beyond {LIMIT:g}")
    return y.astype(np.int64)


def cross_products(y: np.ndarray) -> np.ndarray:
    """Exact sums over rows of y_i * y_j, as Python integers (rows x dimensions of int64 in)."""
    rows, d = y.shape
    least = y.min(axis=0)
    u = (y - least).astype(np.uint64)
    planes = int(u.max()).bit_length()
    bits = np.zeros((planes, d, -(-rows // 64) * 64), np.uint8)
    for b in range(planes):
        bits[b, :, :rows] = ((u >> np.uint64(b)) & np.uint64(1)).T
    words = np.packbits(bits, axis=2).view(np.uint64)
    # weights beyond 62 bits would leave int64; few planes is the common case
    total = np.zeros((d, d), np.int64 if 2 * planes + rows.bit_length() < 63 else object)
    step = max(1, ALIVE // (d * words.shape[2]))
    for a in range(planes):
        for b in range(a, planes):
            for at in range(0, d, step):
                pair = words[a, at : at + step, None, :] & words[b, None, :, :]
                found = np.bitwise_count(pair).sum(axis=2, dtype=np.int64).astype(total.dtype)
                found *= 1 << (a + b)
                total[at : at + step] += found
                if a != b:
                    total[:, at : at + step] += found.T
    shift, sums = least.astype(object), u.sum(axis=0, dtype=np.uint64).astype(object)
    turned = np.outer(shift, sums)
    return total.astype(object) + turned + turned.T + rows * np.outer(shift, shift)


class Model:
    """What the tasks need to whiten vectors of one length."""

    def __init__(self, n: int, sums: list[int], cross: np.ndarray, components: int):
        self.n, self.sums, d = n, sums, len(sums)
        s = np.array(sums, object)
        centred = n * cross - np.outer(s, s)
        v = np.array([[c / (n * n) for c in row] for row in centred], np.float64).reshape(d, d)
        value, vector = np.linalg.eigh(v)
        keep = np.argsort(-value, kind="stable")[:components]
        total = float(np.trace(v))
        self.value = np.maximum(value[keep], 0.0)
        # directions without variance (fewer rows than dimensions, constant entries) have no scale
        self.live = self.value > max(total, 0.0) * d * np.finfo(float).eps
        self.turn = vector[:, keep] / np.sqrt(np.where(self.live, self.value, 1.0)) * self.live
        self.explained = self.value / total if total > 0 else np.zeros(len(keep))
        self.error = 0.0

    def centred(self, y: np.ndarray) -> np.ndarray:
        """n * y - S per entry, exact; int64 where that fits, else Python integers."""
        s = max((abs(x) for x in self.sums), default=0)
        if self.n * (int(np.abs(y).max()) if y.size else 0) + s < 2**62:
            return self.n * y - np.array(self.sums, np.int64)
        return self.n * y.astype(object) - np.array(self.sums, object)

    def whitened(self, gap: np.ndarray) -> np.ndarray:
        return (gap / self.n).astype(np.float64) @ self.turn


def deviations(gap: np.ndarray) -> list[int | None]:
    """Sum of squares per row, exact; None where it passes 64 bits."""
    top = int(np.abs(gap).max()) if gap.size else 0
    if gap.dtype != object and top * top * max(gap.shape[1], 1) < 2**63:
        return (gap * gap).sum(axis=1).tolist()
    found = [sum(x * x for x in row) for row in gap.tolist()]
    return [x if x < 2**63 else None for x in found]


def _usable(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(the id, vec): vectors without null or non-finite entries; empty vectors have nothing to whiten."""
    rows = df.select(F.col(id_col).alias(id_col), F.col(vec_col).cast("array<double>").alias(fresh_name([id_col], "vec")))
    vec = rows.columns[1]
    # null components make the test null, so the row is left out
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col(vec).isNotNull() & (F.size(vec) > 0) & finite)


def _by_length(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of rows whose vectors have one length, and their matrix."""
    for batch in slices(batches, SLICE):
        sizes = batch.column(at).value_lengths().to_numpy(zero_copy_only=False)
        for d in np.unique(sizes):
            some = batch if (sizes == d).all() else batch.filter(pa.array(sizes == d))
            yield some, matrix(some.column(at))


def _totals(rows: DataFrame, per_slice: Callable[[np.ndarray], np.ndarray], number: str) -> DataFrame:
    """Sums over all rows, cell by cell, of the symmetric table that ``per_slice`` makes of a matrix of vectors of
    length d: (d, i, j, total) with i <= j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for _, x in _by_length(batches, 1):
            got, d = per_slice(x), x.shape[1]
            held[d] = held[d] + got if d in held else got
        for d, cells in held.items():
            i, j = np.indices(cells.shape).reshape(2, -1)
            upper = i <= j
            numbers = cells.reshape(-1)[upper]
            values = pa.array([Decimal(x) for x in numbers], pa.decimal128(38, 0)) if cells.dtype == object else pa.array(numbers)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(upper.sum(), d, np.int32)), pa.array(i[upper].astype(np.int32)), pa.array(j[upper].astype(np.int32)), values],
                names=["d", "i", "j", "total"],
            )

    cells = rows.mapInArrow(run, f"d int, i int, j int, total {number}")
    return cells.groupBy("d", "i", "j").agg(F.sum("total").alias("total"))


def _squares(cells: DataFrame) -> dict[int, np.ndarray]:
    """The summed tables, one symmetric matrix per vector length (bounded by the dimension, not by the rows)."""
    got: dict[int, dict] = {}
    for d, i, j, total in cells.collect():
        got.setdefault(d, {})[i, j] = total
    out = {}
    for d, known in got.items():
        size = 1 + max(j for _, j in known)
        out[d] = table = np.zeros((size, size), object)
        for (i, j), x in known.items():
            table[i, j] = table[j, i] = x
    return out


def fit(rows: DataFrame, scale: float, components: int) -> dict[int, Model]:
    """A model per vector length; rows: (id, vec)."""

    def scatter(x: np.ndarray) -> np.ndarray:
        # a last dimension of ones makes the sums and the row count part of the one product
        y = as_integers(x, scale)
        return cross_products(np.hstack([y, np.ones((len(y), 1), np.int64)]))

    found = {}
    for d, table in _squares(_totals(rows, scatter, "decimal(38,0)")).items():
        whole = np.array([[int(x) for x in row] for row in table], object)
        found[d] = Model(int(whole[d, d]), whole[d, :d].tolist(), whole[:d, :d], components)
    return found


def measure(rows: DataFrame, models: dict[int, Model], scale: float) -> None:
    """Set each model's error: the largest entry of the covariance of all whitened rows, less the identity."""
    sent = rows.sparkSession.sparkContext.broadcast(models)

    def moments(x: np.ndarray) -> np.ndarray:
        model = sent.value[x.shape[1]]
        w = model.whitened(model.centred(as_integers(x, scale)))
        w = np.hstack([w, np.ones((len(w), 1))])
        return w.T @ w

    for d, table in _squares(_totals(rows, moments, "double")).items():
        model, k = models[d], len(table) - 1
        mean = table[k, :k].astype(float) / model.n
        covariance = table[:k, :k].astype(float) / model.n - np.outer(mean, mean)
        gap = np.abs(covariance - np.eye(k))[np.ix_(model.live, model.live)]
        model.error = float(gap.max()) if gap.size else 0.0


def whiten(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 64.0, components: int = 32
) -> DataFrame:
    """One row per usable vector and component: the id, ``component`` (from 1, by falling eigenvalue), ``n`` rows fitted,
    ``deviation`` (sum over dimensions of (n * x - S)^2, exact, null where it passes 64 bits), ``whitened`` (the centred
    integers, projected and scaled to variance 1), ``explained`` (share of the total variance) and ``identity_error``
    (largest entry of the covariance of ``whitened`` over all rows, less the identity; components with variance).

    Null vectors and those with a null, NaN or infinite entry are left out, as are empty ones; zero vectors, repeated
    rows, and null or repeated ids take part like any row. Vectors of each length are fitted and numbered on their
    own. A component without variance (one row, constant entries, fewer rows than dimensions) has ``whitened`` 0. Other columns are not read, whatever their names; an empty table gives an empty one. An entry
    whose integer does not fit 40 bits raises. Three narrow passes over the vectors; only cells of the
    dimension-by-dimension tables are shuffled.
    """
    rows = _usable(df, id_col, vec_col, scale)
    models = fit(rows, scale, components)
    measure(rows, models, scale)
    sent = df.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, x in _by_length(batches, 1):
            model = sent.value[x.shape[1]]
            gap = model.centred(as_integers(x, scale))
            w = model.whitened(gap)
            k = w.shape[1]
            each = pa.array(np.repeat(np.arange(len(w)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(w))),
                    pa.array(np.full(w.size, model.n, np.int64)),
                    pa.array(deviations(gap), pa.int64()).take(each),
                    pa.array(w.reshape(-1)),
                    pa.array(np.tile(model.explained, len(w))),
                    pa.array(np.full(w.size, model.error)),
                ],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, {OUT}")
