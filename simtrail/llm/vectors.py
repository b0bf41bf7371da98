"""Helpers for vector tables: which vectors take part, bounded samples, matrices from Arrow columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id long, vec array<double>) of the vectors that can be compared: not null, not zero, every component finite, with an
    id."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return rows.where(comparable())


def comparable() -> Column:
    """Which rows (id, vec) take part."""
    # null components make the first test null, so the row is left out
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col("id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0)


def by_length(rows: DataFrame) -> list[DataFrame]:
    """The rows of each vector length (only vectors of one length can be compared), shortest first."""
    lengths = [r[0] for r in rows.select(F.size("vec")).distinct().collect()]
    if len(lengths) == 1:
        return [rows]
    return [rows.where(F.size("vec") == d) for d in sorted(lengths)]


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column without nulls, all of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def sample_matrix(rows: DataFrame, n: int, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of at most ``bound`` rows, chosen by a hash of the id."""
    place = F.xxhash64("id").bitwiseAND(2**30 - 1)
    chosen = rows.withColumn("_p", place).where(F.col("_p") / 2**30 < min(1.0, 1.2 * bound / max(n, 1)))
    got = chosen.orderBy("_p", "id").limit(bound).select("id", "vec").toArrow()
    return got["id"].to_numpy(), matrix(got["vec"])
