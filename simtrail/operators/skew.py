"""Look-up joins whose keys may be hot: the frequent keys are found by a bounded sketch and dealt over salts.

A join on a key that a third of the rows share would end in one task. :func:`lookup_join` gives the rows of such a
key a salt by their own content and copies the key's one row of the look-up table to each salt, so the rest of the rows
pay nothing and no row is read twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys named by the sketch, and values it tracks (both bound its size, whatever the table's).
HEAVY_KEYS, TRACKED = 64, 4096
# Rows of a frequent key that one task should see, and tasks a key is dealt over at most.
ROWS_A_TASK, MOST_SALTS = 200_000, 1024


def heavy_keys(rows: DataFrame, key: Column, least: int = ROWS_A_TASK, heavy: int = HEAVY_KEYS) -> list[tuple[int, int]]:
    """(64-bit hash, approximate count) of the most frequent values of ``key``, at most ``heavy``, each in more than
    ``least`` rows. One pass; tasks send a sketch of bounded size."""
    hashed = rows.select(F.xxhash64(key).alias("h"), key.isNotNull().alias("_there")).where("_there")
    got = hashed.agg(F.expr(f"approx_top_k(h, {heavy}, {TRACKED})").alias("top")).first()["top"]
    return [(r["item"], r["count"]) for r in got or [] if r["count"] > least]


def salted(key_hash: Column, spread: Column, heavy: Sequence[tuple[int, int]], least: int) -> tuple[Column, Column]:
    """Salt of a row (0 unless its key is heavy, else by ``spread``), and the salts that a key's look-up row is copied to."""
    own, copies = F.lit(0), F.array(F.lit(0))
    for h, n in heavy:  # at most HEAVY_KEYS
        salts = min(MOST_SALTS, -(-n // least))
        is_key = key_hash == F.lit(h)
        own = F.when(is_key, F.pmod(spread, F.lit(salts)).cast("int")).otherwise(own)
        copies = F.when(is_key, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(copies)
    return own, copies


def lookup_join(
    rows: DataFrame, table: DataFrame, key: str, spread: Sequence[str], how: str = "left", least: int = ROWS_A_TASK,
) -> DataFrame:
    """``rows`` with the columns of ``table`` (one row a ``key``), hot keys dealt over several tasks.

    ``spread``: columns of ``rows`` whose values differ between rows of one key; a salt is a hash of them, so a task that
    runs again makes the same one. The key is compared by its hash and as it is. ``how``: left or inner."""
    heavy = heavy_keys(rows, F.col(key), least)
    own, copies = salted(F.xxhash64(key), F.xxhash64(*spread), heavy, least)
    left = rows.withColumn("_lh", F.xxhash64(key)).withColumn("_ls", own)
    right = table.select(F.col(key).alias("_rk"), F.xxhash64(key).alias("_rh"), *[c for c in table.columns if c != key])
    right = right.withColumn("_rs", F.explode(salted(F.col("_rh"), F.lit(0), heavy, least)[1]))
    # compared as >= and <=, so that a long text is no sort key
    same = [F.col("_lh") == F.col("_rh"), F.col("_ls") == F.col("_rs"), F.col(key) >= F.col("_rk"), F.col(key) <= F.col("_rk")]
    return left.join(right, same, how).drop("_lh", "_ls", "_rk", "_rh", "_rs")
