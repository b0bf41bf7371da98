"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simtrail.operators.skew import lookup_join
from simtrail.session import drop_staged, stage

LINK = "node long, parent long"
# Links of a node that one task takes without more ado.
LEAST_LINKS = 1000


def _top(up: dict[int, int], x: int) -> int:
    while up.setdefault(x, x) != x:
        up[x] = up[up[x]]
        x = up[x]
    return x


def union(up: dict[int, int], a: int, b: int) -> bool:
    """Join the sets of ``a`` and ``b`` (the smaller root stays); whether they were two."""
    ra, rb = _top(up, a), _top(up, b)
    if ra != rb:
        up[max(ra, rb)] = min(ra, rb)
    return ra != rb


def forest(pairs: Iterator[tuple[int, int]]) -> dict[int, int]:
    """Smallest node of the component of every node named in ``pairs``."""
    up: dict[int, int] = {}
    for a, b in pairs:
        union(up, a, b)
    return {x: _top(up, x) for x in up}


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one batch as a star forest (at most one link a node), so a dense group shrinks before any shuffle."""
    for batch in batches:
        found = forest(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        rows = [(x, r) for x, r in found.items() if x != r]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in rows], pa.int64()), pa.array([r for _, r in rows], pa.int64())], names=["node", "parent"]
        )


def _minima(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("node").agg(F.min("parent").alias("least"))


def _large_star(links: DataFrame, hot: int) -> DataFrame:
    """Every larger neighbour of a node is hung below the least of the node's neighbourhood."""
    both = links.union(links.select(F.col("parent").alias("node"), F.col("node").alias("parent")))
    least = _minima(both).select("node", F.least("node", "least").alias("least"))
    return (
        lookup_join(both, least, "node", ["parent"], "inner", hot)
        .where("parent > node")
        .select(F.col("parent").alias("node"), F.col("least").alias("parent"))
        .distinct()
    )


def _small_star(links: DataFrame, hot: int) -> DataFrame:
    """A node and its smaller neighbours are hung below the least of them."""
    down = links.select(F.greatest("node", "parent").alias("node"), F.least("node", "parent").alias("parent"))
    hung = lookup_join(down, _minima(down), "node", ["parent"], "inner", hot)
    return (
        hung.select(F.explode(F.array("node", "parent")).alias("node"), F.col("least").alias("parent"))
        .where("node > parent")
        .distinct()
    )


def _mark(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "parent"))).first()
    return tuple(r)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (two long columns); the component is its smallest node.

    Rounds of two joins on the node each; a node with more links than a task's share is found by a sketch and its
    links are dealt over several tasks, minima are pre-aggregated. Links with a null end and loops are ignored; repeated links count once; an empty table
    gives an empty one. The rounds are written to the shared folder, so a lost executor costs one round.
    """
    a, b = links.columns
    clean = links.select(F.col(a).alias("node"), F.col(b).alias("parent")).where("node <> parent")
    now = stage(clean.mapInArrow(_contract, LINK), "links")
    mark = _mark(now)
    tasks = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while mark[0]:
        hot = max(LEAST_LINKS, mark[0] // tasks)
        # between the halves of a round, so that the sketch of the second does not repeat the first
        hung = stage(_large_star(now, hot), "links")
        after = stage(_small_star(hung, hot), "links")
        drop_staged(hung)
        drop_staged(now)
        now, last, mark = after, mark, _mark(after)
        if mark == last:
            break
    roots = now.select(F.col("parent").alias("node"), F.col("parent").alias("component")).distinct()
    return now.select("node", F.col("parent").alias("component")).union(roots)
