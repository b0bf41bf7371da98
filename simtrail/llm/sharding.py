"""Sharding by extendible hashing.

The directory is indexed by leading bits of a hash of the row's key. A bucket that is over
the byte limit is split on one more bit, others stay as they are, until every bucket fits
or holds one hash value only; such a bucket (repeated or over-long rows) is cut exactly,
row after row, by running sums of its parts.

The directory is found without moving rows: bytes are summed per hash cell, and a cell
belongs to the shortest of its prefixes whose bytes fit. Only cells that are too large
are counted again by finer ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simtrail.session import stage

# Bits of the hash, and by how many bits a cell is finer than a bucket of average size.
BITS, FINER = 60, 6


def key_hash(column: str) -> Column:
    """The leading 60 bits of the md5 of the key as text (null: of the empty text), as a number."""
    digest = F.md5(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def prefix(column: str, bits: str) -> Column:
    """The first ``bits`` bits of a hash."""
    return F.expr(f"shiftright({column}, {BITS} - {bits})")


def directory(cells: DataFrame, limit: int, deepest: int) -> DataFrame:
    """(depth, bucket, bytes, cells) of the buckets of cells (h, bytes), a cell being a hash with all but its first
    ``deepest`` bits cleared: for each cell the shortest prefix whose bytes are within the limit, else all bits."""
    levels = cells.select("h", "bytes", F.explode(F.sequence(F.lit(0), F.lit(deepest))).alias("depth"))
    sums = levels.groupBy("depth", prefix("h", "depth").alias("bucket")).agg(F.sum("bytes").alias("bytes"))
    # a bucket is in the directory if it fits (or can't be split) and the bucket one bit shorter doesn't fit
    over = sums.where(F.col("bytes") > limit)
    fits = sums.where((F.col("bytes") <= limit) | (F.col("depth") == deepest))
    parents = over.select((F.col("depth") + 1).alias("depth"), F.col("bucket").alias("parent"))
    split = fits.withColumn("parent", F.expr("shiftright(bucket, 1)")).join(parents, ["depth", "parent"], "left_semi")
    root = fits.where("depth = 0")
    return split.select("depth", "bucket", "bytes").unionByName(root.select("depth", "bucket", "bytes"))


def shard(df: DataFrame, limit: int, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add ``shard_id`` ('depth-bucket', with '-part' where a bucket was cut), ``depth`` and ``n_bytes`` to every row.

    ``n_bytes`` is the text's length in UTF-8 (null: 0). No shard is over ``limit`` bytes unless one row alone is.
    Rows with a null key hash like an empty one. Repeated rows share a hash: their bucket is dealt
    to groups of about the limit and cut by running sums there, so that it never comes together whole. Columns of
    ``df`` with the new names are replaced; an empty table gives an empty one.
    """
    new = {"shard_id", "depth", "n_bytes"}
    base = df.select(*[c for c in df.columns if c.lower() not in new])
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long")
    slim = base.withColumn("n_bytes", size).withColumn("_h", key_hash(key_col))
    total, top = slim.agg(F.sum("n_bytes"), F.max("n_bytes")).first()
    shards = max(1, -(-(total or 0) // limit))
    coarse = min(BITS, (shards - 1).bit_length() + FINER)
    cell = lambda bits: F.expr(f"shiftleft(shiftright(_h, {BITS} - {bits}), {BITS} - {bits})")

    # coarse cells first; the rows of a cell that is over the limit are counted by their full hash
    counted = slim.groupBy(cell(coarse).alias("h")).agg(F.sum("n_bytes").alias("bytes"))
    counted = stage(counted, "cells")
    found = directory(counted, limit, coarse)
    found = stage(found, "directory")
    fine = found.where((F.col("depth") == coarse) & (F.col("bytes") > limit))
    if fine.limit(1).count():
        large = fine.select(F.expr(f"shiftleft(bucket, {BITS} - {coarse})").alias("c"))
        exact = slim.withColumn("c", cell(coarse)).join(large, "c", "left_semi").groupBy(F.col("_h").alias("h"))
        deeper = directory(exact.agg(F.sum("n_bytes").alias("bytes")), limit, BITS).where(F.col("depth") > coarse)
        found = stage(found.where((F.col("depth") < coarse) | (F.col("bytes") <= limit)).unionByName(deeper), "directory")

    placed = _placed(slim, found)
    return _cut(placed, key_col, limit).select(*base.columns, "shard_id", "depth", "n_bytes")


def _placed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with their bucket: by one join for every depth that the directory has (few: most buckets lie within a
    bit or two of the average)."""
    depths = [r[0] for r in found.select("depth").distinct().orderBy("depth").collect()]  # at most 61
    if not depths:
        return rows.withColumns({"depth": F.lit(0), "bucket": F.lit(0).cast("long"), "bytes": F.lit(0).cast("long")})
    keys = F.array(*[F.struct(F.lit(d).alias("depth"), prefix("_h", str(d)).alias("bucket")) for d in depths])
    if len(depths) == 1:
        return rows.withColumn("depth", F.lit(depths[0])).withColumn("bucket", prefix("_h", str(depths[0]))).join(
            found.select("depth", "bucket", "bytes"), ["depth", "bucket"]
        )
    slim = rows.select("_h").distinct().withColumn("_k", F.explode(keys)).select("_h", "_k.depth", "_k.bucket")
    where = slim.join(found.select("depth", "bucket", "bytes"), ["depth", "bucket"])
    return rows.join(where, "_h")


def _cut(placed: DataFrame, key_col: str, limit: int) -> DataFrame:
    """Buckets within the limit as they are; others in runs of at most ``limit`` bytes."""
    name = F.concat_ws("-", F.col("depth").cast("string"), F.col("bucket").cast("string"))
    whole = placed.where(F.col("bytes") <= limit).withColumn("shard_id", name)
    over = placed.where(F.col("bytes") > limit)
    if not over.limit(1).count():
        return whole
    groups = F.ceil(F.col("bytes") / limit)
    # written once, so that a repeated task deals its rows alike
    dealt = stage(over.withColumn("_part", F.pmod(F.monotonically_increasing_id(), groups)), "oversized")
    order = Window.partitionBy("depth", "bucket", "_part").orderBy(key_col, "n_bytes")
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # runs that start within the same half of the limit, of rows of at most half, are within it; larger rows stand alone
    half = max(1, limit // 2)
    small = F.when(F.col("n_bytes") <= half, F.col("n_bytes")).otherwise(0)
    run = F.when(F.col("n_bytes") > half, F.concat(F.lit("x"), F.row_number().over(order).cast("string"))).otherwise(
        F.floor((F.sum(small).over(until) - F.col("n_bytes")) / half).cast("string")
    )
    cut = dealt.withColumn("shard_id", F.concat_ws("-", name, F.col("_part").cast("string"), run)).drop("_part")
    return whole.unionByName(cut)
