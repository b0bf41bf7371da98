"""K8 on a stored table: a sync rewrites the buckets it changes and no others.

Layout under one path: ``rows`` (Parquet, a folder per product and id bucket) and ``epochs`` (one row per applied
sync). A sync diffs once, encodes the new texts once (both staged in the shared folder), finds the buckets that hold a
deleted, removed, new or re-flagged row, computes the new state of those alone and overwrites their folders
dynamically. The epoch is noted last: a sync that stopped before that is simply run again, and one that was noted is
skipped, so a replayed batch changes nothing.

No folder is larger than a product's share of one id bucket, so a product with a third of all rows is written by as many
tasks as there are buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simtrail.functions.text import ensure_tags
from simtrail.operators import sync as sy
from simtrail.operators.embed import Encoder, embed_unique, hashed_encoder
from simtrail.session import drop_staged, stage

# Folder columns: the product as a name that any file system takes, and the id's bucket.
PARTS = ["product_key", "bucket"]
EPOCHS = "epoch long, buckets int, touched long, watermark string"


@dataclass(frozen=True)
class SyncReport:
    """What a sync did: whether it was applied (not a replay), how many buckets it rewrote, its high-water mark as text."""

    applied: bool
    touched: int
    watermark: str | None


def _with_parts(df: DataFrame, buckets: int) -> DataFrame:
    key = F.concat(F.lit("p-"), F.coalesce(F.url_encode(F.col("product")), F.lit("")))
    return df.withColumn("product_key", key).withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))


def _write(df: DataFrame, path: str, mode: str) -> None:
    dealt = df.repartition(*PARTS)  # a folder is one file
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(f"{path}/rows")


def create_stored_table(df: DataFrame, path: str, buckets: int = 16) -> None:
    """Write ``df`` (id, sentence, product, ...) as a stored table; columns for tags and vectors are added where missing."""
    spark = df.sparkSession
    for name, kind in (("tags", "array<string>"), ("sentence_embedding", "array<double>")):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    _write(_with_parts(df, buckets), path, "errorifexists")
    spark.createDataFrame([(-1, buckets, 0, None)], EPOCHS).write.parquet(f"{path}/epochs")


def read_stored_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").drop(*PARTS)


def _touched(rows: DataFrame, plan: sy.SyncPlan, deleted_ids: DataFrame, catalogue: DataFrame | None, flag_mode: str,
             buckets: int) -> DataFrame:
    """(product_key, bucket) of every bucket that changes; ids alone decide what is removed, which may name a bucket too many."""
    gone = deleted_ids.select(F.col(deleted_ids.columns[0]).alias("id")).union(plan.removed.select("id"))
    found = rows.select("id", *PARTS).join(gone, "id", "left_semi").select(*PARTS)
    found = found.union(_with_parts(plan.new_rows, buckets).select(*PARTS))
    if catalogue is not None:
        flags = rows.select("product", "module", "homolog", F.col("homolog").alias("_old"), *PARTS)
        changed = sy.flag_sync(flags, catalogue, flag_mode).where(~F.col("homolog").eqNullSafe(F.col("_old")))
        found = found.union(changed.select(*PARTS))
    return found.distinct()


def _drop_folders(spark: SparkSession, path: str, folders: list) -> None:
    """Remove the folders of buckets that hold no row any more (a dynamic overwrite leaves them)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for key, bucket in folders:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/rows/product_key={escape(key)}/bucket={bucket}")
        folder.getFileSystem(conf).delete(folder, True)


def sync_stored_table(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    deleted_ids: DataFrame,
    catalogue: DataFrame | None = None,
    epoch: int | None = None,
    encoder: Encoder | None = None,
    flag_mode: str = "as_written",
    remove_missing: bool = True,
) -> SyncReport:
    """Bring the stored table up to date with ``incoming`` (all current articles; with ``remove_missing=False`` a batch of
    changes, which removes nothing by its absence), as ``prepare_sync`` and ``apply_sync`` define it.

    ``epoch`` numbers the syncs: one not above the last applied epoch is a replay and does nothing. Without it each call
    is the next epoch."""
    state = spark.read.schema(EPOCHS).parquet(f"{path}/epochs").agg(F.max("epoch"), F.max("buckets")).first()
    last, buckets = state[0], state[1]
    epoch = last + 1 if epoch is None else epoch
    if epoch <= last:
        return SyncReport(False, 0, None)
    rows = spark.read.parquet(f"{path}/rows")
    current = rows.drop(*PARTS)
    arrived = ensure_tags(sy.fill_missing(sy.filter_deleted(incoming, deleted_ids)))
    diff = stage(sy.sync_diff(arrived, current.select(*sy.KEYS)), "sync-diff")
    removed = diff.where("_merge = 'right_only'" if remove_missing else "false").select(*sy.KEYS)
    new = embed_unique(diff.where("_merge = 'left_only'").drop("_merge"), "sentence", encoder or hashed_encoder())
    plan = sy.SyncPlan(stage(new, "sync-new"), removed, diff.where("_merge = 'left_only'").select("updated_at"))
    mark = sy.watermark(plan.watermark).first()[0]
    touched = stage(_touched(rows, plan, deleted_ids, catalogue, flag_mode, buckets), "sync-touched")
    n_touched = touched.count()
    if n_touched:
        part = rows.join(touched, PARTS, "left_semi").drop(*PARTS)
        after = sy.apply_sync(part, plan, deleted_ids, catalogue, flag_mode).select(*current.columns)
        after = stage(_with_parts(after, buckets), "sync-after")  # complete before the first folder is replaced
        _write(after, path, "overwrite")
        empty = touched.join(after.select(*PARTS).distinct(), PARTS, "left_anti")
        _drop_folders(spark, path, [(r[0], r[1]) for r in empty.collect()])  # at most one row a bucket
        drop_staged(after)
    mark = None if mark is None else str(mark)
    spark.createDataFrame([(epoch, buckets, n_touched, mark)], EPOCHS).write.mode("append").parquet(f"{path}/epochs")
    for staged in (diff, plan.new_rows, touched):
        drop_staged(staged)
    return SyncReport(True, n_touched, mark)
