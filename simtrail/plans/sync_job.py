"""K8 wired end to end: read the current table and the changes, compute the new state,
write it as a new table version.

Fault tolerance: the encoded new rows (the expensive step) are written once to a
staging folder under the shared ``spark.checkpoint.dir`` and read back, which cuts
the lineage; a lost executor later re-reads them instead of re-encoding. The new
table is written to a fresh path (never over the input that is being read).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from simtrail.operators import sync as sy
from simtrail.operators.embed import Encoder
from simtrail.session import ensure_checkpoint_dir


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/simtrail-staging/{name}-{uuid.uuid4().hex}"


def run_article_sync(
    spark: SparkSession,
    table: DataFrame,
    incoming: DataFrame,
    existing: DataFrame,
    deleted_ids: DataFrame,
    out_path: str,
    catalogue: DataFrame | None = None,
    encoder: Encoder | None = None,
    flag_mode: str = "as_written",
    shrink: int | None = None,
):
    """Returns (new table DataFrame read back from ``out_path``, watermark value)."""
    plan = sy.prepare_sync(incoming, existing, deleted_ids, encoder=encoder, shrink=shrink)
    stage = staging_path(spark, "new_rows")
    plan.new_rows.write.mode("errorifexists").parquet(stage)
    new_rows = spark.read.parquet(stage)
    gone = staging_path(spark, "removed")
    plan.removed.write.mode("errorifexists").parquet(gone)
    staged = sy.SyncPlan(new_rows, spark.read.schema(plan.removed.schema).parquet(gone), sy.watermark(new_rows))
    out = sy.apply_sync(table, staged, deleted_ids, catalogue, flag_mode)
    sy.write_per_product(out, out_path, mode="errorifexists")
    mark = staged.watermark.first()[0]
    return spark.read.parquet(out_path), mark
