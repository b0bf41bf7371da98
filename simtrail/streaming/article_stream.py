"""Article sync over a stream of change files (Structured Streaming, ``foreachBatch``).

Each micro-batch of incoming article rows goes through the same batch operators
(:mod:`simtrail.operators.sync`): diff against the current pairs, encode only new
texts, and append the rows that the sink lacks. Nothing is deleted from the sink. The
checkpoint location records which files were processed; a batch that is replayed after
its write adds nothing as long as ``existing`` reads the sink anew each time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from simtrail.operators import sync as sy
from simtrail.operators.embed import Encoder
from simtrail.plans.stored_sync import sync_stored_table


def start_article_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    existing: Callable[[], DataFrame],
    deleted_ids: Callable[[], DataFrame],
    sink_dir: str,
    checkpoint_dir: str,
    encoder: Encoder | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream. ``existing`` / ``deleted_ids`` are re-read for every micro-batch
    (they change as the sink grows)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    changes = reader.parquet(source_dir)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        plan = sy.prepare_sync(batch, existing(), deleted_ids(), encoder=encoder)
        rows = sy.insert_if_absent(existing(), plan.new_rows)
        rows.write.mode("append").parquet(sink_dir)

    w = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_stored_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    table_path: str,
    deleted_ids: Callable[[], DataFrame],
    checkpoint_dir: str,
    catalogue: Callable[[], DataFrame] | None = None,
    encoder: Encoder | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """The same stream into a stored table (:mod:`simtrail.plans.stored_sync`): a batch of changes rewrites the buckets it
    touches, deletes the listed ids and updates the flags, but removes no row for being absent from the batch.

    The batch number is the table's epoch, so a batch that was applied before its checkpoint was written changes nothing when it
    is replayed. A table takes one such stream with one checkpoint: a new checkpoint would count from 0 again, and
    batches below the table's last epoch are taken for replays."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        flags = catalogue() if catalogue is not None else None
        sync_stored_table(spark, table_path, batch, deleted_ids(), flags, epoch_id, encoder, remove_missing=False)

    w = reader.parquet(source_dir).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
