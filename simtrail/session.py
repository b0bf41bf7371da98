"""Session helpers: a local session for tests/bench and a shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Text stages are CPU-bound per row: keep AQE from merging small post-shuffle
    # partitions of long texts into one task (coalescing keeps parallelism first and
    # only merges below this size).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
}

_SCRATCH: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "simtrail") -> SparkSession:
    """Local session used by tests and the bench (the cluster supplies its own)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("SIMTRAIL_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is. Only
    when it is unset (local tests) one scratch folder per application is made.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        named = _SCRATCH.get(sc.applicationId)
        if named is None:
            named = _SCRATCH[sc.applicationId] = tempfile.mkdtemp(prefix="simtrail-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def new_stage_dir(spark: SparkSession, tag: str) -> str:
    """A fresh path under the shared folder for one staged table."""
    return f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def stage(df: DataFrame, tag: str, **options: object) -> DataFrame:
    """Write ``df`` once to the shared folder (with the writer's ``options``) and read it back (cuts the lineage;
    a lost executor re-reads the files instead of recomputing)."""
    spark = df.sparkSession
    path = new_stage_dir(spark, tag)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 2048) -> None:
    """From now on this session sends tasks' Python code at most ``rows`` rows at a time (fewer, if it is set so already):
    the buffers of whole texts on either side grow with that number. The rows that come out are the same."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def sent_bytes(spark: SparkSession, most: int) -> None:
    """From now on this session sends tasks' Python code about ``most`` bytes at a time (fewer, if it is set so already):
    rows that are whole blocks would otherwise fill its buffers on either side. The rows that come out are the same."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if now is None or spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) > most:
        spark.conf.set(key, f"{most}b")


@contextmanager
def settings(spark: SparkSession, **values: object) -> Iterator[None]:
    """The session's settings (``__`` for a dot) as given, for what is run inside; afterwards as before."""
    keys = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def drop_staged(df: DataFrame) -> None:
    """Delete the files behind a table made by :func:`stage` (only when nothing reads it any more)."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.getParent().toUri().getPath().rstrip("/") == jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/"):
            path.getFileSystem(conf).delete(path, True)
