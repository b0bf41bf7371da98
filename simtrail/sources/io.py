"""Sources and sinks (A1–A11): thin, typed wrappers over Spark readers and writers.

Warehouse and vector-database tables read through client cursors become Spark
sources here (parquet path, catalog table, or any ``spark.read.format``) and every
write is a partitioned Spark writer.
Errors propagate instead of being turned into empty results.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    name: str,
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """A1/A2: read a table by path (parquet by default), catalog name, or any format.

    ``name`` containing a ``/`` or ending in a file suffix is treated as a path. With ``fmt="jdbc"`` it is the database's
    table (``dbtable``), or a statement when it holds a blank (``query``); url, driver and partitioning go in ``options``.
    """
    options = dict(options or {})
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**jdbc_options(name, options)).load()
    is_path = "/" in name or name.endswith((".parquet", ".csv", ".json", ".orc"))
    if not is_path and fmt is None:
        return spark.read.table(name)
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt or "parquet").load(name)


def jdbc_options(name: str, options: Mapping[str, str]) -> dict[str, str]:
    """The options with what is to be read: a statement (a name with a blank) or a table."""
    if "dbtable" in options or "query" in options:
        return dict(options)
    return {**options, "query" if " " in name.strip() else "dbtable": name.strip()}


def select(spark: SparkSession, statement: str, params: Mapping[str, object] | None = None, **tables: DataFrame) -> DataFrame:
    """A2: a SELECT with bound parameters: ``:name`` in the statement takes ``params["name"]`` as a value, never as SQL text;
    ``{name}`` stands for a table given as a DataFrame. An unbound or unknown name raises."""
    return spark.sql(statement, args=dict(params or {}), **tables)


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """A3: append every column of ``df`` to a table (by name)."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def save(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
         partition_by: list[str] | None = None) -> None:
    """Save with an ``if_exists`` style mode: overwrite (replace), append, errorifexists, ignore."""
    mode = {"replace": "overwrite", "fail": "errorifexists"}.get(mode, mode)
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def save_table(df: DataFrame, name: str, mode: str = "fail", fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """A6/A10 on a catalog table: "fail" creates it (and raises if it is there), "append" adds the rows by column name and
    creates it if need be, "replace" gives it the rows and columns of ``df``, "ignore" leaves an existing one alone."""
    if mode not in ("fail", "append", "replace", "ignore"):
        raise ValueError(f"unknown mode {mode!r}")
    # saveAsTable writes session-catalog (v1) and v2 tables alike; it appends by name, other columns raise
    spark_mode = {"fail": "errorifexists", "replace": "overwrite"}.get(mode, mode)
    w = df.write.mode(spark_mode).format(fmt)
    (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)


def clear_table(spark: SparkSession, name: str) -> None:
    """A5 on a catalog table: all rows go, the table stays."""
    spark.sql(f"TRUNCATE TABLE {name}")


def truncate(spark: SparkSession, path: str, fmt: str = "parquet") -> None:
    """A5: delete all rows of a table, keeping its schema (overwrite with an empty frame)."""
    current = spark.read.format(fmt).load(path)
    spark.createDataFrame([], current.schema).write.mode("overwrite").format(fmt).save(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row. Array and map columns are joined to text first
    (CSV has no nested types); vectors are written as ``[a,b,…]``."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    df.select(*cols).write.mode(mode).option("header", True).csv(path)


def read_lines(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """A text file as one row per line (column ``value``), or one row per file."""
    return spark.read.text(path, wholetext=whole)


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan over at least ``min_partitions`` tasks (default: the cluster's cores).

    A file written as one row group is read by one task whatever its size; per-row
    CPU work on it (text normalisation, encoders) would then run on one core. When the
    scan already has enough partitions (the normal case on large tables) this is a no-op;
    otherwise rows are dealt round-robin to ``min_partitions`` partitions.
    """
    spark = df.sparkSession
    try:
        target = min_partitions or spark.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # Spark Connect: no RDD view; leave the plan as it is
        return df
    if current >= target:
        return df
    return df.repartition(target)
