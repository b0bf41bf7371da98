"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of at most ``rows`` rows (bounds the Python objects alive at once)."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def utf8_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def fresh_name(taken: list[str], name: str) -> str:
    """``name``, with underscores put in front until no column is called that (case-insensitive)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def extended_schema(df: DataFrame, extra: list[tuple[str, T.DataType]]) -> tuple[T.StructType, pa.Schema]:
    """Schema of ``df`` without the columns named in ``extra``, followed by ``extra``."""
    names = {n.lower() for n, _ in extra}
    fields = [f for f in df.schema.fields if f.name.lower() not in names]
    schema = T.StructType(fields + [T.StructField(n, t, True) for n, t in extra])
    return schema, to_arrow_schema(schema)


def crc_mod(value: object, mod: int) -> int:
    """crc32 of the value written as text, modulo ``mod``."""
    return zlib.crc32(str(value).encode()) % mod
