"""WARC archives: a writer of gzip records and a splittable reader.

Every record is a gzip member of its own. A reading task gets a byte range of an archive,
looks for the gzip magic inside it, takes a place for a record only if the bytes there
decode to a WARC header, and owns the records that start in its range (it reads past the
range's end to finish the last one). So ranges can be cut anywhere.

Archives are opened with ``pyarrow.fs`` (local and network folders, HDFS, S3, GCS by URI).
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simtrail.llm.common import slices, utf8_bytes
from simtrail.session import new_stage_dir, stage

MAGIC = b"\x1f\x8b\x08"
# Bytes read at a time while scanning, and records' date (records carry no clock, so a repeated task writes the same).
CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"
PREFIX = "urn:record:"
SMALLEST_REVISIT = 100

RECORD = (
    "archive string, offset long, record_id string, record_type string, uri string, refers_to string, "
    "payload_digest string, payload_length long, headers map<string,string>, payload binary"
)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and path.startswith("file:"):
        path = path[5:]
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def record_bytes(record_id: str, kind: str, uri: str | None, payload: bytes, length: int, digest: str, refers_to: str | None) -> bytes:
    """One record as a gzip member; a revisit carries no payload but its length and digest."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {length}",
    ]
    if uri is not None:
        head.append("WARC-Target-URI: " + quote(uri, safe="%/:=&?~#+!$,;'@()*[]"))
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    body = b"" if kind == "revisit" else payload
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n") + pack.compress(body) + pack.compress(b"\r\n\r\n") + pack.flush()


def parse_head(raw: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields (names in lower case) and where the block begins; None if it is no WARC header."""
    stop = raw.find(b"\r\n\r\n")
    if stop < 0 or not raw.startswith(b"WARC/"):
        return None
    fields = {}
    for line in raw[:stop].decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    if not fields.get("content-length", "").isdigit():
        return None
    return fields, stop + 4


def mark_revisits(pages: DataFrame, id_col: str, text_col: str, salts: int = 16) -> DataFrame:
    """Add ``_length``, ``_digest`` and ``_refers``: of rows with equal payloads of at least 100 bytes the smallest id is
    kept, the others refer to it. Only repeated payloads join, spread over ``salts`` keys a payload."""
    raw = F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b""))
    rows = pages.withColumn("_length", F.length(raw).cast("long")).withColumn("_digest", F.sha2(raw, 256))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int"))
    repeated = (
        rows.where((F.col("_length") >= SMALLEST_REVISIT) & F.col(id_col).isNotNull())
        .groupBy("_digest")
        .agg(F.min(id_col).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .where("_copies > 1")
        .select("_digest", "_first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    )
    first = F.when(F.col("_first") < F.col(id_col), F.col("_first"))
    return rows.join(repeated, ["_digest", "_salt"], "left").withColumn("_refers", first)


def write_archives(
    pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", text_col: str = "html", folder: str | None = None
) -> DataFrame:
    """Write one WARC record per row; returns the archives written (``archive``, ``bytes``, ``records``).

    The payload is the text in UTF-8 (null: empty). Of rows with equal payloads of at least 100 bytes the one with
    the smallest id is a response and the others are revisits that refer to it; repeated rows of that smallest id
    are responses alike, rows with a null id too. Each task writes an archive under a name of its own attempt in
    the shared folder; only archives of finished tasks are listed. An empty table gives no archive.
    """
    spark = pages.sparkSession
    folder = folder or new_stage_dir(spark, "warc")
    marked = mark_revisits(pages.select(id_col, uri_col, text_col), id_col, text_col)
    marked = marked.select(id_col, uri_col, text_col, "_length", "_digest", "_refers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        name, sink, size, records = "", None, 0, 0
        for batch in slices(batches, 256):
            if sink is None:
                fs.create_dir(root, recursive=True)
                name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                sink = fs.open_output_stream(f"{root}/{name}", compression=None)
            ids, uris, payloads, lengths, digests, refers = (
                utf8_bytes(c) if i == 2 else c.to_pylist() for i, c in enumerate(batch.columns)
            )
            for key, uri, payload, length, digest, first in zip(ids, uris, payloads, lengths, digests, refers, strict=True):
                kind = "response" if first is None else "revisit"
                refers_to = None if first is None else f"{PREFIX}{first}"
                member = record_bytes(f"{PREFIX}{'null' if key is None else key}", kind, uri, payload or b"", length, digest, refers_to)
                sink.write(member)
                size += len(member)
                records += 1
        if sink is not None:
            sink.close()
            row = [pa.array([f"{folder}/{name}"]), pa.array([size], pa.int64()), pa.array([records], pa.int64())]
            yield pa.RecordBatch.from_arrays(row, names=["archive", "bytes", "records"])

    return stage(marked.mapInArrow(run, "archive string, bytes long, records long"), "archives")


def records_from(read, size: int, start: int, stop: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of the records that start in [start, stop); ``read(at, n)`` gives bytes."""
    at = start
    while at < stop:
        window = read(at, min(CHUNK, stop + len(MAGIC) - 1 - at))
        hit = window.find(MAGIC)
        if hit < 0 or at + hit >= stop:
            if len(window) < CHUNK:
                return
            at += len(window) - len(MAGIC) + 1
            continue
        at += hit
        found = _member(read, at, size)
        if found is None:
            at += 1
            continue
        raw, end = found
        fields, begin = parse_head(raw)
        yield at, fields, raw[begin : begin + int(fields["content-length"])]
        at = end


def _member(read, at: int, size: int) -> tuple[bytes, int] | None:
    """The decoded gzip member at ``at`` and where it ends, if it is a whole WARC record."""
    unzip = zlib.decompressobj(31)
    out, pos, step = [], at, 1 << 14
    try:
        while not unzip.eof:
            if pos >= size:
                return None
            chunk = read(pos, step)
            pos += len(chunk)
            out.append(unzip.decompress(chunk))
            if sum(map(len, out[:2])) >= 5 and not b"".join(out[:2]).startswith(b"WARC/"):
                return None
            step = CHUNK
    except zlib.error:
        return None
    raw = b"".join(out)
    head = parse_head(raw)
    if head is None or len(raw) < head[1] + int(head[0]["content-length"]):
        return None
    return raw, pos - len(unzip.unused_data)


def read_archives(archives: DataFrame, split_bytes: int = 8 << 20) -> DataFrame:
    """Records of the listed archives (``archive``, ``bytes``), read in ranges of ``split_bytes``.

    Bytes between records that are no gzip member with a WARC header are skipped, as are truncated last records.
    Fields that a record lacks are null. Empty archives and an empty list give no rows.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    ranges = archives.where("bytes > 0").select("archive", "bytes", F.explode(starts).alias("start"))
    # a task per range: their number is given, as the rows are too small for their work to be seen
    tasks = archives.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    ranges = ranges.repartition(int(min(tasks, 100_000)))
    fields = ["warc-record-id", "warc-type", "warc-target-uri", "warc-refers-to", "warc-payload-digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("archive", pa.string()), ("offset", pa.int64())]
            + [(c, pa.string()) for c in ("record_id", "record_type", "uri", "refers_to", "payload_digest")]
            + [("payload_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
        )

        def flush(rows):
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, where = file_system(path)
                with fs.open_input_file(where) as source:
                    rows, held = [], 0

                    def read(at, n, source=source):
                        source.seek(at)
                        return source.read(n)

                    for offset, head, block in records_from(read, size, start, min(size, start + split_bytes)):
                        known = [head.get(f) for f in fields]
                        known[0], known[3] = (v.strip("<>") if v else v for v in (known[0], known[3]))
                        length = head.get("x-payload-length")
                        length = int(length) if length and length.isdigit() else (None if known[1] == "revisit" else len(block))
                        digest = known[4].partition(":")[2] if known[4] else hashlib.sha256(block).hexdigest()
                        rows.append((path, offset, *known[:4], digest, length, list(head.items()), block))
                        held += len(block)
                        if len(rows) >= 512 or held >= 16 << 20:
                            yield flush(rows)
                            rows, held = [], 0
                    if rows:
                        yield flush(rows)

    return ranges.mapInArrow(run, RECORD)


def archive_list(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(archive, bytes) of archives that lie somewhere already."""
    rows = []
    for p in paths:
        fs, where = file_system(p)
        rows.append((p, fs.get_file_info(where).size))
    return spark.createDataFrame(rows, "archive string, bytes long")


def record_key(column: str):
    """The row id in a record id or reference made by :func:`write_archives` (null if there is none)."""
    return F.expr(f"try_cast(substring({column}, {len(PREFIX) + 1}) as bigint)")


