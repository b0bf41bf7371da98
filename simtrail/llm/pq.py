"""Near-duplicate embeddings by product quantisation.

Unit vectors are put into inverted lists by their nearest coarse centroid; the residual of
each is coded per subspace by its nearest codeword, and the coding error is kept. A vector
probes every list whose cell is close enough: for two vectors at distance r, one of them
lies within r / 2 of the plane between their centroids, so probing all lists within half
the largest linking distance is sufficient for every link. Within a list, asymmetric
distances (query against the decoded codewords, by one matrix product) drop rows that are
farther than the linking distance plus their coding error; the rest is ranked by the exact
cosine.

Equal vectors are one row with a count. The rows of a list are packed into blocks that are
written once; pairs of blocks are read from there, each pair by one task, so nothing is
copied by list or by block over a shuffle and the disk grows with the rows, whatever they
probe. Tasks give link counts and one tree of links per group found, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simtrail.llm.graph import _top, components, union
from simtrail.llm.vectors import comparable, matrix, sample_matrix
from simtrail.session import drop_staged, settings, stage

GROUP, CODES = 2048, 256
# Bytes of a row group of blocks, of joined blocks sent to a task's Python code at a time, and of blocks that it keeps open.
FILE_BYTES, SENT_BYTES, HELD_BYTES = 16 << 20, 16 << 20, 48 << 20
# Linked ids that a task holds before it hands results on.
HELD_IDS = 500_000
KEYED = "id long, d int, key binary, raw binary"
MEMBER = "id long, copies long, raw binary, list int, code binary, missed double, probes binary"
BLOCK = pa.schema(
    [("block", pa.int64()), ("list", pa.int32())]
    + [(c, pa.binary()) for c in ("ids", "copies", "missed", "raw", "codes", "probes")]
    + [("asks", pa.list_(pa.int32()))]
)
KINDS = {"int64": "long", "int32": "int", "binary": "binary", "list<item: int32>": "array<int>"}


def kmeans(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Lloyd's rounds from distinct sample points; an empty cell takes the point farthest from its centre."""
    start = np.unique(points, axis=0)
    centres = start[rng.permutation(len(start))[: min(k, len(start))]].copy()
    for _ in range(rounds):
        far = (centres**2).sum(1) - 2 * points @ centres.T
        own = far.argmin(1)
        count = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, points)
        full = count > 0
        centres[full] = total[full] / count[full, None]
        if not full.all():
            spare = np.argsort(-far[np.arange(len(points)), own])[: (~full).sum()]
            centres[~full] = points[spare]
    return centres


class Quantiser:
    """Coarse centroids and one codebook per subspace of the residuals."""

    def __init__(self, points: np.ndarray, lists: int, parts: int, seed: int = 9):
        rng = np.random.default_rng(seed)
        self.centres = kmeans(points, lists, rng)
        self.edges = np.linspace(0, points.shape[1], min(parts, points.shape[1]) + 1).astype(int)
        residual = points - self.centres[self.nearest(points)]
        self.books = [kmeans(residual[:, a:b], CODES, rng, 6) for a, b in zip(self.edges[:-1], self.edges[1:], strict=True)]

    @cached_property
    def between(self) -> np.ndarray:
        """Distances of the centres, by one product; those so close that its rounding could show by their difference."""
        d = self.squared(self.centres)
        for a, b in zip(*np.nonzero(d < 1e-6 * (1 + (self.centres**2).sum(1)[:, None])), strict=True):
            d[a, b] = ((self.centres[a] - self.centres[b]) ** 2).sum()
        return np.sqrt(np.maximum(d, 1e-30))

    def squared(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x**2).sum(1)[:, None] + (self.centres**2).sum(1) - 2 * x @ self.centres.T, 0)

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return self.squared(x).argmin(1)

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and the length of what they miss."""
        codes, missed = np.empty((len(residual), len(self.books)), np.uint8), np.zeros(len(residual))
        for j, (book, a, b) in enumerate(zip(self.books, self.edges[:-1], self.edges[1:], strict=True)):
            part = residual[:, a:b]
            codes[:, j] = ((book**2).sum(1) - 2 * part @ book.T).argmin(1)
            missed += ((part - book[codes[:, j]]) ** 2).sum(1)
        return codes, np.sqrt(missed)

    def probes(self, x: np.ndarray, own: np.ndarray, reach: float) -> np.ndarray:
        """Which lists' cells come within ``reach`` of each vector (its own always), as a bit matrix."""
        d = self.squared(x)
        gap = (d - d[np.arange(len(x)), own][:, None]) / (2 * self.between[own])
        near = gap <= reach + 1e-7
        near[np.arange(len(x)), own] = True
        return near

    def decode(self, codes: np.ndarray, lst: int) -> np.ndarray:
        """What the codes of one list's rows stand for."""
        residual = np.concatenate([book[codes[:, j]] for j, book in enumerate(self.books)], axis=1)
        return (residual + self.centres[lst]).astype(np.float32)


def units(x: np.ndarray) -> np.ndarray:
    """The rows scaled to length 1; by their largest component first: no overflow, no vanishing squares."""
    x = x.astype(np.float64)
    y = x / np.abs(x).max(1)[:, None]
    square = np.zeros(len(y))
    for j in range(y.shape[1]):
        square += y[:, j] * y[:, j]
    return y / np.sqrt(square)[:, None]


def unpacked(raw: bytes, d: int, n: int) -> np.ndarray:
    """``n`` vectors from their bytes, single numbers or double ones."""
    return np.frombuffer(raw, np.float32 if len(raw) == 4 * n * d else np.float64).reshape(n, d)


class Block:
    """Some rows of one list: ids, copies, codes and what they miss, probes; vectors from their bytes."""

    def __init__(self, quant: Quantiser, row: dict, d: int):
        self.number, self.list = row["block"], row["list"]
        self.id, self.copies = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["copies"], np.int64)
        n = len(self.id)
        self.missed = np.frombuffer(row["missed"], np.float64)
        self.probes = np.unpackbits(np.frombuffer(row["probes"], np.uint8).reshape(n, -1), axis=1, count=len(quant.centres)).astype(bool)
        self.vectors = unpacked(row["raw"], d, n)
        self.single = self.unit(slice(None)).astype(np.float32)
        self.coded = quant.decode(np.frombuffer(row["codes"], np.uint8).reshape(n, -1), self.list)
        self.coded_square = (self.coded.astype(np.float64) ** 2).sum(1)
        self.bytes = self.vectors.nbytes + 2 * self.single.nbytes + n * (32 + self.probes.shape[1])

    def unit(self, rows: np.ndarray | slice) -> np.ndarray:
        return units(self.vectors[rows])


def links_from(q: Block, m: Block, asking: np.ndarray, held: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices (query, member) of the links of rows ``asking`` of one block with rows ``held`` of another."""
    if not len(asking) or not len(held):
        return np.empty(0, int), np.empty(0, int)
    far = np.sqrt(2 - 2 * threshold)
    # |q - c|^2 <= (far + missed)^2 by the product q c, with more slack than single numbers need
    least = ((1 + m.coded_square[held] - (far + m.missed[held] + 1e-3) ** 2) / 2 - 1e-5).astype(np.float32)
    coded = m.coded if len(held) == len(m.id) else m.coded[held]
    found_q, found_m = [], []
    for at in range(0, len(asking), 256):
        near = q.single[asking[at : at + 256]] @ coded.T >= least
        a, b = np.divmod(np.flatnonzero(near), len(held))  # several times faster than a search by both axes
        found_q.append(asking[a + at])
        found_m.append(held[b])
    a, b = np.concatenate(found_q), np.concatenate(found_m)
    if not len(a):
        return a, b
    good = np.empty(len(a), bool)
    for at in range(0, len(a), 1 << 12):
        some = slice(at, at + (1 << 12))
        good[some] = (q.unit(a[some]) * m.unit(b[some])).sum(1) >= threshold
    return a[good], b[good]


def block_links(a: Block, b: Block, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices (in ``a``, in ``b``) of the links of two blocks, each link once: those that a row of ``a`` finds in the list of
    ``b``, and those of its other rows that are found from ``b``."""
    every_a, every_b = np.arange(len(a.id)), np.arange(len(b.id))
    if a.number == b.number:
        i, j = links_from(a, a, every_a, every_a, threshold)
        once = i < j
        i, j = i[once], j[once]
    else:
        asks = a.probes[:, b.list]
        i, j = links_from(a, b, every_a[asks], every_b, threshold)
        back = links_from(b, a, every_b[b.probes[:, a.list]], every_a[~asks], threshold)
        i, j = np.concatenate([i, back[1]]), np.concatenate([j, back[0]])
    other = a.id[i] != b.id[j]
    return i[other], j[other]


def near_duplicates(
    df: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding", sample: int = 20_000, parts: int = 8
) -> DataFrame:
    """Links of cosine >= ``threshold`` among all rows, as link counts and groups.

    One row per row of ``df``: the id column, ``n_links`` (other rows linked directly), ``component_id`` (smallest id
    reachable, its own included) and ``kept`` (id = component_id). The quantiser is fitted on at most ``sample`` rows;
    every row is indexed, and the probes are sufficient for every link.

    Null, zero or non-finite vectors link with nothing (0, own id, kept), and vectors of different lengths not with each
    other. Equal vectors link. Rows with the same id are one vertex of the graph; each row counts as a link
    of the others. A null id has null group and null ``kept``. An empty table gives an empty one.
    """
    spark = df.sparkSession
    named = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    read = named.select("id", F.when(comparable(), F.col("vec")).alias("vec")).mapInArrow(_keyed, KEYED)
    every = stage(read.select("id", "key"), "keys")
    # equal vectors are one row: its smallest id, how many there are
    same = read.where("key is not null").groupBy("d", "key", "raw").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    same = stage(same, "same")
    lengths = [r[0] for r in same.select("d").distinct().collect()]
    if not lengths:
        return _answer(every, spark.createDataFrame([], "key binary, n_links long, component long"), id_col)
    found = reduce(DataFrame.union, [_links(same.where(F.col("d") == d), d, threshold, sample, parts) for d in sorted(lengths)])
    links = found.groupBy("id", "d").agg(F.sum("links").alias("links"))
    # rows that share an id tie their vectors together, too
    firsts = same.select("d", "key", "id", "copies")
    shared = every.where("key is not null").join(firsts.select("key", F.col("id").alias("first")), "key").where("id <> first")
    groups = components(found.select("id", "parent").union(shared.select("id", "first")))
    each = (
        firsts.join(links, ["id", "d"], "left")
        .join(groups.withColumnRenamed("node", "id"), "id", "left")
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    )
    return _answer(every, each, id_col)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's vector as bytes (single numbers where they hold all of it) with a digest; null without a vector. Equal vectors
    have equal bytes."""
    for batch in batches:
        column, n = batch.column("vec"), batch.num_rows
        length = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        raw: list[bytes | None] = [None] * n
        for d in np.unique(length[length > 0]):
            at = np.flatnonzero(length == d)
            x = matrix(column.take(pa.array(at))) + 0.0  # one zero
            with np.errstate(over="ignore"):
                single = x.astype(np.float32)
            exact = (single == x).all(1)
            for i, e, v, w in zip(at.tolist(), exact.tolist(), single, x, strict=True):
                raw[i] = v.tobytes() if e else w.tobytes()
        key = [None if r is None else blake2b(r, digest_size=16, person=b"%d" % d).digest() for r, d in zip(raw, length.tolist(), strict=True)]
        cols = [batch.column("id"), pa.array(length.astype(np.int32)), pa.array(key, pa.binary()), pa.array(raw, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["id", "d", "key", "raw"])


def _vectors(column: pa.Array, d: int) -> np.ndarray:
    """The vectors of a column of bytes."""
    return np.concatenate([np.empty((0, d)), *(unpacked(r, d, 1) for r in column.to_pylist())])


def _links(same: DataFrame, d: int, threshold: float, sample: int, parts: int) -> DataFrame:
    """Staged (id, links, parent, d) of the links among distinct vectors (id, copies, raw) of one length d."""
    spark, n = same.sparkSession, same.count()

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = units(_vectors(batch.column("raw"), d))
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * d)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], names=["id", "vec"])

    points = sample_matrix(same.select("id", "raw").mapInArrow(scaled, "id long, vec array<double>"), n, sample)[1]
    quant = Quantiser(points, max(1, min(int(n**0.5 / 8), len(points) // 16)), parts)
    sent = spark.sparkContext.broadcast(quant)
    reach, size = float(np.sqrt(2 - 2 * threshold) / 2), GROUP

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            x = units(_vectors(batch.column("raw"), d))
            own = known.nearest(x)
            codes, missed = known.encode(x - known.centres[own])
            near = known.probes(x, own, reach)
            cols = [*(batch.column(c) for c in ("id", "copies", "raw")), pa.array(own.astype(np.int32))]
            cols += [pa.array([c.tobytes() for c in codes]), pa.array(missed), pa.array([p.tobytes() for p in np.packbits(near, axis=1)])]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "copies", "raw", "list", "code", "missed", "probes"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, held, made = len(sent.value.centres), {}, TaskContext.get().partitionId() << 32

        def block(lst: int, rows: pa.Table) -> pa.RecordBatch:
            nonlocal made
            made += 1
            raw = rows["raw"].to_pylist()
            if len({len(r) for r in raw}) > 1:
                raw = [r if len(r) == 8 * d else unpacked(r, d, 1).astype(np.float64).tobytes() for r in raw]
            probes = b"".join(rows["probes"].to_pylist())
            bits = np.unpackbits(np.frombuffer(probes, np.uint8).reshape(len(raw), -1), axis=1, count=lists)
            numbers = [rows[c].to_numpy().tobytes() for c in ("id", "copies", "missed")]
            row = [made, lst, *numbers, b"".join(raw), b"".join(rows["code"].to_pylist()), probes, np.flatnonzero(bits.any(0)).tolist()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, BLOCK, strict=True)], schema=BLOCK)

        for batch in batches:
            lst = batch.column("list").to_numpy()
            for one in np.unique(lst).tolist():
                some = pa.Table.from_batches([batch.take(pa.array(np.flatnonzero(lst == one)))])
                rows = pa.concat_tables([held.pop(one), some]) if one in held else some
                while rows.num_rows >= size:
                    yield block(one, rows.slice(0, size))
                    rows = rows.slice(size)
                if rows.num_rows:
                    held[one] = rows.combine_chunks()
        for one, rows in held.items():
            yield block(one, rows)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, blocks, trees, links, kept = sent.value, {}, {}, {}, 0

        def opened(batch: pa.RecordBatch, i: int, side: str) -> Block:
            nonlocal kept
            value = lambda c: batch.column(side + c)[i].as_py()
            number = value("block")
            if number not in blocks:
                while blocks and kept > HELD_BYTES:
                    kept -= blocks.pop(next(iter(blocks))).bytes
                blocks[number] = Block(known, {c: value(c) for c in BLOCK.names if c != "asks"}, d)
                kept += blocks[number].bytes
            return blocks[number]

        def result() -> pa.RecordBatch:
            ids = list(links)
            cols = [ids, [links[i] for i in ids], [_top(trees, i) for i in ids]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "links", "parent"])

        for batch in batches:
            for i in range(batch.num_rows):
                a, b = opened(batch, i, "a_"), opened(batch, i, "b_")
                at, to = block_links(a, b, threshold)
                if not len(at):
                    continue
                ends, other = np.concatenate([a.id[at], b.id[to]]), np.concatenate([b.copies[to], a.copies[at]])
                ids, place = np.unique(ends, return_inverse=True)
                counts = np.bincount(place, other, len(ids)).astype(np.int64)
                for x, c in zip(ids.tolist(), counts.tolist(), strict=True):
                    links[x] = links.get(x, 0) + c
                for x, y in zip(a.id[at].tolist(), b.id[to].tolist(), strict=True):
                    union(trees, x, y)
                if len(links) > HELD_IDS:
                    yield result()
                    links, trees = {}, {}
        if links:
            yield result()

    # lists together, a large one cut where it is larger than a task's share
    listed = same.select("id", "copies", "raw").mapInArrow(members, MEMBER).hint("rebalance", F.col("list"))
    files = {"maxRecordsPerFile": max(1, n // (size * 2 * spark.sparkContext.defaultParallelism)), "parquet.block.size": FILE_BYTES}
    blocks = stage(listed.mapInArrow(pack, ", ".join(f"{f.name} {KINDS[str(f.type)]}" for f in BLOCK)), "blocks", **files)
    a, b = (blocks.select(*(F.col(c).alias(f"{side}_{c}") for c in BLOCK.names)) for side in "ab")
    # of two blocks, either order is read; which one counts changes from pair to pair, so that tasks have like shares
    first = F.when((F.col("a_block") + F.col("b_block")) % 2 == 0, F.col("a_block") < F.col("b_block")).otherwise(F.col("a_block") > F.col("b_block"))
    asked = F.array_contains("a_asks", F.col("b_list")) | F.array_contains("b_asks", F.col("a_list"))
    pairs = a.hint("shuffle_replicate_nl").join(b, (F.col("a_block") == F.col("b_block")) | (first & asked)).drop("a_asks", "b_asks")
    with settings(spark, spark__sql__execution__arrow__maxBytesPerBatch=SENT_BYTES):
        found = stage(pairs.mapInArrow(search, "id long, links long, parent long"), "found")
    drop_staged(blocks)
    return found.withColumn("d", F.lit(d))


def _answer(every: DataFrame, each: DataFrame, id_col: str) -> DataFrame:
    # rows without a vector match nothing and would meet in one task
    some = every.where("key is not null").join(each, "key", "left").select("id", "n_links", "component")
    none = every.where("key is null").select("id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component"))
    out = some.union(none)
    group = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long")).alias("n_links"),
        group.alias("component_id"),
        (F.col("id") == group).alias("kept"),
    )
