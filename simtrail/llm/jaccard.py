"""Similarity join on word n-grams: a blocked sparse product of document by n-gram incidence.

Rows of the product are documents, its columns n-grams, and only the entries that can
matter are multiplied. For a threshold t a pair of sets of a and b n-grams must share at
least ``ceil(t * max(a, b))``; so, with all n-grams in one fixed order, the first
``n - ceil(t n) + k`` of either set share at least k (a size-derived bound). The product
over these entries is blocked by n-gram (one join key a column), overlap counts are
accumulated per pair, and pairs below k or of too different sizes are dropped. What is
left is verified on the whole sets.

The order puts the most frequent n-grams last, so that shared lines and passages seldom
enter a product. Documents with equal sets are one row of the matrix. The product is taken
in three steps. First each column is cut into classes of set sizes and one document of a class is
multiplied with the rest of it (stars): overlap counts are accumulated per pair, and what is left
is verified and joins documents to components, so a dense column of near copies shrinks to one without
its pairs. Columns that still hold different components are then multiplied block by block,
only between components, each pair in the first column that both have (entries too far back in their set
to be the first of a link are left out), and only if a parity
sketch of either set (512 to 8192 bits, by its size) leaves room for the threshold (differing bits never outnumber differing
n-grams). Of these candidates only a forest is kept, which ties the documents of a cluster together. Last, the whole sets of a
cluster meet, and pairs between its components are compared on them; a large cluster is cut into blocks, first compared within
themselves, then with each other where components still differ. No table of all pairs of a group is ever made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simtrail.llm.common import slices, utf8_bytes
from simtrail.llm.graph import _top, components, union
from simtrail.session import drop_staged, stage

# Odd multipliers that make one number of a row of word hashes (by place in the n-gram).
PLACES = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1) ^ (0xD1B54A32D192ED03 << i)) % 2**64 | 1 for i in range(16)], np.uint64)
# Common n-grams that must be shared by the leading parts of two sets.
SHARED = 4
# An n-gram in more documents than this is put last, for the most frequent LAST of them. Both move work only;
# any choice gives the same links.
FREQUENT, LAST = 64, 200_000
# Document numbers that are sent to every task instead of shuffled, if there are no more of them.
BROADCAST_IDS = 2_000_000
# Words of more bytes are hashed one by one; texts are hashed together up to about so many bytes.
LONG_WORD, SPAN = 128, 1 << 20
SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)
# By a number of bytes, the mask that keeps them.
BYTES = np.array([256**i - 1 for i in range(9)], np.uint64)
# 64-bit words of the longest parity sketch and of the shortest, and leading n-grams kept beside it to name the first common column.
SKETCH, SHORT, FIRST = 32, 8, 4
# Words of the longest wide sketch, which sets too large for the longest sketch have beside it.
WIDE = 128
ENTRIES = "doc long, n int, gram long, place int, firsts binary"
# In place of a leading n-gram that a small set does not have.
NONE = np.iinfo(np.int64).min
# Rows of a column that one task compares with each other, and of the tiles in which it does.
CELL, TILE = 4096, 256
# N-grams of the sets of a cluster that one task compares with each other, and sets that are sent to it at a time.
GRAMS, SETS = 2_000_000, 256
# Cells of up to so many rows are compared many at a time.
SMALL = 128


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of ``raw`` (cut at ASCII white space), and the byte where it begins. Eight bytes of all words
    are mixed in at a time, so hashes of words of up to eight bytes are equal for equal words only; a long word is hashed by itself."""
    space = SPACE[np.frombuffer(raw, np.uint8)]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    begin, size = edge[::2], edge[1::2] - edge[::2]
    numbers = np.frombuffer(raw + bytes(16 - len(raw) % 8), "<u8")
    out = size.astype(np.uint64) * MIX[0]
    which = np.flatnonzero(size <= LONG_WORD)
    for at in range(0, LONG_WORD, 8):
        which = which[size[which] > at]
        if not which.size:
            break
        place = begin[which] + at
        low, bits = place >> 3, ((place & 7) * 8).astype(np.uint64)
        eight = numbers[low] >> bits | numbers[low + 1] << np.uint64(1) << (np.uint64(63) - bits)
        eight &= BYTES[np.minimum(size[which] - at, 8)]
        mixed = (out[which] ^ eight) * MIX[1]
        mixed ^= mixed >> np.uint64(32)
        mixed *= MIX[2]
        out[which] = mixed ^ mixed >> np.uint64(29)
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(raw[begin[i] : begin[i] + size[i]])
    return out, begin


def _grams(ids: np.ndarray, n: int, size: int) -> np.ndarray:
    """A number for every ``n`` words in a row; those of a short sequence are no full n-grams."""
    out = np.full(max(len(ids) - n + 1, 0), n - size, np.int64).view(np.uint64)
    for i in range(n):
        out += ids[i : i + len(out)] * PLACES[i]
    out ^= out >> np.uint64(31)
    return out.view(np.int64)


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the n-grams of each text: A-Z lower-cased, words cut at ASCII white space;
    with fewer words than ``size`` the whole sequence is one; nothing without words. About ``SPAN`` bytes are hashed at a time.
    """
    ends, sets = np.cumsum([len(t or b"") + 1 for t in texts]), []
    while len(sets) < len(texts):
        first, done = len(sets), int(ends[len(sets) - 1]) if sets else 0
        last = max(first + 1, int(np.searchsorted(ends, done + SPAN, side="right")))
        ids, begin = word_hashes(b"\n".join(t or b"" for t in texts[first:last]).lower())
        grams = _grams(ids, size, size)
        cuts = [0, *np.searchsorted(begin, ends[first:last] - done).tolist()]
        for at, to in zip(cuts[:-1], cuts[1:], strict=True):
            s = np.sort(grams[at : to - size + 1] if to - at >= size else _grams(ids[at:to], to - at, size)[: to - at])
            sets.append(s[np.diff(s, prepend=s[:1] - 1) != 0])
    return sets


def sketch_words(n: int) -> int:
    """Words of the sketch of a set of ``n``: a bit an n-gram, as a power of two from ``SHORT`` to ``SKETCH``."""
    words = SHORT
    while words < SKETCH and 64 * words < n:
        words *= 2
    return words


def wide_words(n: int) -> int:
    """Words of the wide sketch of a set of ``n``: three bits for four n-grams, as a power of two up to ``WIDE``; a shorter one
    differs so little between unrelated sets that it rules none out."""
    words = sketch_words(n)
    while words < WIDE and 4 * 64 * words < 3 * n:
        words *= 2
    return words


def parity_sketch(grams: np.ndarray, words: int = SKETCH) -> np.ndarray:
    """``words`` (a power of two, up to 2048) numbers whose bit i is set when an odd number of n-grams fall on it. A short
    sketch is a long one with its halves xored (:func:`_folded`)."""
    place = (grams.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 17)
    bits = (np.bincount(place.astype(np.int64) & (64 * words - 1), minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def _folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """Sketches (one a row) with their halves xored until they have ``words`` words."""
    while sketch.shape[1] > words:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def leading(n: int, percent: int) -> int:
    """How many n-grams of a set of ``n`` take part in the product."""
    least = -(-percent * n // 100)
    return n - least + min(SHARED, least)


def _sets(docs: DataFrame, size: int, emit: str, percent: int, frequent=None) -> DataFrame:
    """docs: (doc, text). emit 'heads': doc, n, signature, parity sketch of the whole set, a wide one if the set is too large for
    that, head (leading n-grams by hash, half as many again, as bytes); 'entries': as :data:`ENTRIES` for the leading n-grams in the final order; 'sets': doc, n, grams."""
    schema = {
        "heads": "doc long, n int, signature binary, sketch binary, wide binary, head binary",
        "entries": ENTRIES,
        "sets": "doc long, n int, grams array<long>",
    }[emit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = frequent.value if frequent is not None else None
        for batch in slices(batches, 1024):
            ids = batch.column("doc").to_pylist()
            sets = shingle_sets(utf8_bytes(batch.column("text")), size)
            own = [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int32())]
            if emit == "heads":
                heads = [s[: leading(len(s), percent) * 3 // 2] for s in sets]
                wide = [parity_sketch(s, wide_words(len(s))) for s in sets]
                short = [_folded(w[None], sketch_words(len(s)))[0] for w, s in zip(wide, sets, strict=True)]
                cols = [
                    *own,
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([x.tobytes() for x in short], pa.binary()),
                    pa.array([w.tobytes() if len(w) > len(x) else None for w, x in zip(wide, short, strict=True)], pa.binary()),
                    pa.array([h.tobytes() for h in heads], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["doc", "n", "signature", "sketch", "wide", "head"])
            elif emit == "entries":
                heads = [_ordered(s, last)[: leading(len(s), percent)] for s in sets]
                yield _entry_rows(ids, [len(s) for s in sets], heads)
            else:
                yield pa.RecordBatch.from_arrays([*own, _lists(sets)], names=["doc", "n", "grams"])

    return docs.mapInArrow(run, schema)


def _ordered(s: np.ndarray, last: np.ndarray | None) -> np.ndarray:
    """The n-grams (sorted by hash) with the frequent ones put last."""
    if last is None or not last.size or not s.size:
        return s
    common = last[np.minimum(np.searchsorted(last, s), last.size - 1)] == s
    return np.concatenate([s[~common], s[common]])


def _entry_rows(ids: list, n: list[int], heads: list[np.ndarray | None]) -> pa.RecordBatch:
    """A row an n-gram with its place in the order, the first of a document with its first n-grams as one text of bytes; a document
    whose n-grams are not known has one row without n-gram."""
    sizes = [1 if h is None else len(h) for h in heads]
    unknown = np.repeat(np.array([h is None for h in heads], bool), sizes)
    grams = np.concatenate([*(np.zeros(1, np.int64) if h is None else h for h in heads), np.empty(0, np.int64)])
    firsts = []
    for h, size in zip(heads, sizes, strict=True):
        if h is not None and size:
            firsts.append(np.pad(f := h[:FIRST], (0, FIRST - len(f)), constant_values=NONE).tobytes())
        firsts += [None] * (size - 1 if h is not None and size else size)
    cols = [
        pa.array(np.repeat(np.array([i or 0 for i in ids], np.int64), sizes)),
        pa.array(np.repeat(np.array(n, np.int32), sizes)),
        pa.array(grams, mask=unknown),
        pa.array(np.concatenate([*(np.arange(k) for k in sizes), np.empty(0, np.int64)]).astype(np.int32)),
        pa.array(firsts, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(cols, names=["doc", "n", "gram", "place", "firsts"])


def _entries_of_heads(heads: DataFrame, percent: int, frequent) -> DataFrame:
    """Entries by the n-grams kept in the heads (doc, n, head): known if enough of them are not frequent, or if the head is the
    whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = frequent.value
        for batch in slices(batches, 2048):
            n, found = batch.column("n").to_pylist(), []
            for size, raw in zip(n, batch.column("head").to_pylist(), strict=True):
                head, least = np.frombuffer(raw, np.int64), leading(size, percent)
                rare = head
                if last.size and head.size:
                    rare = head[last[np.minimum(np.searchsorted(last, head), last.size - 1)] != head]
                whole = len(head) == size
                found.append(rare[:least] if len(rare) >= least else _ordered(head, last)[:least] if whole else None)
            yield _entry_rows(batch.column("doc").to_pylist(), n, found)

    return heads.select("doc", "n", "head").mapInArrow(run, ENTRIES)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.empty(0, np.int64)])))


def _frequent(heads: DataFrame):
    """The most frequent leading n-grams, sorted, as a broadcast of at most ``LAST`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, n = np.unique(np.frombuffer(b"".join(batch.column("head").to_pylist()), np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n)], names=["gram", "n"])

    counts = heads.select("head").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") > FREQUENT).orderBy(F.desc("n"), "gram").limit(LAST).select("gram").toPandas()
    return heads.sparkSession.sparkContext.broadcast(np.sort(top["gram"].to_numpy(np.int64)))


def _least(n: str) -> str:
    return f"least({SHARED}, ceil(PCT * {n} / 100D))"


def _chosen(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` named in ``ids``: the numbers go to every task if they are few, else both are shuffled."""
    ids = stage(ids.distinct(), "ids")
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc", "left_semi")


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Of candidate pairs (a, b, na, nb), those whose whole sets reach the threshold."""
    ids = pairs.select("a").union(pairs.select("b")).toDF("doc")
    sets = _sets(_chosen(docs, ids), size, "sets", percent)
    left = sets.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("grams").alias("ga"))
    right = sets.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb"))
    both = pairs.join(left, ["a", "na"]).join(right, ["b", "nb"])
    common = F.size(F.array_intersect("ga", "gb"))
    return both.withColumn("common", common).where(f"100 * common >= {percent} * (na + nb - common)").select("a", "b")


def jaccard_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of at least ``percent`` on word n-grams of ``size`` words.

    One row per row of ``docs``: the id column (long), ``n_shingles`` (size of the row's set) and ``component_id``
    (smallest id reachable by links, the row's own included). Exact up to collisions of 64-bit hashes.

    Null or empty texts and texts without words have no n-grams and link with nothing. Equal sets link.
    Rows that share an id are one document in one component, linked through any of their texts. A null id takes no part:
    its component is null. Very long texts count in full. Other columns of ``docs`` do not matter. An
    empty table gives an empty one.
    """
    small = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    heads = stage(_sets(small, size, "heads", percent), "heads")
    frequent = _frequent(heads.where("doc is not null"))
    rows = stage(heads.select("doc", "n", "signature"), "rows")

    several = rows.where("doc is not null").groupBy("doc").count().where("count > 1").select("doc")
    repeated = several.limit(1).count() > 0
    if repeated:
        small = stage(small.distinct(), "texts")  # repeated rows need comparing once only
    classes = rows.where("n > 0 and doc is not null").groupBy("n", "signature").agg(F.min("doc").alias("first"))
    found = _links_of(small, classes, heads, size, percent, frequent)
    if repeated:  # an id with several sets ties their classes together
        many = rows.where("n > 0 and doc is not null").select("doc", "n", "signature").distinct()
        many = many.join(many.groupBy("doc").count().where("count > 1").select("doc"), "doc", "left_semi")
        found = found.union(many.join(classes, ["n", "signature"]).where("doc <> first").select("doc", "first"))
    groups = components(found)
    named = classes.join(groups.withColumnRenamed("node", "first"), "first", "left").select(
        "n", "signature", F.coalesce("component", "first").alias("component")
    )
    out = rows.join(named, ["n", "signature"], "left")
    if repeated:  # a row without words belongs to the other rows of its id
        of_id = out.join(several, "doc", "left_semi").groupBy("doc").agg(F.min("component").alias("_shared"))
        out = out.join(of_id, "doc", "left").withColumn("component", F.coalesce("component", "_shared"))
    own = F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc"))
    return out.select(F.col("doc").alias(id_col), F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def _stars(rows: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b, na, nb) of rows (gram, doc, n, g): in every column, and in it within every class of set sizes that
    can reach the threshold with each other, one document (the least by hash) with all others of another component.

    Overlap counts are accumulated per pair; pairs below the size-derived bound are dropped."""
    width = math.log(100 / percent) if percent < 100 else None
    place = F.floor(F.log(F.col("n").cast("double")) / F.lit(width)) if width else F.col("n").cast("long")
    classed = rows.withColumn("k", place)
    hubs = classed.groupBy("gram", "k").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct(F.xxhash64("doc"), "doc", "n", "g")).alias("c"))
    met = classed.join(hubs.where("m > 1").select("gram", "k", "c.doc", "c.n", "c.g").toDF("gram", "k", "c", "cn", "cg"), ["gram", "k"])
    met = met.where(f"c <> doc and cg <> g and 100 * least(cn, n) >= {percent} * greatest(cn, n)")
    swapped = F.expr("n < cn or (n = cn and doc < c)")
    pair = [F.when(swapped, F.col(x)).otherwise(F.col(y)).alias(z)
            for x, y, z in (("doc", "c", "a"), ("c", "doc", "b"), ("n", "cn", "na"), ("cn", "n", "nb"))]
    counted = met.select(*pair).groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("shared"))
    return counted.where(f"shared >= {_least('na')}".replace("PCT", str(percent))).drop("shared")


def _open(rows: DataFrame) -> DataFrame:
    """Rows (gram, doc, n, place) of the columns that hold two documents."""
    several = rows.groupBy("gram").agg(F.min("doc").alias("d1"), F.max("doc").alias("d2")).where("d1 < d2").select("gram")
    return stage(rows.select("gram", "doc", "n", "place").join(several, "gram"), "open")


def _still_open(rows: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Rows (gram, doc, n, g) of the columns that still hold two components, with the components by ``groups`` (doc, g). In the
    first column that a link has, all that its sets share lies from there on: entries behind which too little is left for the smallest
    partner in the column (and for any within the threshold) are left out."""
    marked = rows.join(groups, "doc", "left").withColumn("g", F.coalesce("g", "doc"))
    marked = stage(marked, "marked")
    several = marked.groupBy("gram").agg(F.min("g").alias("g1"), F.max("g").alias("g2"), F.min("n").alias("least")).where("g1 < g2")
    left = marked.join(several.select("gram", "least"), "gram")
    partner = f"greatest(cast(least as long), ceil({percent} * n / 100D))"
    left = left.where(f"cast(n - place as long) * (100 + {percent}) >= {percent} * (n + {partner})").select("gram", "doc", "n", "g")
    left = stage(left, "open")
    drop_staged(marked)
    return left


def _close(x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Which pairs of two sketch matrices (rows of 64-bit words) differ in at most ``limit`` bits; a few words rule most out."""
    few = np.bitwise_count(x[:, None, :SHORT] ^ y[None, :, :SHORT]).sum(2, dtype=np.int32) <= limit
    if x.shape[1] <= SHORT:
        return few
    i, j = np.nonzero(few)
    step = (SKETCH << 16) // x.shape[1]
    for at in range(0, len(i), step):
        some = slice(at, at + step)
        few[i[some], j[some]] = np.bitwise_count(x[i[some]] ^ y[j[some]]).sum(1, dtype=np.int32) <= limit[i[some], j[some]]
    return few


def _runs(raw: list[bytes]) -> list[tuple[int, int, np.ndarray]]:
    """(first row, end, sketches as a matrix) of neighbouring rows whose sketches are of one length."""
    sizes = np.array([len(r) for r in raw])
    cuts = [0, *(np.flatnonzero(sizes[1:] != sizes[:-1]) + 1).tolist(), len(raw)]
    return [(at, to, np.frombuffer(b"".join(raw[at:to]), np.uint64).reshape(to - at, -1)) for at, to in zip(cuts[:-1], cuts[1:], strict=True)]


def _column_pairs(percent: int, doc, n, g, block, sketch, firsts, gram: int, across: bool) -> Iterator[tuple]:
    """Places (i, j) of pairs in one column, i the smaller set: of different components (and, with ``across``, of
    different blocks), sizes and sketches within the threshold, and no earlier column in common. ``sketch`` is a matrix, or
    runs of them (:func:`_runs`); of sketches of two lengths the longer is folded."""
    runs = [(0, len(doc), sketch)] if isinstance(sketch, np.ndarray) else sketch
    for k, (begin, stop, own) in enumerate(runs):
        for lo in range(begin, stop, TILE):
            hi = min(lo + TILE, stop)
            # rows are in order of (n, doc): partners lie behind, up to the largest size that can reach the threshold
            end = int(np.searchsorted(n, 100 * n[hi - 1] // percent, side="right"))
            tiles = [(at, min(at + 2 * TILE, limit), found[at - start : min(at + 2 * TILE, limit) - start])
                     for start, limit, found in ((max(lo, r[0]), min(end, r[1]), r[2][max(lo, r[0]) - r[0] :]) for r in runs[k:])
                     for at in range(start, limit, 2 * TILE)]
            for at, to, theirs in tiles:
                words = min(own.shape[1], theirs.shape[1])
                size = n[lo:hi, None] + n[None, at:to]
                room = size * (100 - percent) // (100 + percent)
                near = _close(_folded(own[lo - begin : hi - begin], words), _folded(theirs, words), room)
                near &= (g[lo:hi, None] != g[None, at:to]) & (100 * n[lo:hi, None] >= percent * n[None, at:to])
                near &= np.arange(lo, hi)[:, None] < np.arange(at, to)[None]
                if across:
                    near &= block[lo:hi, None] != block[None, at:to]
                i, j = np.nonzero(near)
                if i.size:
                    i, j = i + lo, j + at
                    first = _first_common(firsts, i, j, gram)
                    yield i[first], j[first]


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit numbers of all rows of a column of bytes, and where each row begins (and the last ends)."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint64, (ends[-1] - ends[0]) // 8, ends[0]), (ends - ends[0]) // 8


def _first_common(firsts: np.ndarray, i: np.ndarray, j: np.ndarray, gram) -> np.ndarray:
    """Which pairs of rows have no earlier column in common than ``gram``, as far as their first n-grams tell."""
    shared = (firsts[i][:, :, None] == firsts[j][:, None, :]) & (firsts[i] != NONE)[:, :, None]
    known = shared.any(2)
    return ~known.any(1) | (firsts[i][np.arange(len(i)), known.argmax(1)] == gram)


def _small_pairs(percent: int, cell, n, g, block, sketch: tuple, firsts, gram, across) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`_column_pairs`, for many small cells at once (rows in order of cell, n, doc; ``gram`` and ``across`` a row): every
    row is compared with the next of its cell, then with the second next, as long as sizes allow."""
    numbers, begin = sketch
    words = np.diff(begin)
    folds = {}  # by length, the sketches of at least that many words
    for w in sorted({SHORT, *words.tolist()}):
        folds[w] = np.zeros((len(n), w), np.uint64)
        for own in np.unique(words[words >= w]).tolist():
            at = np.flatnonzero(words == own)
            folds[w][at] = _folded(numbers[begin[at][:, None] + np.arange(own)], w)
    found = []
    x, step = np.arange(len(n)), 0
    while x.size:
        step += 1
        x = x[x + step < len(n)]
        x = x[(cell[x] == cell[x + step]) & (100 * n[x] >= percent * n[x + step])]
        i = x[(g[x] != g[x + step]) & (~across[x] | (block[x] != block[x + step]))]
        j = i + step
        for w, fold in folds.items():
            room = (n[i] + n[j]) * (100 - percent) // (100 + percent)
            near = np.bitwise_count(fold[i] ^ fold[j]).sum(1, dtype=np.int32) <= room
            near |= np.minimum(words[i], words[j]) < w
            i, j = i[near], j[near]
        first = _first_common(firsts, i, j, gram[i])
        found.append((i[first], j[first]))
    i, j = (np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in (0, 1))
    order = np.lexsort((j, i))
    return i[order], j[order]


def _cell_pairs(percent: int, rows: pa.RecordBatch, cuts: np.ndarray, spanning: bool) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of whole cells that begin (and the last ends) at the rows ``cuts``; with ``spanning`` a forest of each cell
    that connects the rows its pairs connect."""

    def columns(part: pa.RecordBatch) -> list[np.ndarray]:
        numbers = [part.column(c).to_numpy().astype(np.int64) for c in ("doc", "n", "g", "block")]
        return [*numbers, _words(part.column("firsts"))[0].view(np.int64).reshape(-1, FIRST)]

    def chosen(doc, n, x, y) -> pa.RecordBatch:
        cols = [pa.array(doc[x]), pa.array(doc[y]), pa.array(n[x].astype(np.int32)), pa.array(n[y].astype(np.int32))]
        return pa.RecordBatch.from_arrays(cols, names=["a", "b", "na", "nb"])

    sizes = np.diff(cuts)
    for k in np.flatnonzero(sizes > SMALL):
        part = rows.slice(cuts[k], sizes[k])
        doc, n, g, block, firsts = columns(part)
        gram, i, j = (part.column(c)[0].as_py() for c in ("gram", "i", "j"))
        up: dict[int, int] = {}
        for x, y in _column_pairs(percent, doc, n, g, block, _runs(part.column("sketch").to_pylist()), firsts, gram, i != j):
            if spanning:
                new = np.array([union(up, a, b) for a, b in zip(x.tolist(), y.tolist(), strict=True)], bool)
                x, y = x[new], y[new]
            yield chosen(doc, n, x, y)
    small = np.flatnonzero((sizes > 1) & (sizes <= SMALL))
    if not small.size:
        return
    cell = np.repeat(np.arange(len(sizes)), sizes)
    part = rows.filter(pa.array(np.isin(cell, small)))
    doc, n, g, block, firsts = columns(part)
    gram, i, j = (part.column(c).to_numpy() for c in ("gram", "i", "j"))
    cell = np.repeat(small, sizes[small])
    x, y = _small_pairs(percent, cell, n, g, block, _words(part.column("sketch")), firsts, gram, i != j)
    if spanning:
        up = {}  # rows of different cells never meet
        new = np.array([union(up, a, b) for a, b in zip(x.tolist(), y.tolist(), strict=True)], bool)
        x, y = x[new], y[new]
    yield chosen(doc, n, x, y)


def _later(rest: DataFrame, percent: int, spanning: bool, about: DataFrame | None = None) -> DataFrame:
    """Candidate pairs between different components of rows (gram, doc, n, g, sketch, firsts), each in the first column that
    both documents have. A column of many rows is cut into blocks, and pairs of blocks are cells of their own. With
    ``spanning`` a task gives only a forest that connects the sets its candidates connect. ``about`` (doc, n,
    sketch, firsts) holds what ``rest`` then lacks; it is looked up after the dealing, so that only one shuffle carries sketches."""
    counts = rest.groupBy("gram").count().where(f"count > {CELL}").select("gram", F.ceil(F.col("count") / CELL).cast("int").alias("s"))
    # at most a row for every CELL rows of the table
    rows = rest.join(F.broadcast(counts), "gram", "left").withColumn("s", F.coalesce("s", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc"), F.col("s")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("_o")
    rows = rows.select("*", other).withColumn("i", F.least("block", "_o")).withColumn("j", F.greatest("block", "_o"))
    rows = rows.join(about, ["doc", "n"]) if about is not None else rows
    cells = rows.select("gram", "i", "j", "n", "doc", "g", "block", "sketch", "firsts")
    sorted_cells = cells.repartition("gram", "i", "j").sortWithinPartitions("gram", "i", "j", "n", "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[tuple, tuple] = {}
        for rows, cuts in _whole_cells(batches, ["gram", "i", "j"]):
            for pairs in _cell_pairs(percent, rows, cuts, spanning):
                if spanning:
                    a, b, na, nb = (c.to_pylist() for c in pairs.columns)
                    pairs = pairs.filter(pa.array([union(up, x, y) for x, y in zip(zip(a, na), zip(b, nb), strict=True)], pa.bool_()))
                yield pairs

    return sorted_cells.mapInArrow(run, "a long, b long, na int, nb int").distinct()


def _whole_cells(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of whole cells, told apart by ``key``, and the rows at which they begin (and the last ends)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            rows = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
            keys = np.stack([rows.column(c).to_numpy() for c in key], 1)
            cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1])
            if cuts[-1]:
                yield rows.slice(0, cuts[-1]), cuts
            held = [rows.slice(cuts[-1])]  # its cell may go on
    for rows in held:
        yield rows, np.array([0, rows.num_rows])


def _set_links(percent: int, doc, n, g, block, grams: list[np.ndarray], across: bool) -> list[tuple[int, int]]:
    """Links that join the components of the sets ``grams`` (in order of size) as all their links do; with ``across`` only those
    between different blocks count."""
    sketches = _runs([parity_sketch(s, wide_words(2 * len(s))).tobytes() for s in grams])
    firsts = np.full((len(doc), 1), NONE)  # every pair is compared here
    up: dict[int, int] = {}
    links = []
    for x, y in _column_pairs(percent, doc, n, g, block, sketches, firsts, 0, across):
        roots = np.array([_top(up, k) for k in g.tolist()])
        apart = roots[x] != roots[y]
        for i, j in zip(x[apart].tolist(), y[apart].tolist(), strict=True):
            if _top(up, int(g[i])) != _top(up, int(g[j])):
                common = np.intersect1d(grams[i], grams[j], assume_unique=True).size
                if 100 * common >= percent * (len(grams[i]) + len(grams[j]) - common):
                    union(up, int(g[i]), int(g[j]))
                    links.append((int(doc[i]), int(doc[j])))
    return links


def _compared(dealt: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) that join the components within cells (cluster, i, j) of rows (doc, n, g, block), compared on their whole sets;
    with i and j different, only blocks with each other. Written to the shared folder."""
    spark, key = docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    dealt = stage(dealt, "dealt")
    sets = _sets(_chosen(docs, dealt.select("doc")), size, "sets", percent)
    cells = sets.join(F.broadcast(dealt) if dealt.count() <= BROADCAST_IDS // 4 else dealt, ["doc", "n"])
    cells = cells.select("cluster", "i", "j", "n", "doc", "g", "block", "grams")
    sorted_cells = cells.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "n", "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in _whole_cells(batches, ["cluster", "i", "j"]):
            for at, to in zip(cuts[:-1], cuts[1:], strict=True):
                cell = rows.slice(at, to - at)
                doc, n, g, block = (cell.column(c).to_numpy().astype(np.int64) for c in ("doc", "n", "g", "block"))
                grams = [x.values.to_numpy() for x in cell.column("grams")]
                links = _set_links(percent, doc, n, g, block, grams, cell.column("i")[0] != cell.column("j")[0])
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    before = spark.conf.get(key)
    if not 0 < int(before) <= SETS:
        spark.conf.set(key, str(SETS))  # whole sets are long
    try:
        found = stage(sorted_cells.mapInArrow(run, "a long, b long"), "linked")
    finally:
        spark.conf.set(key, before)
    drop_staged(dealt)
    return found


def _groups(links: DataFrame) -> DataFrame:
    return components(links).toDF("doc", "g")


def _cluster_links(near: DataFrame, linked: DataFrame, groups: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links that, with those of ``linked`` (their components are ``groups``), join what all links among the candidates do, of which
    ``near`` (a, b, na, nb) is a forest. Sets of a cluster are compared in blocks of :data:`GRAMS` n-grams. Those of a larger
    cluster are compared with other blocks afterwards, and its largest component then not with itself."""
    ends = near.select("a", "na").union(near.select("b", "nb")).distinct().toDF("doc", "n")
    clusters = components(near.select("a", "b")).toDF("doc", "cluster")
    members = stage(ends.join(clusters, "doc"), "members")
    weights = members.groupBy("cluster").agg(F.sum("n").alias("w"))

    def marked(groups: DataFrame) -> DataFrame:
        return members.join(groups, "doc", "left").withColumn("g", F.coalesce("g", "doc")).withColumn("h", F.xxhash64("doc"))

    rows = marked(groups).join(weights, "cluster").withColumn("block", F.expr(f"int(pmod(h, ceil(w / {GRAMS}D)))"))
    inside = _compared(rows.select("cluster", F.col("block").alias("i"), F.col("block").alias("j"), "n", "doc", "g", "block"), docs, size, percent)
    large = weights.where(f"w > {GRAMS}").select("cluster")
    if large.limit(1).count():
        rows = stage(marked(_groups(linked.union(inside))).join(large, "cluster"), "marked")
        sizes = rows.groupBy("cluster", "g").agg(F.sum("n").alias("w"))
        top = sizes.groupBy("cluster").agg(F.max(F.struct("w", "g")).alias("t"), F.sum("w").alias("w"), F.count(F.lit(1)).alias("c"))
        half = GRAMS // 2
        top = top.where("c > 1").selectExpr("cluster", "t.g as t", f"int(ceil(t.w / {half}D)) as k", f"int(ceil((w - t.w) / {half}D)) as r")
        # blocks below r hold the other components and meet all blocks, those from r on the largest and meet the others only
        rows = rows.join(top, "cluster").withColumn("block", F.expr("int(if(g = t, r + pmod(h, k), pmod(h, r)))"))
        rows = rows.withColumn("o", F.explode(F.expr("sequence(0, if(g = t, r, r + k) - 1)")))
        rows = rows.select("cluster", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "n", "doc", "g", "block")
        inside = inside.union(_compared(rows, docs, size, percent))
    drop_staged(members)
    return inside


def _links_of(docs: DataFrame, classes: DataFrame, heads: DataFrame, size: int, percent: int, frequent) -> DataFrame:
    """Links between class representatives that suffice for the components: stars, then those within the clusters of the candidates
    that are still open. Deletes ``heads``."""
    first = stage(classes.select("first", "n"), "first")
    own = first.select(F.col("first").alias("doc"), "n")
    own = F.broadcast(own) if first.count() <= BROADCAST_IDS else own
    # one row of the matrix per class: the other members make no entries
    members = heads.where("doc is not null and n > 0").join(own, ["doc", "n"], "left_semi")
    marks = stage(members.select("doc", "n", F.coalesce("wide", "sketch").alias("sketch")), "marks")
    entries = stage(_entries_of_heads(members, percent, frequent), "entries")
    drop_staged(heads)
    # few documents have too many frequent n-grams among those kept: their texts are read again
    again = _sets(_chosen(docs.where("doc is not null"), entries.where("gram is null").select("doc")), size, "entries", percent, frequent)
    again = stage(again.join(own, ["doc", "n"], "left_semi"), "again")
    every = entries.where("gram is not null").union(again)
    leads = stage(every.where("firsts is not null").select("doc", "n", "firsts").distinct(), "leads")
    rest = _open(every)
    drop_staged(entries)
    drop_staged(again)
    about = stage(marks.join(leads, ["doc", "n"]).distinct(), "about")
    pairs = stage(_stars(rest.withColumn("g", F.col("doc")), percent), "pairs")
    linked = stage(_verified(pairs, docs, size, percent), "linked")
    groups = _groups(linked)
    before, rest = rest, _still_open(rest, groups, percent)
    drop_staged(before)
    near = stage(_later(rest, percent, True, about), "near")
    for staged in (rest, first, marks, leads, about):
        drop_staged(staged)
    return linked.union(_cluster_links(near, linked, groups, docs, size, percent))
