"""Exact (and approximate) top-k vector search: the vector theta join (C6) with its filters.

Both sides travel as packed blocks, rows of (cell, ids, matrix); none passes through Python on the driver::

    corpus scan (id, vector, filter columns) --mapInArrow--> blocks of one cell   [no shuffle]
    queries --> routes (query, cell) ----------mapInArrow--> blocks of one cell
    join of blocks on (cell, salt) --mapInArrow--> matrix product, masks, best row per ticket,
                                                   top-k per query block and task
    --> max(score) per (target, ticket_id)   [partial agg map side, shuffle on both keys]
    --> row_number over target ORDER BY score DESC, ticket_id <= k   [WindowGroupLimit]

A *cell* is what decides whether a query may see a row: one for a plain search, the (product,
module) values with filters, the list of an inverted file, or both. The distinct values of both sides are
matched once (prefixes and substrings become join keys), and a query is routed to the matching
cells only, so rows outside its filter or lists are never scored.

The query blocks are broadcast when their bytes are counted and small, by the driver's heap too; otherwise both sides are
shuffled on (cell, salt): corpus blocks are dealt over the salts, query blocks copied to each, so one hot
cell is spread over many tasks. The corpus is read once either way.

Why the local cut is exact: a ticket in the global top-k of a target is in the
top-k of the block that holds its best row (same total order everywhere:
rounded score desc, ticket_id asc), so cutting each block to its top k
never loses a final row. Filters are applied before the cut.

Skew: rows per target reaching the final window are bounded by (tasks x cells x k), not by the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simtrail.functions.text import let
from simtrail.session import sent_bytes, stage

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("target", T.LongType()),
        T.StructField("ticket_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)

_RANKED_SCHEMA = T.StructType(RESULT_SCHEMA.fields + [T.StructField("rank", T.LongType())])
_ROW_FIELD = T.StructField("query_row", T.StringType())
_BLOCK_SCHEMA = "cell string, salt int, block long, ids binary, names array<string>, vecs binary"


def _with_row(schema: T.StructType, keyed: bool) -> T.StructType:
    """The schema with the query-row key after the target."""
    return T.StructType([schema.fields[0], _ROW_FIELD, *schema.fields[1:]]) if keyed else schema


# Bytes of routed query vectors up to which their blocks are broadcast; larger query sets are shuffled.
DEFAULT_BLOCK_BYTES = 64 << 20
# A broadcast passes through the driver, which holds it several times over: at most this part of its heap.
HEAP_PART = 64
# Bytes of joined blocks that a task's Python code is sent at a time.
SENT_BYTES = 16 << 20
# Query rows at most on which the number of lists to probe is measured.
MEASURED_QUERIES = 128
# Bytes of one packed matrix (float64), and rows of a query block.
PACKED_BYTES, QUERY_ROWS = 1 << 20, 2048
# Files of a list of a stored index, at most.
LIST_FILES = 8
# Bytes a task holds before it hands packed blocks on, and scored rows before it hands results on.
HELD_BYTES, HELD_RESULTS = 32 << 20, 2_000_000
# Products that are scored at once.
TILE = 1 << 19


@dataclass(frozen=True)
class FilterSpec:
    """Which candidate rows a query may see.

    use_product / use_module: candidate product (module) starts with the query's value (AND-ed).
    interactive: candidate product starts with the query product OR candidate module contains
    the query module (the single-query search form).
    match: "literal" (startswith / contains) or "regex" (pattern at the start / anywhere).
    A NULL query value matches nothing.
    """

    use_product: bool = False
    use_module: bool = False
    interactive: bool = False
    match: str = "literal"

    @property
    def needs_product(self) -> bool:
        return self.use_product or self.interactive

    @property
    def needs_module(self) -> bool:
        return self.use_module or self.interactive


def _compact(q, t, s, k):
    """Best score per (q, t), then the first k per q by score desc, t asc (a total order, so no ties are kept)."""
    if len(q) == 0:
        return q, t, s
    o = np.lexsort((t, q))
    q, t, s = q[o], t[o], s[o]
    st = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]) | (t[1:] != t[:-1])])
    s = np.maximum.reduceat(s, st)
    q, t = q[st], t[st]
    o = np.lexsort((t, -s, q))
    q, t, s = q[o], t[o], s[o]
    gstart = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    gsize = np.diff(np.r_[gstart, len(q)])
    keep = np.arange(len(q)) - np.repeat(gstart, gsize) < k
    return q[keep], t[keep], s[keep]


def _l2_scores(Q, qn2, C, cn2, products):
    """1 - distance by expansion, recomputed as the sum of squared differences wherever the expansion's
    rounding could show (squared distance small against the norms)."""
    d2 = np.maximum(qn2[:, None] + cn2[None, :] - 2.0 * products, 0.0)
    loose = 8 * np.finfo(float).eps * (qn2[:, None] + cn2[None, :]) > 2e-9 * np.sqrt(d2)
    qi, ci = np.nonzero(loose)
    for at in range(0, len(qi), 65_536):
        a, b = qi[at:at + 65_536], ci[at:at + 65_536]
        d2[a, b] = ((Q[a] - C[b]) ** 2).sum(axis=1)
    return 1.0 - np.sqrt(d2)


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _packer(dim: int, metric: str, rows: int, salts: int, named: bool):
    """Rows (cell, id, name, vec) as blocks of one cell, at most ``rows`` rows each, in order of id. For cosine the
    vectors are scaled to length 1 and zero vectors left out."""

    def run(batches):
        context = TaskContext.get()
        task = context.partitionId() if context else 0
        held: dict[str, list] = {}
        size, made = 0, 0

        def blocks():
            nonlocal made
            for cell in list(held):
                parts = held.pop(cell)
                ids, vecs = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                names = [n for p in parts for n in p[2]] if named else None
                parts.clear()
                order = np.argsort(ids, kind="stable")
                for at in range(0, len(ids), rows):
                    some = order[at:at + rows]
                    columns = [[cell], [(task + made) % salts], [(task << 32) + made], [ids[some].tobytes()],
                               [[names[i] for i in some] if named else None], [vecs[some].tobytes()]]
                    made += 1
                    kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                     names=["cell", "salt", "block", "ids", "names", "vecs"])

        for rb in batches:
            if not rb.num_rows:
                continue
            ids = rb.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            vecs = _matrix(rb.column("vec"), dim)
            names = rb.column("name").to_pylist() if named else None
            coded = rb.column("cell").dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            if metric == "cosine":
                norms = np.linalg.norm(vecs, axis=1)
                live = norms > 0
                vecs = vecs / np.where(live, norms, 1.0)[:, None]
                codes = np.where(live, codes, -1)
            for code, cell in enumerate(coded.dictionary.to_pylist()):
                at = np.flatnonzero(codes == code)
                if at.size:
                    held.setdefault(cell, []).append((ids[at], vecs[at], [names[i] for i in at] if named else []))
                    size += vecs[at].nbytes
            if size >= HELD_BYTES:
                yield from blocks()
                size = 0
        yield from blocks()

    return run


def _scorer(k, metric, exclude_self, threshold, inclusive, decimals, dim, named):
    """Joined blocks to (target, [query_row], ticket_id, score): per query row of a block the k best tickets.

    Each query row of a block carries a floor, the k-th best score that it has found so far: no product below it can be
    among its k best, so but for the first blocks one comparison a product is all that follows the matrix product."""
    slack = 10.0 ** -decimals  # more than rounding can lift a score

    def results(held):
        for targets, names, _, q, t, s in held.values():
            q, t, s = _compact(np.concatenate(q), np.concatenate(t), np.concatenate(s), k)
            columns, heads = [pa.array(targets[q]), pa.array(t), pa.array(s)], ["target", "ticket_id", "score"]
            if named:
                columns.insert(1, names.take(pa.array(q)))
                heads.insert(1, "query_row")
            yield pa.RecordBatch.from_arrays(columns, names=heads)

    def scored(Q, C):
        S = Q @ C.T
        if metric == "l2":
            return _l2_scores(Q, (Q * Q).sum(axis=1), C, (C * C).sum(axis=1), S)
        if metric == "inner":
            S += 1.0
        return S

    def passing(raw, qi, ci, targets, cid):
        """Which products are hits at all."""
        live = np.isfinite(raw)
        if exclude_self:
            live &= cid[ci] != targets[qi]
        if threshold is not None:
            live &= (raw >= threshold) if inclusive else (raw > threshold)
        return live

    def best(S, floor, targets, cid):
        """(query row, ticket, rounded score) of the products that may be among the k best; raises the floors."""
        least = floor - slack * (1 + np.abs(np.where(np.isfinite(floor), floor, 0.0)))
        if threshold is not None:
            least = np.maximum(least, threshold)
        keep = S >= least[:, None]  # not a number: never
        if np.count_nonzero(keep) <= 8 * k * len(S):
            qi, ci = np.nonzero(keep)
        else:
            # rows of a block are in order of id: one column a ticket
            S = np.where(keep, S, -np.inf)
            if exclude_self:
                S[cid[None, :] == targets[:, None]] = -np.inf
            starts = np.flatnonzero(np.r_[True, cid[1:] != cid[:-1]])
            if len(starts) > k:
                if not np.isfinite(S).all():
                    S[~(S < np.inf)] = -np.inf
                if threshold is not None and not inclusive:
                    S[S == threshold] = -np.inf
                tops = np.maximum.reduceat(S, starts, axis=1)
                low = np.round(np.partition(tops, len(starts) - k, axis=1)[:, len(starts) - k], decimals)
                np.maximum(floor, low, out=floor)
                least = floor - slack * (1 + np.abs(np.where(np.isfinite(floor), floor, 0.0)))
            qi, ci = np.nonzero((S >= least[:, None]) & (S > -np.inf))
        raw = S[qi, ci]
        live = passing(raw, qi, ci, targets, cid)
        return qi[live], cid[ci[live]], np.round(raw[live], decimals)

    def run(batches):
        held: dict[int, tuple] = {}
        size = 0
        for rb in batches:
            if not rb.num_rows:
                continue
            for i in range(rb.num_rows):
                value = lambda name: rb.column(name)[i]  # noqa: B023, E731
                matrix = lambda name: np.frombuffer(value(name).as_buffer()).reshape(-1, dim)  # noqa: B023, E731
                Q, C = matrix("q_vecs"), matrix("vecs")
                targets = np.frombuffer(value("q_ids").as_buffer(), np.int64)
                cid = np.frombuffer(value("ids").as_buffer(), np.int64)
                block = value("q_block").as_py()
                if block not in held:
                    names = pa.array(value("q_names").as_py(), pa.string()) if named else None
                    held[block] = (targets.copy(), names, np.full(len(targets), -np.inf), [], [], [])
                _, _, floor, q, t, s = held[block]
                step = max(1, TILE // len(cid))
                for at in range(0, len(Q), step):
                    qi, ti, si = best(scored(Q[at:at + step], C), floor[at:at + step], targets[at:at + step], cid)
                    if qi.size:
                        q.append(qi + at), t.append(ti), s.append(si)
                        size += qi.size
                if sum(map(len, q)) > 3 * len(targets) * k + 10_000:
                    new = _compact(np.concatenate(q), np.concatenate(t), np.concatenate(s), k)
                    size -= sum(map(len, q)) - len(new[0])
                    q[:], t[:], s[:] = [new[0]], [new[1]], [new[2]]
                    found = np.bincount(new[0], minlength=len(targets))
                    full = found == k
                    floor[full] = np.maximum(floor[full], new[2][np.cumsum(found)[full] - 1])
                if size > HELD_RESULTS:
                    yield from results({b: h for b, h in held.items() if h[3]})
                    held, size = {}, 0
            del rb, value, matrix, Q, C, targets, cid  # let go of the batch before the next one comes
        yield from results({b: h for b, h in held.items() if h[3]})

    return run


def _value_pairs(asked: DataFrame, known: DataFrame, anywhere: bool, match: str) -> DataFrame:
    """(q, c): which distinct query values ``q`` match which distinct corpus values ``c`` (prefix, or ``anywhere``).

    Literal values are matched by an equi-join on the prefixes (substrings) of the corpus value, no longer than the
    longest query value; patterns by a join of the two sets of distinct values."""
    q = asked.select(F.col(asked.columns[0]).alias("q")).where("q is not null").distinct()
    c = known.select(F.col(known.columns[0]).alias("c")).where("c is not null").distinct()
    if match == "regex":
        pattern = F.col("q") if anywhere else F.concat(F.lit("^(?:"), F.col("q"), F.lit(")"))
        return c.join(q, F.regexp_like("c", pattern)).select("q", "c")
    sized = c.select("c", F.coalesce(q.agg(F.max(F.length("q"))).scalar(), F.lit(0)).alias("most"))
    starts = F.sequence(F.lit(1), F.greatest(F.length("c"), F.lit(1))) if anywhere else F.array(F.lit(1))
    parts = sized.select("c", "most", F.explode(starts).alias("at"))
    parts = parts.select("c", "at", F.explode(F.sequence(F.lit(0), F.least(F.length("c"), F.col("most")))).alias("n"))
    return parts.select("c", F.substr("c", "at", "n").alias("q")).distinct().join(q, "q").select("q", "c")


def _cell_key(product: Column, module: Column) -> Column:
    """One text for a pair of values (NULL told apart from any text)."""
    size = lambda x: F.coalesce(F.length(x).cast("string"), F.lit("-"))
    return F.concat_ws(":", size(product), product, size(module), module)


def _routes(q: DataFrame, c: DataFrame, filters: FilterSpec) -> DataFrame:
    """Query rows with the ``cell`` of every (product, module) of the corpus that they may see."""
    values = c.select(F.col("product").alias("cp"), F.col("module").alias("cm")).distinct()
    asked = q.select(F.col("product").alias("qp"), F.col("module").alias("qm")).distinct()
    pairs = []
    if filters.needs_product:
        found = _value_pairs(asked.select("qp"), values.select("cp"), False, filters.match)
        pairs.append(found.select(F.col("q").alias("qp"), F.col("c").alias("cp")))
    if filters.needs_module:
        found = _value_pairs(asked.select("qm"), values.select("cm"), filters.interactive, filters.match)
        pairs.append(found.select(F.col("q").alias("qm"), F.col("c").alias("cm")))
    if filters.interactive:
        either = [asked.join(p, p.columns[0]).join(values, p.columns[1]).select("qp", "qm", "cp", "cm") for p in pairs]
        seen = either[0].union(either[1]).distinct()
    else:
        seen = asked
        for p in pairs:
            seen = seen.join(p, p.columns[0])
        seen = seen.join(values, [p.columns[1] for p in pairs])
    seen = seen.select("qp", "qm", _cell_key(F.col("cp"), F.col("cm")).alias("cell"))
    same = q["product"].eqNullSafe(seen["qp"]) & q["module"].eqNullSafe(seen["qm"])
    return q.join(seen, same).drop("qp", "qm")


def _blocks(rows: DataFrame, dim: int, metric: str, salts: int, named: bool, most: int) -> DataFrame:
    size = max(1, min(most, PACKED_BYTES // (dim * 8)))
    return rows.select("cell", "id", "name", "vec").mapInArrow(_packer(dim, metric, size, salts, named), _BLOCK_SCHEMA)


def block_pairs(
    q: DataFrame, c: DataFrame, dim: int, metric: str = "cosine", named: bool = False, block_bytes: int = DEFAULT_BLOCK_BYTES,
) -> DataFrame:
    """The joined blocks of routed queries ``q`` and corpus rows ``c`` (both cell, id, name, vec): one row for every pair of
    blocks of one cell. Query blocks are broadcast up to ``block_bytes`` (counted) and a small part of the driver's heap, else
    dealt by (cell, salt)."""
    spark = q.sparkSession
    sent_bytes(spark, SENT_BYTES)
    facts = q.groupBy("cell").count().agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("cells")).first()
    n, cells = int(facts["n"] or 0), max(int(facts["cells"]), 1)
    n_bytes, parallel = n * dim * 8, int(spark.conf.get("spark.sql.shuffle.partitions"))
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    small = n_bytes <= min(block_bytes, heap // HEAP_PART)
    salts = 1 if small else max(1, math.ceil(parallel / cells))
    # query rows of a cell together, so that blocks are full
    packs = max(1, min(cells, parallel, math.ceil(n_bytes / PACKED_BYTES)))
    asked = _blocks(q.repartition(packs, "cell"), dim, metric, 1, named, QUERY_ROWS)
    asked = asked.select(*[F.col(x).alias(f"q_{x}") for x in asked.columns])
    if small:
        asked = F.broadcast(asked)
    else:
        asked = asked.withColumn("q_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    known = _blocks(c, dim, metric, salts, False, PACKED_BYTES)
    return known.join(asked, (F.col("cell") == F.col("q_cell")) & (F.col("salt") == F.col("q_salt")))


def scored_products(pairs: DataFrame) -> DataFrame:
    """How many (query row, corpus row) products the joined blocks hold (one row, ``products``)."""
    count = lambda x: F.octet_length(x).cast("long") / 8
    return pairs.agg(F.coalesce(F.sum((count("q_ids") * count("ids")).cast("long")), F.lit(0)).alias("products"))


def _sides(
    queries: DataFrame, corpus: DataFrame, query_id: str, query_vec: str, corpus_id: str, corpus_vec: str, filters: FilterSpec,
    query_row: str | None, ivf: "IvfIndex | None", nprobe: int | None, metric: str, dim: int,
) -> tuple[DataFrame, DataFrame]:
    """Routed query rows and corpus rows, as (cell, id, name, vec)."""
    none = F.lit(None).cast("string")
    double = lambda x: F.col(x).cast("array<double>")
    value = lambda name, used: F.col(name).cast("string").alias(name) if used else none.alias(name)
    values = [value("product", filters.needs_product), value("module", filters.needs_module)]
    q = queries.select(F.col(query_id).cast("long").alias("id"), value(query_row, True).alias("name") if query_row else
                       none.alias("name"), double(query_vec).alias("vec"), *values)
    q = q.where("id is not null and vec is not null")
    own = [F.col(ivf.list_col).cast("long").alias("list")] if ivf is not None else []
    c = corpus.select(F.col(corpus_id).cast("long").alias("id"), none.alias("name"), double(corpus_vec).alias("vec"), *values, *own)
    c = c.where("id is not null and vec is not null")
    filtered = filters.needs_product or filters.needs_module
    plain = c
    c = c.withColumn("cell", _cell_key(F.col("product"), F.col("module")) if filtered else F.lit(""))
    q = _routes(q, plain, filters) if filtered else q.withColumn("cell", F.lit(""))
    if ivf is not None:
        q = ivf.probed(q, nprobe, metric, dim)
        lists = [r[0] for r in q.select("list").distinct().collect()]  # at most one row a list
        c = c.where(F.col("list").isin(lists))
        in_list = F.concat_ws("/", F.col("list").cast("string"), "cell")
        q, c = q.withColumn("cell", in_list), c.withColumn("cell", in_list)
    return q, c


def vector_search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 20,
    metric: str = "cosine",
    *,
    query_id: str = "ticket_id",
    query_vec: str = "sentence_embedding",
    corpus_id: str = "ticket_id",
    corpus_vec: str = "sentence_embedding",
    filters: FilterSpec = FilterSpec(),
    exclude_self: bool = True,
    threshold: float | None = None,
    inclusive: bool = False,
    decimals: int = 6,
    block_bytes: int = DEFAULT_BLOCK_BYTES,
    ivf: "IvfIndex | None" = None,
    nprobe: int | None = None,
    recall: float = 0.95,
    hit_text: str | None = None,
    hit_columns: Sequence[str] = (),
    query_row: str | None = None,
) -> DataFrame:
    """Top-k candidate tickets per target, or per query row with ``query_row``, by best-of-rows score.

    Returns (target, ticket_id, score, rank): for every query ``target``, the k
    tickets with the highest score over all their corpus rows, score rounded to
    ``decimals`` before ranking, ties broken by ticket_id ascending.

    Without ``query_row`` several query rows of one target share one list: the best score over
    all of them. With it (a column that tells the rows of a target apart, such as the text
    source) each query row has its own k tickets and ranks, and the result carries the key as
    ``query_row`` after ``target``; a key that is NULL or repeats within a target raises.

    metric: "cosine" (1 - cosine distance), "l2" (1 - euclidean distance),
    "inner" (1 + dot product). ``threshold`` is on the unrounded score
    (strict ``>`` unless ``inclusive``). Query rows need ``product`` / ``module``
    columns when the filters use them; so does the corpus. Rows without id or vector take no part; vectors of
    different lengths raise; a score that is not a number is no hit.

    With ``hit_text`` (a corpus text column) the result also has ``hit_text``: the text of
    the ticket's best-scoring row (ties: the smallest text), and ``hit_columns`` the same row's values in further corpus
    columns (ties: the smallest in their order), each named ``hit_<column>``.

    With ``ivf`` (see :func:`build_ivf`) each query scores only the rows of its ``nprobe``
    nearest lists; without ``nprobe`` it is measured by :func:`enough_lists` so that the probed
    lists hold the share ``recall`` of the exact result. Only lists that some query probes are
    read (partition pruning when the corpus is stored by list, see :func:`store_ivf`).

    ``block_bytes``: query vectors (each once a cell) that may be broadcast, if the driver's heap is large enough
    (``HEAP_PART``); beyond it both sides are shuffled.
    """
    if metric not in ("cosine", "l2", "inner"):
        raise ValueError(f"unknown metric {metric!r}")
    spark = queries.sparkSession
    keys = ["target", "query_row"] if query_row else ["target"]
    qcols = [F.col(query_id).cast("long").alias("target"), F.col(query_vec).alias("vec")]
    qcols += [(F.col(x) if used else F.lit(None).cast("string")).alias(x)
              for x, used in (("product", filters.needs_product), ("module", filters.needs_module))]
    if query_row:
        qcols.append(F.col(query_row).cast("string").alias("query_row"))
    q = queries.select(*qcols).where(F.col("vec").isNotNull() & F.col("target").isNotNull())
    q = stage(q, "queries")  # read by the checks, the routes, the blocks and the hit's columns: derived once
    if query_row and q.groupBy(*keys).count().where((F.col("count") > 1) | F.col("query_row").isNull()).limit(1).count():
        raise ValueError(f"{query_row} is NULL or repeats within a target")
    sizes = q.agg(F.min(F.size("vec")), F.max(F.size("vec"))).first()
    found = corpus.where(F.col(corpus_vec).isNotNull()).agg(F.min(F.size(corpus_vec)), F.max(F.size(corpus_vec))).first()
    lengths = {x for x in (*sizes, *found) if x is not None}
    if sizes[0] is not None and len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(lengths)}")
    dim = int(sizes[0] or 0)
    if dim <= 0:
        return spark.createDataFrame([], _with_row(_RANKED_SCHEMA, bool(query_row)))
    if ivf is not None and nprobe is None:
        nprobe = enough_lists(ivf, queries, corpus, k, metric, recall, query_id=query_id, query_vec=query_vec,
                              corpus_id=corpus_id, corpus_vec=corpus_vec, filters=filters, exclude_self=exclude_self,
                              threshold=threshold, inclusive=inclusive, decimals=decimals)
    asked, known = _sides(q, corpus, "target", "vec", corpus_id, corpus_vec, filters, "query_row" if query_row else None, ivf,
                          nprobe, metric, dim)
    pairs = block_pairs(asked, known, dim, metric, bool(query_row), block_bytes)
    score = _scorer(k, metric, exclude_self, threshold, inclusive, decimals, dim, bool(query_row))
    cand = pairs.mapInArrow(score, _with_row(RESULT_SCHEMA, bool(query_row)))
    ranked = top_k_per_target(cand.groupBy(*keys, "ticket_id").agg(F.max("score").alias("score")), k, keys=keys)
    if not hit_text:
        return ranked
    further = [F.col(x).alias(f"hit_{x}") for x in hit_columns]
    rows = corpus.select(
        F.col(corpus_id).cast("long").alias("ticket_id"), F.col(corpus_vec).alias("_c"), F.col(hit_text).cast("string").alias("_h"),
        (F.col("product") if filters.needs_product else F.lit(None).cast("string")).alias("_cp"),
        (F.col("module") if filters.needs_module else F.lit(None).cast("string")).alias("_cm"), *further,
    )
    return _with_hit_row(ranked, q, rows, metric, filters, decimals, keys, [f"hit_{x}" for x in hit_columns])


def _rescored(
    ranked: DataFrame, q: DataFrame, rows: DataFrame, metric: str, filters: FilterSpec, decimals: int, keys: list[str] | None = None,
) -> DataFrame:
    """The visible rows of the ranked tickets with their own rounded score ``_s``."""
    keys = keys or ["target"]
    j = ranked.join(q.select(*keys, F.col("vec").alias("_q"), "product", "module"), keys).join(rows, "ticket_id")
    if filters.match == "regex":
        prefix = lambda c, p: F.regexp_like(c, F.concat(F.lit("^(?:"), p, F.lit(")")))
        inside = F.regexp_like
    else:
        prefix, inside = F.startswith, F.contains
    sees_product, sees_module = prefix(F.col("_cp"), F.col("product")), prefix(F.col("_cm"), F.col("module"))
    seen = F.lit(True)
    if filters.interactive:
        seen = F.coalesce(sees_product, F.lit(False)) | F.coalesce(inside(F.col("_cm"), F.col("module")), F.lit(False))
    else:
        if filters.use_product:
            seen = seen & sees_product
        if filters.use_module:
            seen = seen & sees_module
    pairs = F.zip_with("_q", "_c", lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
    total = lambda f: F.aggregate(pairs, F.lit(0.0), lambda s, p: s + f(p["x"], p["y"]))
    if metric == "l2":
        score = 1 - F.sqrt(total(lambda x, y: (x - y) * (x - y)))
    elif metric == "inner":
        score = 1 + total(lambda x, y: x * y)
    else:
        norms = F.sqrt(total(lambda x, y: x * x)) * F.sqrt(total(lambda x, y: y * y))
        score = F.try_divide(total(lambda x, y: x * y), norms)
    return j.where(seen).withColumn("_s", F.round(score, decimals))


def _with_hit_row(
    ranked: DataFrame, q: DataFrame, rows: DataFrame, metric: str, filters: FilterSpec, decimals: int, keys: list[str],
    further: list[str],
) -> DataFrame:
    """The text (and further columns) of the best-scoring visible row of each ranked ticket (ties: the smallest text), joined on
    after the cut: only the rows of the k tickets of each target are scored again, so no text goes through Python."""
    j = _rescored(ranked, q, rows, metric, filters, decimals, keys)
    worst = F.coalesce("_s", F.lit(float("-inf")))
    best = F.min(F.struct((-worst).alias("s"), F.col("_h").isNull().alias("n"), F.col("_h").alias("h"), *further))
    return (
        j.groupBy(*keys, "ticket_id", "score", "rank").agg(best.alias("_b"))
        .select(*keys, "ticket_id", "score", F.col("_b.h").alias("hit_text"), *[F.col(f"_b.{x}") for x in further], "rank")
    )


def top_k_per_target(scored: DataFrame, k: int, order_extra: list | None = None, keys: list[str] | None = None) -> DataFrame:
    """Rank rows per target (or per ``keys``) by score desc, ticket_id asc; keep rank <= k (WindowGroupLimit)."""
    order = [F.col("score").desc(), F.col("ticket_id").asc()] + (order_extra or [])
    w = Window.partitionBy(*(keys or ["target"])).orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def search_best_per_ticket(hits: DataFrame, k: int) -> DataFrame:
    """E2 + F1 + F2 for precomputed scores: best row per (target, ticket), top k per target."""
    best = hits.groupBy("target", "ticket_id").agg(F.max("score").alias("score"))
    return top_k_per_target(best, k)


@dataclass
class IvfIndex:
    """Inverted-file index: list centroids plus the corpus with a list column."""

    centroids: np.ndarray
    corpus: DataFrame
    list_col: str = "ivf_list"
    path: str | None = None

    def probe(self, Q: np.ndarray, nprobe: int, metric: str = "cosine") -> np.ndarray:
        """(queries x nprobe) ids of the nearest lists of every query."""
        return _nearest_lists(self.centroids, Q, nprobe, metric)

    def probed(self, q: DataFrame, nprobe: int, metric: str, dim: int) -> DataFrame:
        """Query rows once per probed list (column ``list``); ``vec`` holds the vector."""
        return _explode_lists(q, "vec", self.centroids, nprobe, metric, dim, "list")


def _nearest_lists(C: np.ndarray, Q: np.ndarray, nprobe: int, metric: str) -> np.ndarray:
    if metric == "cosine":
        Cn = C / np.maximum(np.linalg.norm(C, axis=1, keepdims=True), 1e-300)
        d = -(Q @ Cn.T)
    else:
        d = (Q * Q).sum(1)[:, None] + (C * C).sum(1)[None, :] - 2 * Q @ C.T
    nprobe = max(1, min(nprobe, C.shape[0]))
    if nprobe < C.shape[0]:
        part = np.argpartition(d, nprobe - 1, axis=1)[:, :nprobe]
    else:
        part = np.argsort(d, axis=1, kind="stable")
    return part.astype(np.int64)


def _explode_lists(rows: DataFrame, vec: str, centroids: np.ndarray, nprobe: int, metric: str, dim: int, out: str) -> DataFrame:
    """``rows`` once for each of the ``nprobe`` nearest lists, its number in ``out``."""
    schema = T.StructType([f for f in rows.schema.fields if f.name != out] + [T.StructField("_lists", T.ArrayType(T.LongType()))])
    kept = schema.names[:-1]

    def run(batches):
        for rb in batches:
            if rb.num_rows:
                near = _nearest_lists(centroids, _matrix(rb.column(vec), dim), nprobe, metric)
                lists = pa.array(near.tolist(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*(rb.column(c) for c in kept), lists], names=[*kept, "_lists"])

    found = rows.select(*kept).mapInArrow(run, schema)
    return found.withColumn(out, F.explode("_lists")).drop("_lists")


def store_ivf(index: IvfIndex, path: str) -> IvfIndex:
    """Write the index: its rows by list (one folder a list, a large list dealt over a few tasks) and its centroids."""
    spark = index.corpus.sparkSession
    dealt = index.corpus.repartition(F.col(index.list_col), F.pmod(F.xxhash64(*index.corpus.columns), F.lit(LIST_FILES)))
    dealt.write.partitionBy(index.list_col).parquet(f"{path}/rows")
    rows = [(i, [float(x) for x in v], index.list_col) for i, v in enumerate(index.centroids)]
    spark.createDataFrame(rows, "list long, centroid array<double>, list_col string").coalesce(1).write.parquet(f"{path}/centroids")
    return open_ivf(spark, path)


def open_ivf(spark: SparkSession, path: str) -> IvfIndex:
    """The index stored at ``path``."""
    rows = spark.read.parquet(f"{path}/centroids").orderBy("list").collect()  # one row a list
    centroids = np.asarray([r["centroid"] for r in rows], dtype=np.float64)
    return IvfIndex(centroids, spark.read.parquet(f"{path}/rows"), rows[0]["list_col"], path)


def add_to_ivf(index: IvfIndex, rows: DataFrame, vec: str = "sentence_embedding", metric: str = "cosine") -> IvfIndex:
    """Append ``rows`` to a stored index: each goes to its nearest list, nothing else is rewritten. Rows without a
    vector go to the first list (as they do when the index is built) and are never scored."""
    if index.path is None:
        raise ValueError("only a stored index can be extended")
    names = [c for c in index.corpus.columns if c != index.list_col]
    fresh, dim = rows.select(*names), index.centroids.shape[1]
    if fresh.where(F.size(vec) != dim).limit(1).count():
        raise ValueError(f"vectors must have length {dim}")
    there = _explode_lists(fresh.where(F.col(vec).isNotNull()), vec, index.centroids, 1, metric, dim, index.list_col)
    none = fresh.where(F.col(vec).isNull()).withColumn(index.list_col, F.lit(0).cast("long"))
    there.unionByName(none).write.mode("append").partitionBy(index.list_col).parquet(f"{index.path}/rows")
    return open_ivf(rows.sparkSession, index.path)


def enough_lists(
    ivf: IvfIndex, queries: DataFrame, corpus: DataFrame, k: int = 20, metric: str = "cosine", recall: float = 0.95, *,
    query_id: str = "ticket_id", query_vec: str = "sentence_embedding", corpus_id: str = "ticket_id",
    corpus_vec: str = "sentence_embedding", filters: FilterSpec = FilterSpec(), decimals: int = 6,
    measured: int = MEASURED_QUERIES, **search,
) -> int:
    """The least number of probed lists that hold the share ``recall`` of the exact result.

    The exact top k of up to ``measured`` query rows (chosen by a hash of their id) is found over the whole corpus. A
    ticket is sure to be found again once the list of its best row is probed, so each pair needs as many probes as that
    list's place in the query's order of lists; the result is the quantile of these places. Other searches of the same
    kind reach the share up to the error of the sample.
    """
    spark = queries.sparkSession
    some = queries.where(F.col(query_id).isNotNull() & F.col(query_vec).isNotNull())
    some = some.orderBy(F.xxhash64(F.col(query_id).cast("long")), F.xxhash64(query_vec)).limit(measured)
    kept = [query_id, query_vec] + ["product"] * filters.needs_product + ["module"] * filters.needs_module
    picked = some.select(*kept).collect()  # at most `measured` rows
    n_lists = ivf.centroids.shape[0]
    if not picked:
        return n_lists
    picked = list({int(r[query_id]): r for r in picked}.values())  # one row a ticket
    Q = np.asarray([r[query_vec] for r in picked], dtype=np.float64)
    places = np.argsort(ivf.probe(Q, n_lists, metric), axis=1) + 1
    value = lambda r, name: r[name] if name in kept else None
    q = spark.createDataFrame(
        [(int(r[query_id]), v.tolist(), value(r, "product"), value(r, "module"), p.tolist()) for r, v, p in zip(picked, Q, places)],
        "target long, vec array<double>, product string, module string, _places array<long>")
    exact = vector_search(q, corpus, k, metric, query_id="target", query_vec="vec", corpus_id=corpus_id,
                          corpus_vec=corpus_vec, filters=filters, decimals=decimals, **search)
    rows = corpus.select(
        F.col(corpus_id).cast("long").alias("ticket_id"), F.col(corpus_vec).alias("_c"), F.col(ivf.list_col).alias("_l"),
        (F.col("product") if filters.needs_product else F.lit(None).cast("string")).alias("_cp"),
        (F.col("module") if filters.needs_module else F.lit(None).cast("string")).alias("_cm"),
    )
    j = _rescored(exact, q, rows, metric, filters, decimals).join(q.select("target", "_places"), "target")
    place = F.element_at("_places", F.col("_l").cast("int") + 1)
    best = F.min(F.struct((-F.col("_s")).alias("s"), place.alias("n")))
    pairs = j.where(F.col("_s").isNotNull()).groupBy("target", "ticket_id").agg(best.alias("_b")).select("_b.n")
    found = [r["n"] for r in pairs.collect()]  # at most k rows a query
    return int(np.quantile(found, recall, method="higher")) if found else n_lists


def build_ivf(corpus: DataFrame, vec: str = "sentence_embedding", *, n_lists: int, metric: str = "cosine",
              seed: int = 1, max_iter: int = 20, list_col: str = "ivf_list") -> IvfIndex:
    """KMeans (distributed, ``pyspark.ml``) over the corpus vectors; every row gets its
    nearest list. For cosine the vectors are L2-normalised before clustering."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    v = F.transform(F.col(vec), lambda x: x.cast("double"))
    if metric == "cosine":
        nrm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
        # bound once a row: a lambda that names the norm would sum it up anew for every component
        v = let(nrm, lambda n: F.transform(v, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0))))
    feats = corpus.withColumn("__features", array_to_vector(v))
    km = KMeans(k=n_lists, seed=seed, maxIter=max_iter, featuresCol="__features", predictionCol=list_col)
    model = km.fit(feats)
    centroids = np.asarray(model.clusterCenters(), dtype=np.float64)
    assigned = model.transform(feats).drop("__features")
    return IvfIndex(centroids, assigned, list_col)
