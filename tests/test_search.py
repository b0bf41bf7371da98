import numpy as np
import pytest
from pyspark.sql import functions as F

from simtrail.operators import search as se
from simtrail.operators.search import FilterSpec, build_ivf, enough_lists, vector_search


def _frames(spark, rng, n_corpus=300, n_q=12, dim=8, rows_per_ticket=3):
    vecs = rng.normal(size=(n_corpus, dim)).astype(np.float32)
    vecs[5] = 0.0  # zero vector: never scored
    vecs[7] = vecs[8]  # equal scores for two tickets
    corpus = [(i // rows_per_ticket, f"p{(i // rows_per_ticket) % 3}", f"m{(i // rows_per_ticket) % 4}",
               [float(x) for x in vecs[i]]) for i in range(n_corpus)]
    cdf = spark.createDataFrame(corpus, "ticket_id long, product string, module string, sentence_embedding array<float>")
    qrows = [(int(t), f"p{t % 3}", f"m{t % 4}", corpus[t * rows_per_ticket][3]) for t in range(0, n_q * 3, 3)]
    qdf = spark.createDataFrame(qrows, "ticket_id long, product string, module string, sentence_embedding array<float>")
    return corpus, qrows, cdf, qdf


def _brute(corpus, qrows, k, metric="cosine", filt=None, thr=None):
    out = {}
    for t, qp, qm, qv in qrows:
        q = np.asarray(qv, dtype=np.float64)
        best = {}
        for tid, cp, cm, cv in corpus:
            if tid == t:
                continue
            if filt and not filt(qp, qm, cp, cm):
                continue
            c = np.asarray(cv, dtype=np.float64)
            if metric == "cosine":
                if np.linalg.norm(c) == 0:
                    continue
                raw = q @ c / (np.linalg.norm(q) * np.linalg.norm(c))
            elif metric == "inner":
                raw = 1 + q @ c
            else:
                raw = 1 - np.linalg.norm(q - c)
            if thr is not None and not raw > thr:
                continue
            s = round(float(raw), 6)
            best[tid] = max(best.get(tid, -np.inf), s)
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out[t] = [(tid, s) for tid, s in ranked]
    return out


def _got(df):
    out = {}
    for r in df.orderBy("target", "rank").collect():
        out.setdefault(r["target"], []).append((r["ticket_id"], round(r["score"], 6)))
    return out


@pytest.mark.parametrize("metric", ["cosine", "l2", "inner"])
def test_exact_matches_brute_force(spark, metric):
    rng = np.random.default_rng(1)
    corpus, qrows, cdf, qdf = _frames(spark, rng)
    got = _got(vector_search(qdf, cdf.repartition(4), k=7, metric=metric))
    exp = _brute(corpus, qrows, 7, metric)
    assert got == {t: v for t, v in exp.items() if v}


def test_query_blocks_and_filters(spark):
    rng = np.random.default_rng(2)
    corpus, qrows, cdf, qdf = _frames(spark, rng)
    # tiny block size forces several broadcast blocks
    got = _got(vector_search(qdf, cdf, k=5, filters=FilterSpec(use_product=True), block_bytes=200, threshold=0.0))
    exp = _brute(corpus, qrows, 5, filt=lambda qp, qm, cp, cm: cp.startswith(qp), thr=0.0)
    assert got == {t: v for t, v in exp.items() if v}
    got = _got(vector_search(qdf, cdf, k=5, filters=FilterSpec(interactive=True)))
    exp = _brute(corpus, qrows, 5, filt=lambda qp, qm, cp, cm: cp.startswith(qp) or qm in cm)
    assert got == {t: v for t, v in exp.items() if v}


def test_empty_corpus_and_no_results(spark):
    rng = np.random.default_rng(3)
    corpus, qrows, cdf, qdf = _frames(spark, rng)
    empty = cdf.limit(0)
    assert vector_search(qdf, empty, k=3).count() == 0
    assert vector_search(qdf, cdf, k=3, threshold=1.5).count() == 0


def test_ivf_all_lists_is_exact_and_recall(spark):
    rng = np.random.default_rng(4)
    corpus, qrows, cdf, qdf = _frames(spark, rng, n_corpus=600)
    idx = build_ivf(cdf, n_lists=6, seed=2)
    exact = _got(vector_search(qdf, cdf, k=10))
    full = _got(vector_search(qdf, idx.corpus, k=10, ivf=idx, nprobe=6))
    assert full == exact
    part = _got(vector_search(qdf, idx.corpus, k=10, ivf=idx, nprobe=3))
    hits = sum(len({t for t, _ in part.get(q, [])} & {t for t, _ in exact[q]}) for q in exact)
    total = sum(len(v) for v in exact.values())
    assert hits / total >= 0.5


def test_plan_prunes_columns(spark, tmp_path):
    rng = np.random.default_rng(5)
    _, _, cdf, qdf = _frames(spark, rng)
    p = str(tmp_path / "corpus")
    cdf.withColumn("extra", F.lit("x" * 100)).write.parquet(p)
    plan = vector_search(qdf, spark.read.parquet(p), k=3)._jdf.queryExecution().executedPlan().toString()
    assert "extra" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_hit_text_best_row_ties_to_smallest_text(spark):
    rows = [(1, "q", [1.0, 0.0]), (5, "b", [1.0, 0.2]), (5, "a", [1.0, 0.2]), (5, "c", [0.0, 1.0]),
            (6, None, [1.0, 0.5]), (7, "z", [0.5, 1.0])]
    c = spark.createDataFrame(rows, "ticket_id long, sentence string, sentence_embedding array<float>")
    q = c.where("ticket_id = 1")
    got = {r.ticket_id: r.hit_text for r in vector_search(q, c.repartition(3), k=5, hit_text="sentence").collect()}
    assert got == {5: "a", 6: None, 7: "z"}


def test_large_corpus_slices_and_batches(spark):
    rng = np.random.default_rng(9)
    n, dim = 20000, 8
    vecs = rng.normal(size=(n, dim)).astype(np.float32)
    tickets = rng.integers(0, 6000, size=n)
    import pandas as pd

    pdf = pd.DataFrame({"ticket_id": tickets.astype(np.int64), "sentence_embedding": list(vecs)})
    c = spark.createDataFrame(pdf, "ticket_id long, sentence_embedding array<float>").repartition(2)
    qv = rng.normal(size=(4, dim)).astype(np.float32)
    q = spark.createDataFrame([(100000 + i, [float(x) for x in qv[i]]) for i in range(4)],
                              "ticket_id long, sentence_embedding array<float>")
    got = _got(vector_search(q, c, k=15))
    V = vecs.astype(np.float64)
    V = V / np.linalg.norm(V, axis=1, keepdims=True)
    for i in range(4):
        qn = qv[i].astype(np.float64) / np.linalg.norm(qv[i].astype(np.float64))
        sc = np.round(V @ qn, 6)
        best = pd.Series(sc).groupby(tickets).max()
        exp = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:15]
        assert got[100000 + i] == [(int(t), float(s)) for t, s in exp]


def test_regex_filter_mode(spark):
    import re

    rng = np.random.default_rng(11)
    corpus, qrows, cdf, qdf = _frames(spark, rng)
    qdf = qdf.withColumn("product", F.lit("p[01]")).withColumn("module", F.lit("m(2|3)"))
    qrows = [(t, "p[01]", "m(2|3)", v) for t, _, _, v in qrows]
    got = _got(vector_search(qdf, cdf, k=6, filters=FilterSpec(use_product=True, use_module=True, match="regex")))
    exp = _brute(corpus, qrows, 6,
                 filt=lambda qp, qm, cp, cm: re.match(qp, cp) is not None and re.match(qm, cm) is not None)
    assert got == {t: v for t, v in exp.items() if v}


def test_mixed_vector_lengths_raise(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0, 1.0])], "ticket_id long, sentence_embedding array<double>")
    c = spark.createDataFrame([(7, [1.0, 0.5])], "ticket_id long, sentence_embedding array<double>")
    with pytest.raises(ValueError, match="lengths"):
        vector_search(q, c, k=3)
    with pytest.raises(ValueError, match="lengths"):
        vector_search(c, q, k=3)
    assert vector_search(q.where("ticket_id < 3"), c, k=3).count() == 2


def test_l2_keeps_its_digits_on_large_vectors(spark):
    base = [1e5 + 0.001 * i for i in range(16)]
    near = [x + (0.00025 if i == 3 else 0.0) for i, x in enumerate(base)]
    q = spark.createDataFrame([(1, base)], "ticket_id long, sentence_embedding array<double>")
    c = spark.createDataFrame([(2, near), (3, [x + 1 for x in base])], "ticket_id long, sentence_embedding array<double>")
    got = {r.ticket_id: r.score for r in vector_search(q, c, k=5, metric="l2").collect()}
    assert abs(got[2] - (1 - 0.00025)) < 2e-6 and abs(got[3] + 3) < 1e-6


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_registered_ivf_reaches_recall(spark, sf):
    from simtrail.plans.queries import REGISTRY

    path = f"/root/testdata/{sf}"
    exact = _got(REGISTRY["vector_topk_cosine"](spark, path))
    part = _got(REGISTRY["vector_topk_ivf"](spark, path))
    hits = sum(len({t for t, _ in part.get(q, [])} & {t for t, _ in exact[q]}) for q in exact)
    assert hits / sum(len(v) for v in exact.values()) >= 0.9


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_measured_probes_are_enough_and_not_all(spark, metric):
    rng = np.random.default_rng(6)
    near = rng.normal(size=(8, 8)).repeat(60, axis=0) * 10 + rng.normal(size=(480, 8))
    rows = [(i, f"p{i % 2}", [float(x) for x in v]) for i, v in enumerate(near)]
    c = spark.createDataFrame(rows, "ticket_id long, product string, sentence_embedding array<float>")
    q = c.where("ticket_id % 4 = 0")
    idx = build_ivf(c, n_lists=8, seed=2, metric=metric)
    by_product = FilterSpec(use_product=True)
    assert enough_lists(idx, q, idx.corpus, 10, metric, filters=by_product) < 8  # groups lie apart: few lists hold the nearest
    exact = _got(vector_search(q, c, k=10, metric=metric, filters=by_product))
    part = _got(vector_search(q, idx.corpus, k=10, metric=metric, filters=by_product, ivf=idx))
    hits = sum(len({t for t, _ in part[t0]} & {t for t, _ in exact[t0]}) for t0 in exact)
    assert hits / sum(len(v) for v in exact.values()) >= 0.9


FILTERS = [FilterSpec(), FilterSpec(use_product=True), FilterSpec(use_product=True, use_module=True), FilterSpec(interactive=True),
           FilterSpec(interactive=True, match="regex")]


@pytest.mark.parametrize("filters", FILTERS)
def test_shuffled_blocks_equal_broadcast_blocks(spark, filters):
    """Beyond the broadcast bound both sides go by (cell, salt); the result is the same."""
    rng = np.random.default_rng(21)
    _, _, cdf, qdf = _frames(spark, rng, n_q=30)
    small = vector_search(qdf, cdf.repartition(5), k=6, filters=filters)
    large = vector_search(qdf, cdf.repartition(5), k=6, filters=filters, block_bytes=0)
    assert _got(small) == _got(large) and _got(small)


def test_small_blocks_and_results_handed_on(spark, monkeypatch):
    """Many blocks a task, results handed on before the end (limits are read where the plan is made or shipped)."""
    rng = np.random.default_rng(22)
    corpus, qrows, cdf, qdf = _frames(spark, rng, n_q=30)
    monkeypatch.setattr(se, "PACKED_BYTES", 8 * 8 * 7)
    monkeypatch.setattr(se, "QUERY_ROWS", 3)
    got = _got(vector_search(qdf, cdf.repartition(3), k=4))
    assert got == {t: v for t, v in _brute(corpus, qrows, 4).items() if v}


def _pairs(spark, q, c, filters=FilterSpec(), ivf=None, nprobe=None, dim=8):
    asked, known = se._sides(q, c, "ticket_id", "sentence_embedding", "ticket_id", "sentence_embedding", filters, None, ivf, nprobe,
                             "cosine", dim)
    return se.scored_products(se.block_pairs(asked, known, dim)).first().products


def test_rows_outside_the_filter_are_never_scored(spark):
    rng = np.random.default_rng(23)
    corpus, qrows, cdf, qdf = _frames(spark, rng, n_q=20)
    live = [r for r in corpus if any(r[3])]
    for filters, sees in (
        (FilterSpec(), lambda q, c: True),
        (FilterSpec(use_product=True), lambda q, c: c[1].startswith(q[1])),
        (FilterSpec(use_product=True, use_module=True), lambda q, c: c[1].startswith(q[1]) and c[2].startswith(q[2])),
        (FilterSpec(interactive=True), lambda q, c: c[1].startswith(q[1]) or q[2] in c[2]),
    ):
        assert _pairs(spark, qdf, cdf, filters) == sum(sees(q, c) for q in qrows for c in live)


def test_value_matching_edges(spark):
    q = spark.createDataFrame([("",), ("ab",), (None,), ("b",), ("abcd",), ("é.",)], "q string")
    c = spark.createDataFrame([("",), ("abc",), (None,), ("xab",), ("é.b",)], "c string")
    rows = lambda anywhere, match="literal": {tuple(r) for r in se._value_pairs(q, c, anywhere, match).collect()}
    known, asked = ["", "abc", "xab", "é.b"], ["", "ab", "b", "abcd", "é."]
    assert rows(False) == {(a, b) for a in asked for b in known if b.startswith(a)}
    assert rows(True) == {(a, b) for a in asked for b in known if a in b}
    assert ("é.", "é.b") in rows(True, "regex") and ("b", "xab") not in rows(False, "regex")


def test_null_values_match_nothing(spark):
    rows = [(1, None, "m1", [1.0, 0.0]), (2, "p", None, [1.0, 0.1]), (3, None, None, [1.0, 0.2]), (4, "p", "xm1", [1.0, 0.3]), (5, "q", "m", [0.5, 1.0])]
    c = spark.createDataFrame(rows, "ticket_id long, product string, module string, sentence_embedding array<double>")
    q = spark.createDataFrame([(9, "p", "m1", [1.0, 0.0]), (8, None, "m1", [1.0, 0.0]), (7, None, None, [1.0, 0.0])], c.schema)
    seen = lambda f: {t: sorted(i for i, _ in v) for t, v in _got(vector_search(q, c, k=9, filters=f)).items()}
    assert seen(FilterSpec(use_product=True)) == {9: [2, 4]}
    assert seen(FilterSpec(use_module=True)) == {9: [1], 8: [1]}
    assert seen(FilterSpec(interactive=True)) == {9: [1, 2, 4], 8: [1, 4]}


def test_no_query_row_reaches_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    rng = np.random.default_rng(24)
    _, _, cdf, qdf = _frames(spark, rng, n_corpus=900, n_q=90)
    sizes, collect, arrow = [], DataFrame.collect, DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "collect", lambda self: sizes.append(len(got := collect(self))) or got)
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: sizes.append(10**6) or arrow(self))
    result = vector_search(qdf, cdf, k=3, filters=FilterSpec(use_product=True), block_bytes=0)
    assert max(sizes, default=0) <= 1
    assert collect(result)


def _clusters(spark, n=1200, dim=8, lists=8):
    rng = np.random.default_rng(31)
    near = rng.normal(size=(lists, dim)).repeat(n // lists, axis=0) * 8 + rng.normal(size=(n, dim))
    rows = [(i, f"p{i % 3}", [float(x) for x in v]) for i, v in enumerate(near)]
    return spark.createDataFrame(rows, "ticket_id long, product string, sentence_embedding array<double>")


def test_stored_index_reads_probed_lists_only(spark, tmp_path):
    c = _clusters(spark)
    q = c.where("ticket_id % 40 = 0 and ticket_id < 300")  # two of the clusters
    built = build_ivf(c, n_lists=8, seed=2)
    idx = se.store_ivf(built, str(tmp_path / "ivf"))
    assert np.array_equal(idx.centroids, built.centroids) and idx.corpus.count() == 1200
    _, known = se._sides(q, idx.corpus, "ticket_id", "sentence_embedding", "ticket_id", "sentence_embedding", FilterSpec(), None,
                         idx, 1, "cosine", 8)
    plan = known._jdf.queryExecution().executedPlan().toString()
    read = {f.rsplit("/", 2)[1] for f in known.inputFiles()}
    assert "PartitionFilters: [" in plan and "ivf_list" in plan.split("PartitionFilters: [")[1].split("]")[0]
    lists = {r[0] for r in idx.probed(q.select(F.col("sentence_embedding").alias("vec")), 1, "cosine", 8).select("list").collect()}
    assert len(lists) < 8 and len(read) == 8  # inputFiles lists the whole table; the scan prunes by the filter above
    scanned = known.select(F.input_file_name().alias("f")).distinct().collect()
    assert {int(r.f.rsplit("/", 2)[1].split("=")[1]) for r in scanned} == lists
    exact_products, products = _pairs(spark, q, c), _pairs(spark, q, idx.corpus, ivf=idx, nprobe=1)
    assert products < exact_products / 3
    exact, part = _got(vector_search(q, c, k=10)), _got(vector_search(q, idx.corpus, k=10, ivf=idx, nprobe=1))
    hits = sum(len({t for t, _ in part[t0]} & {t for t, _ in exact[t0]}) for t0 in exact)
    assert hits / sum(map(len, exact.values())) >= 0.9
    both = FilterSpec(use_product=True)
    assert _got(vector_search(q, idx.corpus, k=10, ivf=idx, nprobe=8, filters=both)) == _got(vector_search(q, c, k=10, filters=both))


def test_rows_added_to_a_stored_index(spark, tmp_path):
    c = _clusters(spark)
    old, new = c.where("ticket_id % 5 <> 0"), c.where("ticket_id % 5 = 0")
    first = se.store_ivf(build_ivf(old, n_lists=8, seed=2), str(tmp_path / "ivf"))
    files = set(first.corpus.inputFiles())
    idx = se.add_to_ivf(first, new.unionByName(new.limit(1).withColumn("sentence_embedding", F.lit(None).cast("array<double>"))))
    assert files < set(idx.corpus.inputFiles()) and idx.corpus.count() == 1201
    q = c.where("ticket_id % 60 = 1")
    assert _got(vector_search(q, idx.corpus, k=10, ivf=idx, nprobe=8)) == _got(vector_search(q, c, k=10))
    assert se.open_ivf(spark, str(tmp_path / "ivf")).corpus.count() == 1201
    with pytest.raises(ValueError, match="length"):
        se.add_to_ivf(idx, spark.createDataFrame([(1, "p", [1.0])], c.schema))
    with pytest.raises(ValueError, match="stored"):
        se.add_to_ivf(build_ivf(old, n_lists=2), new)


@pytest.mark.parametrize("metric", ["cosine", "inner", "l2"])
def test_few_products_are_looked_at_after_the_first_blocks(monkeypatch, metric):
    """With a floor per query row most products end with one comparison: a fraction of them is rounded and ranked."""
    import pyarrow as pa

    rng, dim, k = np.random.default_rng(31), 8, 5
    unit = lambda n: (lambda v: v / np.linalg.norm(v, axis=1, keepdims=True))(rng.normal(size=(n, dim)))
    Q, C, cid = unit(40), unit(20_000), np.arange(20_000) // 2
    rounded, real = [], np.round
    monkeypatch.setattr(se.np, "round", lambda x, d: rounded.append(np.size(x)) or real(x, d))
    rows = [(0, np.arange(40).tobytes(), Q.tobytes(), cid[at:at + 500].tobytes(), C[at:at + 500].tobytes()) for at in range(0, 20_000, 500)]
    names = ["q_block", "q_ids", "q_vecs", "ids", "vecs"]
    batches = [pa.RecordBatch.from_arrays([pa.array([x]) for x in r], names=names) for r in rows]
    empty = batches[0].slice(0, 0)
    run = se._scorer(k, metric, True, None, False, 6, dim, False)
    got = {(t, c): s for b in run(iter([*batches, empty])) for t, c, s in zip(*(b.column(i).to_pylist() for i in range(3)))}
    monkeypatch.undo()
    assert sum(rounded) < Q.shape[0] * len(C) / 10
    S = {"cosine": Q @ C.T, "inner": 1 + Q @ C.T, "l2": 1 - np.sqrt(((Q[:, None] - C[None]) ** 2).sum(-1))}[metric]
    best = np.round(S, 6).reshape(40, -1, 2).max(axis=2)
    for t in range(40):
        want = sorted(((-s, c) for c, s in enumerate(best[t]) if c != t))[:k]
        assert [(c, round(got[t, c], 6)) for _, c in want] == [(c, round(-s, 6)) for s, c in want]


def test_broadcast_stays_a_small_part_of_the_drivers_heap(spark, monkeypatch):
    """Query blocks below the byte bound are shuffled where the driver's heap is small: the same rows, nothing broadcast."""
    rng = np.random.default_rng(25)
    _, _, cdf, qdf = _frames(spark, rng, n_q=30)
    pairs = lambda: se.block_pairs(*se._sides(qdf, cdf, "ticket_id", "sentence_embedding", "ticket_id", "sentence_embedding",
                                              FilterSpec(), None, None, None, "cosine", 8), 8)
    plan = lambda: pairs()._jdf.queryExecution().optimizedPlan().toString()
    wide, plain = plan(), _got(vector_search(qdf, cdf, k=6))
    monkeypatch.setattr(se, "HEAP_PART", 1 << 30)
    assert "broadcast" in wide and "broadcast" not in plan()
    assert _got(vector_search(qdf, cdf, k=6)) == plain and plain


def test_joined_blocks_are_sent_a_few_at_a_time(spark):
    from simtrail.session import sent_bytes

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for now, want in (("64m", "100b"), ("50b", "50b"), ("1k", "100b")):
            spark.conf.set(key, now)
            sent_bytes(spark, 100)
            assert spark.conf.get(key) == want
    finally:
        spark.conf.set(key, before)
