import numpy as np
import pytest

from simtrail.llm import ann, graph, pq
from simtrail.llm.queries import op6_ann, op7_neardup

SCHEMA = "vec_id long, embedding array<double>, id string, vec int"


def frame(spark, ids, vectors, parts=4):
    rows = [(int(i) if i is not None else None, None if v is None else [None if c is None else float(c) for c in v], "x", 1) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def clustered(n, d=16, seed=2, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    x = centres[rng.integers(0, 12, n)] + 0.6 * rng.normal(size=(n, d))
    for i in range(copies):
        x[n - 1 - i] = x[i % 7] + 0.05 * rng.normal(size=d) * (i % 3)
    return x


def brute_nearest(ids, x, every, k):
    out = {}
    for i, q in zip(ids, x, strict=True):
        if i % every == 0:
            score = (q * x).sum(1)
            order = sorted((-s, j) for j, s in zip(ids, score, strict=True) if j != i)
            out[i] = [(j, -s) for s, j in order[:k]]
    return out


def recall(rows, truth):
    got = {}
    for r in rows:
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert set(got) <= set(truth)
    hits = total = 0
    for q, want in truth.items():
        total += len(want)
        hits += sum(j in got.get(q, {}) for j, _ in want)
    return hits / total


def test_forest_reaches_the_asked_share(spark):
    x = clustered(3000, copies=60)
    ids = np.arange(3000) * 5
    rows = ann.nearest(frame(spark, ids, x), every=20, k=10, leaf_rows=100, sample=1500, measured=64).collect()
    truth = brute_nearest(ids, x, 20, 10)
    assert recall(rows, truth) > 0.93
    by_query = {}
    for r in rows:
        by_query.setdefault(r.query_id, []).append(r)
    at = {i: v for i, v in zip(ids, x, strict=True)}
    for q, found in by_query.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11))
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        assert all(abs(r.score - (at[q] * at[r.vec_id]).sum()) < 1e-9 for r in found)


def test_queue_order_and_leaves():
    x = clustered(800)
    forest = ann.Forest(x, 3, 16)
    for q in x[:20]:
        ways = forest.leaves_by_margin(q, 10**6)
        assert len(set(ways)) == len(ways) == sum(t.leaves for t in forest.trees)
        assert set(ways[:3]) == {(i, int(t.leaf_of(q[None])[0])) for i, t in enumerate(forest.trees)}


def test_query_is_exact_where_one_leaf_holds_all(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], float)
    rows = op6_ann(spark, sf).collect()
    truth = brute_nearest(ids.tolist(), x, 20, 20)
    assert {(r.query_id, r["rank"], r.vec_id) for r in rows} == {(q, n, j) for q, w in truth.items() for n, (j, _) in enumerate(w, 1)}


ODD = [(None, [1, 0]), (3, None), (4, [0, 0]), (5, [float("nan"), 1]), (6, [float("inf"), 1]), (7, [None, 1]), (8, [1, 2, 3]), (9, [])]


def test_nearest_with_odd_rows(spark):
    good = [(20, [1, 0]), (20, [1, 0]), (21, [2, 0]), (22, [2, 0]), (23, [0, 1]), (40, [0, -1]), (21, [3, 0])]
    df = frame(spark, *zip(*(good + ODD), strict=True))
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(df, k=3).orderBy("query_id", "rank").collect()]
    assert got == [(20, 1, 21, 3.0), (20, 2, 22, 2.0), (20, 3, 23, 0.0), (40, 1, 20, 0.0), (40, 2, 21, 0.0), (40, 3, 22, 0.0)]
    assert ann.nearest(df.limit(0)).count() == 0
    assert ann.nearest(frame(spark, *zip(*ODD, strict=True))).count() == 0


def brute_links(ids, x, t):
    u = x / np.sqrt((x**2).sum(1))[:, None]
    near = (u @ u.T) >= t
    pairs = [(int(ids[a]), int(ids[b])) for a, b in zip(*np.nonzero(near), strict=True) if a < b]
    group = graph.forest(pairs)
    return {int(i): (int(near[k].sum()) - 1, group.get(int(i), int(i))) for k, i in enumerate(ids)}


@pytest.mark.parametrize("threshold", [0.9, 0.75])
def test_all_links_are_found(spark, monkeypatch, threshold):
    monkeypatch.setattr(pq, "GROUP", 150)
    x = clustered(1200, copies=90, seed=6)
    ids = np.random.default_rng(1).permutation(1200) * 3
    got = {r.vec_id: (r.n_links, r.component_id) for r in pq.near_duplicates(frame(spark, ids, x), threshold=threshold).collect()}
    assert got == brute_links(ids, x, threshold)


def test_link_query_against_brute_force(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], float)
    rows = op7_neardup(spark, sf).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == brute_links(ids, x, 0.9)
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_links_with_odd_rows(spark):
    good = [(20, [1, 0]), (30, [1, 0]), (21, [2e200, 0]), (22, [1e-200, 1e-202]), (23, [0, 1]), (40, [0, -1]), (23, [0, -1])]
    df = frame(spark, *zip(*(good + ODD), strict=True))
    got = sorted((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in pq.near_duplicates(df).collect() if r.vec_id)
    alone = [(i, 0, i, True) for i in range(3, 10)]
    # the two vectors of id 23 tie its group to 40
    tail = [(20, 3, 20, True), (21, 3, 20, False), (22, 3, 20, False)]
    assert got[:7] == alone and got[7:10] == tail
    assert [(r[0], r[2]) for r in got[10:]] == [(23, 23), (23, 23), (30, 20), (40, 23)]
    assert pq.near_duplicates(df.limit(0)).count() == 0


def test_each_length_on_its_own(spark):
    """No vector is left out for its length; lengths are never compared with each other."""
    x2, x3 = clustered(60, d=2, seed=5, copies=12), clustered(90, d=3, seed=6, copies=20)
    ids2, ids3 = np.arange(60) * 2, np.arange(90) * 2 + 1
    df = frame(spark, [*ids2, *ids3, 500], [*x2, *x3, [0.0, 0.0, 0.0, 0.0]])
    rows = ann.nearest(df, every=5, k=4).collect()
    want = brute_nearest(ids2, x2, 5, 4) | brute_nearest(ids3, x3, 5, 4)
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [j for j, _ in v] for q, v in want.items()}
    links = {r.vec_id: (r.n_links, r.component_id) for r in pq.near_duplicates(df, threshold=0.9).collect()}
    for ids, x in ((ids2, x2), (ids3, x3)):
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        near = (unit @ unit.T >= 0.9) & ~np.eye(len(x), dtype=bool)
        roots = graph.forest((int(ids[a]), int(ids[b])) for a, b in zip(*np.nonzero(near), strict=True))
        for i, n in zip(ids.tolist(), near.sum(1).tolist(), strict=True):
            assert links[i] == (n, roots.get(i, i))
    assert links[500] == (0, 500)


def test_an_id_with_vectors_of_two_lengths(spark):
    df = frame(spark, [1, 2, 2, 3, 20], [[1.0, 0.0], [1.0, 0.01], [0.0, 0.0, 1.0], [0.0, 0.01, 1.0], [1.0, 0.02]])
    got = {(r.vec_id, r.n_links): r.component_id for r in pq.near_duplicates(df, threshold=0.9).collect()}
    assert got == {(1, 2): 1, (2, 2): 1, (2, 1): 1, (3, 1): 1, (20, 2): 1}
    assert [(r.query_id, r.vec_id) for r in ann.nearest(df, every=20, k=2).orderBy("rank").collect()] == [(20, 2), (20, 1)]


def test_pairs_of_blocks_are_read_not_shuffled(spark, monkeypatch):
    """Every vector is staged in one block, whatever it probes, and the search copies none over a shuffle."""
    monkeypatch.setattr(pq, "GROUP", 50)
    seen, stage = {}, pq.stage
    monkeypatch.setattr(pq, "stage", lambda df, tag, **o: seen.setdefault(tag, (df._jdf.queryExecution().executedPlan().toString(), out := stage(df, tag, **o), out.count()))[1])
    monkeypatch.setattr(pq, "drop_staged", lambda df: None)
    x = np.random.default_rng(4).normal(size=(600, 8))
    ids = np.arange(600)
    got = {r.vec_id: (r.n_links, r.component_id) for r in pq.near_duplicates(frame(spark, ids, x), threshold=0.9).collect()}
    assert got == brute_links(ids, x, 0.9)
    plan, _, _ = seen["found"]
    assert "Exchange" not in plan and "CartesianProduct" in plan
    blocks = [np.frombuffer(r.ids, np.int64) for r in seen["blocks"][1].collect()]
    assert sorted(np.concatenate(blocks).tolist()) == ids.tolist() and max(map(len, blocks)) <= 50


def test_links_of_single_and_double_numbers(spark):
    """Vectors that single numbers hold and others in one list; both zeros are one; equal bytes of two lengths are not."""
    x = clustered(300, d=6, copies=40, seed=9)
    x[::2] = x[::2].astype(np.float32)
    x[7], x[8] = [1, 0.0, 0, 0, 0, 2], [1, -0.0, 0, 0, 0, 2]
    ids = np.arange(300)
    rows = {r.vec_id: (r.n_links, r.component_id) for r in pq.near_duplicates(frame(spark, ids, x), threshold=0.9).collect()}
    assert rows == brute_links(ids, x, 0.9)
    wide, narrow = [1.1, 2.3], np.frombuffer(np.array([1.1, 2.3]).tobytes(), np.float32).tolist()
    assert [(r.n_links, r.kept) for r in pq.near_duplicates(frame(spark, [1, 2], [wide, narrow])).collect()] == [(0, True)] * 2
