import numpy as np
import pyarrow.parquet as pq
import pytest

from simtrail.llm import whitening
from simtrail.llm.queries import op13_whitening

SCHEMA = "vec_id long, embedding array<double>, component string, n int"


def frame(spark, rows, parts=3):
    made = [(i, None if v is None else [None if c is None else float(c) for c in v], "x", 1) for i, v in rows]
    return spark.createDataFrame(made, SCHEMA).repartition(parts)


def check(rows, vectors, scale=64.0):
    """Against whole-matrix arithmetic in Python integers; vectors: id to list."""
    ids = sorted(vectors)
    x = np.array([[int(np.floor(scale * c)) + 1000000 for c in vectors[i]] for i in ids], object)
    n, d = x.shape
    s = x.sum(axis=0)
    gap = n * x - s
    v = ((gap.T @ gap) / n**3).astype(float)
    values = np.sort(np.linalg.eigvalsh(v))[::-1]
    got = {}
    for r in rows:
        got[r.vec_id, r.component] = r
    k = min(32, d)
    assert set(got) == {(i, c) for i in ids for c in range(1, k + 1)} and len(got) == len(rows)
    w = np.array([[got[i, c].whitened for c in range(1, k + 1)] for i in ids])
    for at, i in enumerate(ids):
        r = got[i, 1]
        assert r.n == n and r.deviation == sum(int(g) ** 2 for g in gap[at])
    live = values[:k] > 1e-9 * values.sum()
    for c in range(k):
        assert got[ids[0], c + 1].explained == pytest.approx(values[c] / values.sum(), rel=1e-9, abs=1e-12)
    cov = w.T @ w / n - np.outer(w.mean(0), w.mean(0))
    assert np.abs(cov - np.eye(k))[np.ix_(live, live)].max() < 1e-8
    assert rows[0].identity_error < 1e-8
    # the projections are along unit eigenvectors of v
    back = np.linalg.lstsq(gap.astype(float) / n, w * np.sqrt(np.maximum(values[:k], 0)), rcond=None)[0][:, live]
    assert np.abs(v @ back - back * values[:k][live]).max() < 1e-7 * values[0]


def test_cross_products_are_exact():
    rng = np.random.default_rng(1)
    for top, rows, d in ((40, 100, 5), (2**39, 300, 4), (3, 4096, 17), (1, 1, 3), (2**33, 64, 2)):
        y = rng.integers(-top, top + 1, (rows, d))
        assert (whitening.cross_products(y) == y.astype(object).T @ y.astype(object)).all()
    y = np.array([[-(2**39)], [2**39]])
    assert whitening.cross_products(y)[0, 0] == 2**79


def test_query_against_integer_arithmetic(spark, sf):
    t = pq.read_table(f"{sf}/embeddings.parquet")
    vectors = dict(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist(), strict=True))
    check(op13_whitening(spark, sf).collect(), vectors)


def test_cells_larger_than_one_block(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ALIVE", 7)
    rng = np.random.default_rng(4)
    y = rng.integers(-50, 50, (130, 9))
    assert (whitening.cross_products(y) == y.T @ y).all()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = {1: [0.5, -3.0, 2.0], 2: [1.0, 1.0, 1.0], 3: [0.0, 0.0, 0.0], 4: [9.0, -0.01, 7.7], 5: [1.0, 1.0, 1.0]}
    bad = [(10, None), (11, [1.0, None, 2.0]), (12, [nan, 0.0, 0.0]), (13, [inf, 0.0, 0.0]), (14, [])]
    out = whitening.whiten(frame(spark, [*good.items(), *bad]))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(out.collect(), good)
    # null and repeated ids stay
    rows = whitening.whiten(frame(spark, [(None, [1.0, 2.0]), (7, [3.0, 0.0]), (7, [3.0, 0.0]), (7, [5.0, 5.0])])).collect()
    assert sorted(str(r.vec_id) for r in rows) == ["7"] * 6 + ["None"] * 2 and {r.n for r in rows} == {4}
    # each length is a fit list of its own
    two = {21: [1.0, 2.0], 22: [4.0, 1.0], 23: [0.0, 9.0]}
    mixed = whitening.whiten(frame(spark, [*good.items(), *two.items()])).collect()
    check([r for r in mixed if r.vec_id < 20], good)
    check([r for r in mixed if r.vec_id > 20], two)
    # no variance: one row, or constant entries
    for some in ({1: [2.0, 3.0]}, {1: [2.0, 3.0], 2: [2.0, 3.0]}):
        rows = whitening.whiten(frame(spark, some.items())).collect()
        assert {(r.whitened, r.deviation, r.explained, r.identity_error) for r in rows} == {(0.0, 0, 0.0, 0.0)}
    assert whitening.whiten(frame(spark, [])).collect() == []
    with pytest.raises(Exception, match="beyond"):
        whitening.whiten(frame(spark, [(1, [1e30])])).collect()


def test_large_entries_stay_exact(spark):
    vectors = {1: [2.0**33, 0.5, 1.0], 2: [-(2.0**33), 3.0, 7.0], 3: [0.0, 1.0, 2.5], 4: [12.0, -8.0, 2.5]}
    rows = whitening.whiten(frame(spark, vectors.items()), components=3).collect()
    got = {r.vec_id: r.deviation for r in rows}
    y = {i: [int(np.floor(64 * c)) for c in v] for i, v in vectors.items()}
    s = [sum(c) for c in zip(*y.values(), strict=True)]
    want = {i: sum((4 * c - t) ** 2 for c, t in zip(v, s, strict=True)) for i, v in y.items()}
    assert got == {i: (x if x < 2**63 else None) for i, x in want.items()} and got[1] is None and got[3] is not None
