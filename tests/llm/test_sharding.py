import hashlib
from collections import defaultdict

from simtrail.llm import sharding


def brute(rows, limit):
    """Buckets of (key, text) with keys all different: split the bucket that is too large."""
    items = [(int(hashlib.md5(("" if k is None else str(k)).encode()).hexdigest()[:15], 16), k, len((t or "").encode())) for k, t in rows]
    out = {}

    def split(some, depth, bucket):
        if sum(n for *_, n in some) <= limit or depth == 60:
            out.update({k: (depth, bucket) for _, k, _ in some})
            return
        for bit in (0, 1):
            part = [x for x in some if (x[0] >> (59 - depth)) & 1 == bit]
            if part:
                split(part, depth + 1, 2 * bucket + bit)

    split(items, 0, 0)
    return out


def test_against_brute_force(spark):
    rows = [(i, "x" * (i * 7 % 50)) for i in range(700)] + [(5000, "é" * 400), (None, None), (5001, "")]
    df = spark.createDataFrame([(k, t, "s", 9) for k, t in rows], "doc_id long, text string, shard_id string, depth int")
    for limit in (1000, 2500, 10**6):
        got = sharding.shard(df, limit).collect()
        want = brute(rows, limit)
        assert {r.doc_id: r.shard_id for r in got} == {k: f"{d}-{b}" for k, (d, b) in want.items()}
        sizes = defaultdict(int)
        for r in got:
            sizes[r.shard_id] += r.n_bytes
        assert max(sizes.values()) <= limit and len(got) == len(rows)


def test_uneven_directory_splits_only_large_cells(spark):
    rows = [(i, "x") for i in range(200)] + [(10**6 + i, "y" * 300) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.shard_id for r in sharding.shard(df, 320).collect()}
    assert got == {k: f"{d}-{b}" for k, (d, b) in brute(rows, 320).items()}


def test_repeated_rows_and_long_rows(spark):
    rows = [(7, "a" * 90)] * 200 + [(8, "b" * 5000)] * 3 + [(i, "c" * 20) for i in range(100, 140)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.shard(df, 1000).collect()
    assert len(got) == len(rows)
    sizes, count = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.shard_id] += r.n_bytes
        count[r.shard_id] += 1
    assert all(n <= 1000 or count[s] == 1 for s, n in sizes.items())
    assert len(sizes) < 60
    assert sharding.shard(df.limit(0), 10).count() == 0
