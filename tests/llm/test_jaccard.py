import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from simtrail.llm import graph, jaccard


def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text, size):
    w = words_of(text)
    if not w:
        return frozenset()
    if len(w) < size:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def brute(docs, size, percent):
    """docs: list of (id, text), unique ids."""
    sets = {i: shingles(t, size) for i, t in docs}
    pairs = []
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                pairs.append((a, b))
    found = graph.forest(pairs)
    return {i: (len(sets[i]), found.get(i, i)) for i in ids}


def made(seed=1, families=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    line = rng.choices(vocabulary, k=25)
    docs = []
    for _ in range(families):
        base = rng.choices(vocabulary, k=rng.choice([3, 8, 40, 120, 300]))
        for _ in range(rng.randint(1, 14)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                w += line
            docs.append(" ".join(w))
    docs += ["", None, "  \n", "one", "ONE", "one two", "One two", "One\ttwo", " ".join(line), "é È", "É È"]
    rng.shuffle(docs)
    return [(i, t) for i, t in enumerate(docs)]


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_against_brute_force(spark, monkeypatch):
    for seed, size, percent, frequent in ((1, 3, 90, 64), (2, 5, 80, 3)):
        monkeypatch.setattr(jaccard, "FREQUENT", frequent)
        docs = made(seed)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
        assert result(jaccard.jaccard_groups(df, size=size, percent=percent)) == brute(docs, size, percent), seed


def test_shuffled_instead_of_broadcast(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 0)
    docs = made(7, 6)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(jaccard.jaccard_groups(df, size=3, percent=90)) == brute(docs, 3, 90)


def test_query_against_brute_force(spark, sf):
    from simtrail.llm.queries import op2_jaccard

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(op2_jaccard(spark, sf)) == brute(docs, 3, 90)


def test_repeated_ids_null_ids_and_no_rows(spark):
    schema = "doc_id long, text string, n int, gram string, component string"
    a, b, c = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30)), "x y z"
    rows = [(5, a), (5, b), (2, a), (9, b), (7, c), (7, c), (None, c), (None, None), (1, None)]
    df = spark.createDataFrame([(i, t, 1, "g", "q") for i, t in rows], schema)
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in jaccard.jaccard_groups(df, size=3, percent=90).collect())
    # ids 2 and 9 meet through the two texts of id 5
    assert got == [(-1, 0, -1), (-1, 1, -1), (1, 0, 1), (2, 28, 2), (5, 28, 2), (5, 28, 2), (7, 1, 7), (7, 1, 7), (9, 28, 2)]
    assert jaccard.jaccard_groups(df.limit(0)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    n = 60
    links = [(i, i + 1) for i in range(n)] + [(1000, 1000 + i) for i in range(1, 400)] + [(7, 7), (None, 3), (5, 4)]
    df = spark.createDataFrame(links, "x long, y long").repartition(16, F.rand(1))
    got = {r.node: r.component for r in graph.components(df).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000 + i: 1000 for i in range(400)}
    assert graph.components(df.limit(0)).count() == 0


def test_texts_of_one_id_with_sets_of_different_sizes(spark):
    words = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    a, b, d = words("a", 30), words("b", 50), words("d", 40)
    whole = d + " " + words("e", 400)
    rows = [(2, a), (5, a), (5, b), (9, b), (9, None), (20, d), (20, words("f", 35)), (21, whole), (22, d), (22, whole), (30, words("f", 35) + " g")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.jaccard_groups(df, size=3, percent=90).collect()}
    # 2, 5 and 9 meet through the two texts of id 5; 20, 21 and 22 through those of 22; 30 is near the second text of 20
    assert got == {(2, 28): 2, (5, 28): 2, (5, 48): 2, (9, 48): 2, (9, 0): 2, (20, 38): 20, (20, 33): 20, (21, 438): 20,
                   (22, 38): 20, (22, 438): 20, (30, 34): 20}


def test_a_pair_is_verified_on_the_sets_that_made_it(spark):
    line = " ".join(f"a{i}" for i in range(40))
    near, large = line.replace("a20 ", "z "), line.replace("a39", "y") + " " + " ".join(f"c{i}" for i in range(500))
    rows = [(1, near), (2, line.replace("a10 ", "x ")), (2, large), (3, " ".join(f"q{i}" for i in range(60)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(df, size=3, percent=80).collect()}
    # near shares most of its n-grams with large, but large has many more; near and the short text of 2 share 32 of 44
    assert got == {1: 1, 2: 2, 3: 3}


def test_open_columns_cut_into_cells(spark, monkeypatch):
    """Columns of more rows than a task compares at once are dealt in pairs of blocks; nothing is lost."""
    docs = made(7, families=16)
    monkeypatch.setattr(jaccard, "CELL", 3)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert result(jaccard.jaccard_groups(df, size=3, percent=90)) == brute(docs, 3, 90)


def test_pairs_of_one_column(monkeypatch):
    """Tiles, sizes, sketches and the first common column against every pair on its own."""
    rng = np.random.default_rng(3)
    monkeypatch.setattr(jaccard, "TILE", 4)
    order = np.arange(60)  # n-gram numbers; a leading one is small
    sets = []
    for _ in range(8):
        base = rng.choice(order, rng.integers(6, 30), replace=False)
        for _ in range(6):
            s = base.copy()
            s[rng.integers(0, len(s), 1)] = rng.choice(order, 1)
            sets.append(np.unique(s).astype(np.int64))
    sets = [s for s in sets if 5 in s]
    sets.sort(key=len)
    n, doc = np.array([len(s) for s in sets]), np.arange(len(sets))
    g, block = doc % 5, doc % 3
    sketch = np.stack([jaccard.parity_sketch(s) for s in sets]).view(np.uint64)
    firsts = np.stack([np.pad(s[: jaccard.FIRST], (0, max(0, jaccard.FIRST - len(s))), constant_values=jaccard.NONE) for s in sets])
    for across in (False, True):
        got = {(int(a), int(b)) for i, j in jaccard._column_pairs(80, doc, n, g, block, sketch, firsts, 5, across) for a, b in zip(i, j, strict=True)}
        want = set()
        for i in range(len(sets)):
            for j in range(i + 1, len(sets)):
                differ = int(np.bitwise_count(sketch[i] ^ sketch[j]).sum())
                common = [x for x in firsts[i] if x in firsts[j]]
                if (g[i] != g[j] and 100 * n[i] >= 80 * n[j] and differ * 180 <= 20 * (n[i] + n[j]) and (not common or common[0] == 5)
                        and (not across or block[i] != block[j])):
                    want.add((i, j))
        assert got == want and got


def test_near_copies_of_many_sizes_leave_few_open_pairs(spark):
    """A large group of near copies whose smallest member is no typical one: the rounds of stars join it."""
    rng = random.Random(11)
    base = [f"v{i}" for i in range(200)]
    docs = []
    for i in range(400):
        w = list(base) + [f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(12))]
        w[rng.randrange(150)] = f"y{i}"
        docs.append((i, " ".join(w)))
    docs.append((1000, " ".join(base[:150])))  # the smallest set of every column it has
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    small = df.select(F.col("doc_id").alias("doc"), "text")
    rows = jaccard._sets(small, 3, "entries", 90).select("doc", "n", "gram")
    first = jaccard._stars(rows.withColumn("g", F.col("doc")), 90)
    assert 200 < first.count() < 20 * len(docs)
    # spanning pairs: no more than there are rows in the columns, though nearly all pairs are candidates
    heads = jaccard._sets(small, 3, "heads", 90).select("doc", "n", "sketch")
    leads = jaccard._sets(small, 3, "entries", 90).where("firsts is not null").select("doc", "n", "firsts")
    marked = rows.withColumn("g", F.col("doc")).join(heads, ["doc", "n"]).join(leads, ["doc", "n"])
    few, all_pairs = jaccard._later(marked, 90, True), jaccard._later(marked, 90, False)
    assert few.count() <= rows.count() and all_pairs.count() > 20_000
    joined = lambda p: {r.node: r.component for r in graph.components(p.select("a", "b")).collect()}
    assert joined(few) == joined(all_pairs)
    assert result(jaccard.jaccard_groups(df, size=3, percent=90)) == brute(docs, 3, 90)


def test_hub_with_most_links(spark):
    rows = [(i, 0) for i in range(1, 5000)] + [(i, i - 1) for i in range(6000, 6200)] + [(7000, 4999), (7000, 6100)]
    links = spark.createDataFrame(rows, "a long, b long").repartition(6)
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert got == {i: 0 for i in [*range(5000), *range(5999, 6200), 7000]}


def test_entries_of_heads_equal_those_of_texts(spark):
    """What the kept n-grams name as leading is what the whole sets do; unknown ones are read again."""
    docs = made(5, families=20)
    df = spark.createDataFrame(docs, "doc long, text string").where("text is not null")
    heads = jaccard._sets(df, 3, "heads", 90).where("n > 0")
    grams = sorted(g for r in heads.collect() for g in np.frombuffer(r.head, np.int64).tolist())
    for last in (np.empty(0, np.int64), np.array(grams[::40]), np.array(sorted(set(grams))[::2]), np.array(sorted(set(grams)))):
        sent = spark.sparkContext.broadcast(np.unique(last))
        rows = lambda t: {(r.doc, r.n, r.gram, r.firsts) for r in t.collect()}
        got, want = rows(jaccard._entries_of_heads(heads, 90, sent)), rows(jaccard._sets(df, 3, "entries", 90, sent))
        unknown = {d for d, _, g, _ in got if g is None}
        assert {r for r in got if r[2] is not None} == {r for r in want if r[0] not in unknown}
        assert (not last.size) <= (not unknown)
    assert unknown  # where all are frequent, long texts are not known by their heads


def test_sketches_by_set_size(monkeypatch):
    """A set's sketch has a bit an n-gram at least, up to the longest; a long one folds to a short one, and pairs of rows with
    sketches of different lengths are compared."""
    rng = np.random.default_rng(5)
    monkeypatch.setattr(jaccard, "TILE", 4)
    assert [jaccard.sketch_words(n) for n in (1, 512, 513, 1024, 1025, 9000)] == [8, 8, 16, 16, 32, 32]
    sets = []
    for n in (100, 480, 530, 1000, 1060, 3000):
        base = rng.integers(-(2**62), 2**62, n)
        sets += [np.unique(np.concatenate([base[k:], rng.integers(-(2**62), 2**62, 2 * k)])) for k in range(0, 50, 7)]
    sets.sort(key=len)
    raw = [jaccard.parity_sketch(s, jaccard.sketch_words(len(s))) for s in sets]
    for s, short in zip(sets, raw, strict=True):
        assert (jaccard._folded(jaccard.parity_sketch(s)[None], len(short)) == short).all()
    n, doc = np.array([len(s) for s in sets]), np.arange(len(sets))
    firsts = np.full((len(sets), jaccard.FIRST), jaccard.NONE)
    runs = jaccard._runs([r.tobytes() for r in raw])
    assert [r[2].shape[1] for r in runs] == [8, 16, 32]
    got = {(int(a), int(b)) for i, j in jaccard._column_pairs(80, doc, n, doc, doc, runs, firsts, 5, False) for a, b in zip(i, j, strict=True)}
    near = set()
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            common = np.intersect1d(sets[i], sets[j]).size
            if 100 * common >= 80 * (n[i] + n[j] - common):
                near.add((i, j))
    assert near <= got and len({(len(raw[i]), len(raw[j])) for i, j in near}) == 5  # within all lengths and across both borders
    assert len(got) < len(sets) ** 2 / 8  # unrelated sets are told apart


def test_heads_carry_short_sketches(spark):
    rows = [(1, " ".join(f"a{i}" for i in range(300))), (2, " ".join(f"a{i}" for i in range(3000)))]
    heads = jaccard._sets(spark.createDataFrame(rows, "doc long, text string"), 3, "heads", 90)
    assert {r.doc: len(r.sketch) for r in heads.collect()} == {1: 64, 2: 256}


def test_word_hashes_tell_words_apart():
    rng = random.Random(5)
    texts = [None, b"", b" \n", b"one", b"ONE two", b" a  b\tc\x0bd\x0ce\rf ", "é È x".encode(), b"\x00 \x00\x00 a\x00", b"c " * 50]
    texts += [b"x" * 200 + b" " + b"x" * 201 + b" y", b"z" * 128 + b" " + b"z" * 129]
    texts += [bytes(rng.choice(b"ab \tAB\x1c\xc3") for _ in range(rng.randrange(40))) for _ in range(500)]
    for size in (1, 3, 5):
        got = jaccard.shingle_sets(texts, size)
        named = {}
        for t, numbers in zip(texts, got, strict=True):
            w = (t or b"").lower().split()
            words = {tuple(w[i : i + min(size, len(w))]) for i in range(max(1, len(w) - size + 1))} if w else set()
            assert len(numbers) == len(words) and (numbers[1:] > numbers[:-1]).all()
            assert named.setdefault(frozenset(words), numbers.tobytes()) == numbers.tobytes()
        assert len(set(named.values())) == len(named)


def cells(rng, sizes, percent=90):
    """Rows of columns as _later sends them: documents of a few families with their sketches, in order of (gram, n, doc)."""
    rows = []
    for gram, size in enumerate(sizes):
        some = []
        for doc in rng.sample(range(10_000), size):
            base = rng.choice([60, 300, 700, 2500])
            grams = np.random.default_rng(base).integers(-(2**62), 2**62, base)
            grams = np.unique(np.concatenate([grams[rng.randrange(base // 12) :], np.array([doc], np.int64)]))
            firsts = np.array([gram, jaccard.NONE, rng.randrange(-3, 0), gram + 1000], np.int64)
            some.append((gram, 0, 0, len(grams), doc, rng.choice([doc, 7]), 0,
                         jaccard.parity_sketch(grams, jaccard.sketch_words(len(grams))).tobytes(), firsts.tobytes()))
        rows += sorted(some, key=lambda r: (r[3], r[4]))
    names = ["gram", "i", "j", "n", "doc", "g", "block", "sketch", "firsts"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def test_small_cells_are_compared_together(monkeypatch):
    """The pairs are those of one cell at a time, for a call instead of a call a cell."""
    rng = random.Random(3)
    sizes = [1, 2, 5, 40, 1, 3, 90, 128, 130, 2, 17]
    rows, cuts = cells(rng, sizes), np.concatenate([[0], np.cumsum(sizes)])
    calls, column_pairs = [], jaccard._column_pairs
    monkeypatch.setattr(jaccard, "_column_pairs", lambda *a: (calls.append(len(a[1])), column_pairs(*a))[1])

    def found(spanning, small):
        monkeypatch.setattr(jaccard, "SMALL", small)
        calls.clear()
        return sorted(tuple(r.values()) for b in jaccard._cell_pairs(90, rows, cuts, spanning) for r in b.to_pylist()), list(calls)

    one_by_one, each = found(False, 0)
    together, large = found(False, 128)
    assert together == one_by_one and len(together) > 500
    assert each == sizes and large == [130]
    # pairs that span a cell join the same rows
    assert len(found(True, 128)[0]) == len(found(True, 0)[0]) < len(together)


def nearly_near(m, own=17):
    """Documents that share 298 n-grams and have ``own`` each: with 17 any two have a similarity of 0.898, with 27 of 0.847."""
    base = " ".join(f"v{i}" for i in range(300))
    return [(i, base + "".join(f" x{i}_{k}" for k in range(own))) for i in range(m)]


def test_pairs_below_the_threshold_are_not_listed(spark, monkeypatch):
    """Candidates that are no links stay open to the end; what is written of them grows with the rows, not with their pairs."""
    made_rows, stage = [], jaccard.stage

    def counted(df, tag):
        out = stage(df, tag)
        if out.columns[:2] == ["a", "b"]:
            made_rows.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stage", counted)
    docs = nearly_near(150) + [(1000 + i, t + " z") for i, t in nearly_near(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = brute(docs, 3, 90)
    assert result(jaccard.jaccard_groups(df, size=3, percent=90)) == want
    assert len({c for _, c in want.values()}) == 150
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(made_rows) <= tasks * len(docs) < 150 * 149 / 2


def test_clusters_cut_into_blocks(spark, monkeypatch):
    """Clusters of more n-grams than a task compares at once are dealt in blocks, within them and across; nothing is lost."""
    calls, compared = [], jaccard._compared
    monkeypatch.setattr(jaccard, "_compared", lambda *a: (calls.append(1), compared(*a))[1])
    for seed, grams in ((3, 500), (7, 40)):
        monkeypatch.setattr(jaccard, "GRAMS", grams)
        docs = made(seed, families=14) + [(5000 + i, t) for i, t in nearly_near(12, 27)]
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        assert result(jaccard.jaccard_groups(df, size=3, percent=85)) == brute(docs, 3, 85), seed
    assert len(calls) == 4


def test_links_of_sets(monkeypatch):
    """Sets compared exactly join the same components as every pair on its own, within a cell and across two blocks."""
    rng = np.random.default_rng(8)
    monkeypatch.setattr(jaccard, "TILE", 4)
    sets = []
    for _ in range(6):
        base = rng.integers(-(2**62), 2**62, int(rng.integers(20, 400)))
        sets += [np.unique(np.concatenate([base[k:], rng.integers(-(2**62), 2**62, k)])) for k in range(0, 20, 2)]
    sets.sort(key=len)
    n, doc = np.array([len(s) for s in sets]), np.arange(len(sets)) + 100
    block = doc % 2
    g = np.where(doc % 3 == 0, doc - 1, doc)
    for across in (False, True):
        links = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if (not across or block[i] != block[j])
                 and 100 * (c := np.intersect1d(sets[i], sets[j]).size) >= 80 * (n[i] + n[j] - c)]
        got = jaccard._set_links(80, doc, n, g, block, sets, across)
        want = graph.forest([(int(g[i]), int(g[j])) for i, j in links])
        own = graph.forest([(int(g[a - 100]), int(g[b - 100])) for a, b in got])
        assert {x: c for x, c in own.items() if x != c} == {x: c for x, c in want.items() if x != c}
        assert set(got) <= {(i + 100, j + 100) for i, j in links} and 0 < len(got) < len(links)


def test_long_sets_are_told_apart_by_wide_sketches(spark):
    """Long unrelated texts that share a passage are no candidates (2,048 bits say nothing about sets of 5,000)."""
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(400))
    docs = [(i, passage + " " + " ".join(f"w{rng.randrange(10**7)}" for _ in range(5000))) for i in range(6)]
    df = spark.createDataFrame(docs, "doc long, text string")
    heads = jaccard._sets(df, 3, "heads", 80)
    assert [len(r.wide) for r in heads.collect()] == [512] * 6  # bytes: 4,096 bits
    entries = jaccard._sets(df, 3, "entries", 80)
    about = heads.join(entries.where("firsts is not null").select("doc", "firsts"), "doc")
    rows = entries.select("doc", "n", "gram").withColumn("g", F.col("doc"))
    pairs = lambda sketch: jaccard._later(rows, 80, False, about.select("doc", "n", F.col(sketch).alias("sketch"), "firsts")).count()
    assert pairs("sketch") > 0 and pairs("wide") == 0


def test_entries_too_far_back_are_left_out(spark):
    """An entry stays where a partner within the threshold can have it as first in common, and no longer."""
    rows = [(1, 10, 100, 0), (1, 11, 100, 11), (2, 12, 100, 12), (2, 10, 85, 15), (3, 10, 100, 5), (3, 11, 100, 11), (4, 10, 100, 19), (4, 12, 100, 0)]
    df = spark.createDataFrame(rows, "gram long, doc long, n int, place int")
    groups = spark.createDataFrame([(10, 10), (11, 10)], "doc long, g long")
    got = {(r.gram, r.doc) for r in jaccard._still_open(df, groups, 80).collect()}
    # columns 1 and 3 have one component; 10 lies too far back in 2 and 4
    want = set()
    for gram, doc, n, place in rows:
        others = [m for c, _, m, _ in rows if c == gram]
        if gram not in (1, 3) and (n - place) * 180 >= 80 * (n + max(min(others), -(-80 * n // 100))):
            want.add((gram, doc))
    assert got == want == {(2, 12), (4, 12)}
