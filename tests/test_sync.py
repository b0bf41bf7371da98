from pyspark.sql import functions as F

from simtrail.operators import sync as sy

ART = "id long, sentence string, product string, module string, homolog boolean, tags string, updated_at long"


def _incoming(spark):
    return spark.createDataFrame([
        (1, "a", "p", "m", True, '["x"]', 10), (2, "b", "p", "n", False, None, 20),
        (3, None, "q", "m", None, "", 30), (4, "it's", "q", "m", True, '["y","z"]', 40),
    ], ART)


def test_diff_and_idempotence(spark):
    inc = _incoming(spark)
    existing = spark.createDataFrame([(1, "a"), (2, "old"), (9, "gone")], "id long, sentence string")
    deleted = spark.createDataFrame([(4,)], "id long")
    plan = sy.prepare_sync(inc, existing, deleted)
    new = {(r.id, r.sentence) for r in plan.new_rows.collect()}
    assert new == {(2, "b"), (3, "")}  # NULL sentence filled with '' first (nothing dropped)
    assert {(r.id, r.sentence) for r in plan.removed.collect()} == {(2, "old"), (9, "gone")}
    assert plan.watermark.first().updated_at_max == 30
    tags = {r.id: r.tags for r in plan.new_rows.collect()}
    assert tags[3] == []
    # second run against the synced pairs: nothing new, nothing removed
    synced = existing.join(plan.removed, ["id", "sentence"], "left_anti").unionByName(
        plan.new_rows.select("id", "sentence"))
    again = sy.prepare_sync(inc, synced, deleted)
    assert again.new_rows.count() == 0 and again.removed.count() == 0
    assert again.watermark.first().updated_at_max is None


def test_drop_missing_first_and_no_cache(spark):
    inc = _incoming(spark)
    none = spark.createDataFrame([], "id long")
    ex = spark.createDataFrame([(1, "a")], "id long, sentence string")
    p = sy.prepare_sync(inc, ex, none, drop_missing_first=True)
    assert 3 not in {r.id for r in p.new_rows.collect()}
    p2 = sy.prepare_sync(inc, ex, none, cache=False)
    assert p2.new_rows.count() == 4 and p2.removed.count() == 0


def test_insert_if_absent_twice_is_once(spark):
    table = spark.createDataFrame([(1, "a")], "id long, sentence string")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "it's")], "id long, sentence string")
    once = table.unionByName(sy.insert_if_absent(table, rows))
    twice = once.unionByName(sy.insert_if_absent(once, rows))
    assert sorted(once.collect()) == sorted(twice.collect()) and once.count() == 3


def test_delete_by_id_and_pair_with_quotes(spark):
    table = spark.createDataFrame([(1, "it's"), (1, "x"), (2, "y"), (None, "z")], "id long, sentence string")
    pairs = spark.createDataFrame([(1, "it's")], "id long, sentence string")
    assert sorted(r.sentence for r in sy.delete_by_pair(table, pairs).collect()) == ["x", "y", "z"]
    ids = spark.createDataFrame([(1,)], "id long")
    assert sorted(r.sentence for r in sy.delete_by_id(table, ids).collect()) == ["y", "z"]


def test_flag_sync_modes(spark):
    table = spark.createDataFrame([(1, "p", "m", False), (2, "p", "m", True), (3, "q", "m", True), (4, "p", "m", None),
                                   (5, "r", "m", False)], "id long, product string, module string, homolog boolean")
    cat = spark.createDataFrame([("p", "m", False, 1), ("p", "m", True, 2), ("q", "m", True, 1)],
                                "product string, module string, homolog boolean, ord int")
    aw = {r.id: r.homolog for r in sy.flag_sync(table, cat).collect()}
    assert aw == {1: True, 2: True, 3: False, 4: None, 5: False}
    cm = {r.id: r.homolog for r in sy.flag_sync(table, cat, mode="catalogue").collect()}
    assert cm == {1: False, 2: False, 3: True, 4: None, 5: False}


def test_apply_sync_end_to_end(spark):
    inc = _incoming(spark)
    table = spark.createDataFrame([(1, "a", "p", "m", False, 1), (2, "old", "p", "n", True, 2),
                                   (4, "it's", "q", "m", True, 4)],
                                  "id long, sentence string, product string, module string, homolog boolean, "
                                  "updated_at long")
    deleted = spark.createDataFrame([(4,)], "id long")
    plan = sy.prepare_sync(inc, table.select("id", "sentence"), deleted)
    out = sy.apply_sync(table, plan, deleted)
    assert sorted((r.id, r.sentence) for r in out.collect()) == [(1, "a"), (2, "b"), (3, "")]
    assert out.columns[:len(table.columns)] == table.columns and "sentence_embedding" in out.columns
    counts = {r.product: r.n for r in sy.per_product_counts(out).collect()}
    assert counts == {"p": 2, "q": 1}


def test_long_texts_are_whole_and_the_second_sync_is_empty(spark):
    long_text = "word " * 1500
    inc = spark.createDataFrame([(1, long_text, "p", "m", False, None, 3)],
                                "id long, sentence string, product string, module string, homolog boolean, tags string, updated_at long")
    table = spark.createDataFrame([], "id long, sentence string, product string, module string, homolog boolean, updated_at long")
    none = spark.createDataFrame([], "id long")
    out = sy.apply_sync(table, sy.prepare_sync(inc, table.select("id", "sentence"), none), none)
    row = out.first()
    assert row.sentence == long_text and len(row.sentence_embedding) == 64 and row.tags is not None
    again = sy.prepare_sync(inc, out.select("id", "sentence"), none)
    assert again.new_rows.count() == 0 and again.removed.count() == 0


def test_same_row_stays_whatever_the_partitions(spark):
    rows = spark.createDataFrame([(1, "a", "p", i) for i in range(9)], "id long, sentence string, product string, n int")
    table = rows.limit(0).select("id", "sentence")
    kept = {sy.insert_if_absent(table, rows.repartition(k)).first().n for k in (1, 3, 7)}
    assert len(kept) == 1


def test_diff_is_made_once(spark):
    """The new rows and the removed pairs read the staged diff; they do not each join all texts again."""
    existing = spark.createDataFrame([(1, "a"), (9, "gone")], "id long, sentence string")
    plan = sy.prepare_sync(_incoming(spark), existing, spark.createDataFrame([], "id long"))
    for part in (plan.removed, plan.new_rows, plan.watermark):
        files = part.inputFiles()
        assert files and all("sync-diff" in f for f in files)


def test_pairs_to_remove_are_shuffled_without_their_texts(spark):
    """Long texts on the pairs' side are told by their digest; NULL equals nothing, as in SQL."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = spark.createDataFrame([(1, "a"), (1, "a "), (2, None), (None, "a"), (3, "c"), (3, "c")], "id long, sentence string")
        pairs = spark.createDataFrame([(1, "a"), (2, None), (None, "a"), (3, "c")], "id long, sentence string")
        left = sy.delete_by_pair(table, pairs)
        assert {(r.id, r.sentence) for r in left.collect()} == {(1, "a "), (2, None), (None, "a")}
        plan = left.select("id")._jdf.queryExecution().optimizedPlan().toString()
        assert "_p__d" in plan and "_p_sentence" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
