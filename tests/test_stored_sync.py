import os

import pytest
from pyspark.sql import functions as F

from simtrail.operators import sync as sy
from simtrail.plans import stored_sync as st

ART = "id long, sentence string, product string, module string, homolog boolean, tags string, updated_at long"
TABLE = "id long, sentence string, product string, module string, homolog boolean, updated_at long"


def files(path):
    out = {}
    for root, _, names in os.walk(f"{path}/rows"):
        for n in names:
            if n.endswith(".parquet"):
                out.setdefault(os.path.relpath(root, f"{path}/rows"), set()).add(n)
    return out


def rows(df):
    return sorted(str((r.id, r.sentence, r.product, r.module, r.homolog, r.updated_at, r.tags, r.sentence_embedding)) for r in df.collect())


@pytest.fixture
def start(spark, tmp_path):
    """400 rows of three products (one name that no folder could have, one empty), an index of ids and the articles they come from."""
    product = "element_at(array('A/B: x', '', 'p2'), int(id % 3) + 1)"
    art = spark.range(400).selectExpr("id", "concat('text ', id) AS sentence", f"{product} AS product", "concat('m', id % 2) AS module",
                                      "if(id % 7 = 0, null, id % 2 = 0) AS homolog", "cast(null as string) AS tags", "id AS updated_at")
    path = str(tmp_path / "t")
    st.create_stored_table(art.drop("tags"), path, buckets=8)
    return path, art


def none(spark, schema="id long"):
    return spark.createDataFrame([], schema)


def test_only_touched_buckets_are_rewritten(spark, start):
    path, art = start
    before = files(path)
    assert len(before) == 24 and all(len(v) == 1 for v in before.values())
    changed = art.withColumn("sentence", F.when(F.col("id") == 5, "other text").otherwise(F.col("sentence")))
    more = spark.createDataFrame([(1000, "brand new", "p2", "m1", True, '["a","b"]', 1000)], ART)
    incoming, deleted = changed.unionByName(more), spark.createDataFrame([(11,)], "id long")
    table = st.read_stored_table(spark, path)
    plan = sy.prepare_sync(incoming, table.select("id", "sentence"), deleted)
    want = rows(sy.apply_sync(table, plan, deleted))
    report = st.sync_stored_table(spark, path, incoming, deleted, epoch=0)
    got = st.read_stored_table(spark, path)
    assert rows(got) == want and got.count() == 400
    new = {r.id: r for r in got.where("id in (5, 1000)").collect()}
    assert new[1000].tags == ["a", "b"] and len(new[5].sentence_embedding) == 64 and new[5].sentence == "other text"
    after = files(path)
    same = [d for d in before if after.get(d) == before[d]]
    assert report.applied and 1 <= report.touched <= 3 and report.watermark == "1000"
    assert len(same) == 24 - report.touched


def test_replayed_epoch_changes_nothing(spark, start):
    path, art = start
    more = spark.createDataFrame([(1000, "brand new", "p2", "m1", True, None, 1000)], ART)
    assert st.sync_stored_table(spark, path, art.unionByName(more), none(spark), epoch=3).applied
    now, table = files(path), rows(st.read_stored_table(spark, path))
    for epoch in (3, 1):
        again = st.sync_stored_table(spark, path, art.where("id < 10"), spark.createDataFrame([(0,)], "id long"), epoch=epoch)
        assert not again.applied and again.touched == 0
    assert files(path) == now and rows(st.read_stored_table(spark, path)) == table
    # the same batch under a new number finds nothing to do
    done = st.sync_stored_table(spark, path, art.unionByName(more), none(spark))
    assert done.applied and done.touched == 0 and files(path) == now


def test_sync_that_stopped_before_its_epoch_runs_again(spark, start, monkeypatch):
    path, art = start
    catalogue = spark.createDataFrame([("p2", "m0", True, 1), ("p2", "m1", False, 1)], "product string, module string, homolog boolean, ord int")
    incoming, deleted = art.where("id <> 8"), spark.createDataFrame([(11,), (12,)], "id long")
    table = st.read_stored_table(spark, path)
    plan = sy.prepare_sync(incoming, table.select("id", "sentence"), deleted)
    want = rows(sy.apply_sync(table, plan, deleted, catalogue))
    write = st._write

    def stops(df, where, mode):
        write(df, where, mode)
        raise RuntimeError("lost")

    monkeypatch.setattr(st, "_write", stops)
    with pytest.raises(RuntimeError):
        st.sync_stored_table(spark, path, incoming, deleted, catalogue, epoch=0)
    monkeypatch.setattr(st, "_write", write)
    assert st.sync_stored_table(spark, path, incoming, deleted, catalogue, epoch=0).applied
    assert rows(st.read_stored_table(spark, path)) == want


def test_emptied_buckets_go_and_changes_only(spark, start):
    path, art = start
    # every row of the product with the odd name goes; a batch of changes removes nothing by its absence
    gone = art.where("product = 'A/B: x'").select("id")
    report = st.sync_stored_table(spark, path, art.limit(0), gone, remove_missing=False)
    assert report.touched == 8 and report.watermark is None
    assert len(files(path)) == 16 and st.read_stored_table(spark, path).where("product = 'A/B: x'").count() == 0
    assert st.read_stored_table(spark, path).count() == art.where("product <> 'A/B: x'").count()
    assert st.sync_stored_table(spark, path, art.limit(0), none(spark)).touched == 16  # all absent: all removed
    assert not files(path)
