import os

from simtrail.plans.sync_job import run_article_sync
from simtrail.plans import stored_sync as st
from simtrail.streaming.article_stream import start_article_stream, start_stored_stream

ART = "id long, sentence string, product string, module string, homolog boolean, tags string, updated_at long"


def test_run_article_sync_writes_new_version(spark, tmp_path):
    inc = spark.createDataFrame([(1, "a", "p", "m", True, None, 5), (2, "b", "q", "m", False, '["t"]', 7)], ART)
    table = spark.createDataFrame([(1, "a", "p", "m", True, 1), (3, "c", "p", "m", False, 3)],
                                  "id long, sentence string, product string, module string, homolog boolean, "
                                  "updated_at long")
    out, mark = run_article_sync(spark, table, inc, table.select("id", "sentence"),
                                 spark.createDataFrame([], "id long"), str(tmp_path / "v2"))
    assert sorted((r.id, r.sentence) for r in out.collect()) == [(1, "a"), (2, "b")]
    assert mark == 7
    assert os.path.isdir(tmp_path / "v2" / "product=q")


def test_stream_applies_each_file_once(spark, tmp_path):
    src, sink, ck = str(tmp_path / "src"), str(tmp_path / "sink"), str(tmp_path / "ck")
    spark.createDataFrame([(1, "a", "p", "m", True, None, 1), (2, "b", "p", "m", True, None, 2)], ART) \
        .write.parquet(src + "/f1")
    existing = spark.createDataFrame([(1, "a")], "id long, sentence string")

    def current():
        try:
            return existing.unionByName(spark.read.parquet(sink).select("id", "sentence"))
        except Exception:
            return existing

    schema = spark.read.parquet(src + "/f1").schema
    q = start_article_stream(spark, src + "/*", schema, current, lambda: spark.createDataFrame([], "id long"),
                             sink, ck)
    q.awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == [2]
    # restart: the processed file is not applied again
    q = start_article_stream(spark, src + "/*", schema, current, lambda: spark.createDataFrame([], "id long"),
                             sink, ck)
    q.awaitTermination(120)
    assert spark.read.parquet(sink).count() == 1


def test_stream_into_a_stored_table(spark, tmp_path):
    src, path, ck = str(tmp_path / "src"), str(tmp_path / "table"), str(tmp_path / "ck")
    rows = [(i, f"text {i}", "p", "m", True, i) for i in range(20)]
    st.create_stored_table(spark.createDataFrame(rows, "id long, sentence string, product string, module string, homolog boolean, updated_at long"),
                           path, buckets=4)
    schema = spark.createDataFrame([], ART).schema
    spark.createDataFrame([(100, "new", "p", "m", True, None, 1), (3, "text 3", "p", "m", True, None, 2)], ART).write.parquet(src + "/f1")
    go = lambda: start_stored_stream(spark, src + "/*", schema, path, lambda: spark.createDataFrame([(5,)], "id long"), ck).awaitTermination(120)
    ids = lambda: sorted(r.id for r in st.read_stored_table(spark, path).collect())
    go()
    assert ids() == [i for i in range(20) if i != 5] + [100]
    spark.createDataFrame([(101, "newer", "q", "m", True, '["t"]', 3)], ART).write.parquet(src + "/f2")
    go()
    assert ids() == [i for i in range(20) if i != 5] + [100, 101]
    epochs = spark.read.parquet(path + "/epochs").orderBy("epoch").collect()
    assert [r.epoch for r in epochs] == [-1, 0, 1] and epochs[2].touched == 1
    # a batch whose checkpoint was lost after it was applied is replayed with its number
    assert not st.sync_stored_table(spark, path, spark.createDataFrame([(7, "x", "p", "m", True, None, 9)], ART),
                                    spark.createDataFrame([(6,)], "id long"), epoch=1, remove_missing=False).applied
    assert 6 in ids() and ids().count(7) == 1
