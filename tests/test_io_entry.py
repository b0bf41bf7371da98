import os

import pytest
from pyspark.sql.utils import AnalysisException

from simtrail.sources import io


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", [0.5, 1.0]), (2, "b", [0.25, 0.0])], "id long, s string, v array<double>")
    p = str(tmp_path / "t")
    io.save(df, p, mode="replace")
    io.append(df, p)
    assert io.read_table(spark, p).count() == 4  # sink_append
    io.save(df, p, mode="overwrite")
    assert io.read_table(spark, p).count() == 2  # sink_modes
    with pytest.raises(AnalysisException):
        io.save(df, p, mode="fail")
    io.save(df, p, mode="ignore")
    assert io.read_table(spark, p).count() == 2
    io.truncate(spark, p)  # sink_truncate
    t = io.read_table(spark, p)
    assert t.count() == 0 and t.columns == ["id", "s", "v"]
    c = str(tmp_path / "csv")
    io.write_csv(df, c)  # sink_csv
    back = spark.read.option("header", True).csv(c)
    assert sorted(back.columns) == ["id", "s", "v"] and back.count() == 2
    assert sorted(r.v for r in back.collect()) == ["[0.25,0.0]", "[0.5,1.0]"]
    io.save(df, str(tmp_path / "pp"), partition_by=["s"])
    assert {"s=a", "s=b"} <= set(os.listdir(tmp_path / "pp"))


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    out = e.entry(spark)
    assert out.count() > 0
    assert out.columns == ["target", "ticket_id", "score", "hit_sentence", "rank", "sentence", "expected_id", "hit",
                           "num_expected_ids"]
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) >= 60


def test_read_lines_and_stopwords_file(spark, tmp_path):
    from simtrail.functions.text import load_stopwords

    f = tmp_path / "words.txt"
    f.write_text("de\nda\n\ne/ou\nde\n", encoding="utf-8")
    assert load_stopwords(str(f)) == ["de", "da", "e/ou", "de"]
    lines = io.read_lines(spark, str(f))
    assert [r.value for r in lines.collect()] == ["de", "da", "", "e/ou", "de"]
    assert io.read_lines(spark, str(f), whole=True).count() == 1


def test_metrics_table(spark):
    from pyspark.sql import functions as F

    from simtrail.operators import evaluate as ev
    from simtrail.plans.evaluation import metrics

    rows = [(1, 10, 0.9, 1, "10"), (1, 11, 0.8, 2, "10"), (2, 20, 0.7, 1, "21, 22")]
    r = spark.createDataFrame(rows, "target long, ticket_id long, score double, rank long, expected_id string")
    r = r.withColumn("hit", ev.hit_marker(F.col("ticket_id"), F.col("expected_id"))).withColumn(
        "num_expected_ids", ev.num_expected_ids(F.col("expected_id")))
    m = {x.k: (x.hit_rate, x.recall) for x in metrics(r, [1, 3]).collect()}
    assert m == {1: (0.5, 0.5), 3: (0.5, 0.5)}


@pytest.fixture
def table(spark, tmp_path):
    """A catalog table's name whose files lie in the test's own folder."""
    db = f"t{abs(hash(str(tmp_path))) % 10**9}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path / 'db'}'")
    yield f"{db}.results"
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_catalog_table_modes(spark, table):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, s string")
    rows = lambda: sorted(tuple(r) for r in spark.read.table(table).collect())
    io.save_table(df, table)
    with pytest.raises(AnalysisException):
        io.save_table(df, table, "fail")
    io.save_table(df.select("s", "id"), table, "append")  # by name
    assert rows() == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    with pytest.raises(AnalysisException):
        io.save_table(df.withColumn("more", df.id), table, "append")
    io.save_table(df, table, "ignore")
    assert len(rows()) == 4
    io.save_table(spark.createDataFrame([(9.5,)], "x double"), table, "replace")
    assert rows() == [(9.5,)] and spark.read.table(table).columns == ["x"]
    io.clear_table(spark, table)
    assert rows() == [] and spark.read.table(table).columns == ["x"]
    with pytest.raises(ValueError):
        io.save_table(df, table, "upsert")
    io.save_table(df, table + "_p", "replace", partition_by=["s"])
    io.save_table(df, table + "_q", "append")
    assert spark.read.table(table + "_p").count() == spark.read.table(table + "_q").count() == 2


def test_bound_parameters_are_values(spark):
    df = spark.createDataFrame([(1, "x' OR '1'='1"), (2, "plain"), (3, None)], "id long, s string")
    find = lambda s: [r.id for r in io.select(spark, "SELECT id FROM {t} WHERE s = :s ORDER BY id", {"s": s}, t=df).collect()]
    assert find("x' OR '1'='1") == [1] and find("nothing' OR '1'='1") == [] and find("plain") == [2] and find(None) == []
    ids = io.select(spark, "SELECT count(*) AS n FROM {t} WHERE id IN (:a, :b)", {"a": 1, "b": 3}, t=df).first().n
    assert ids == 2
    with pytest.raises(Exception, match="UNBOUND_SQL_PARAMETER"):
        io.select(spark, "SELECT id FROM {t} WHERE s = :s", {}, t=df).collect()


def test_jdbc_options():
    url = {"url": "jdbc:x"}
    assert io.jdbc_options("public.tickets", url) == url | {"dbtable": "public.tickets"}
    assert io.jdbc_options(" select 1 ", url) == url | {"query": "select 1"}
    assert io.jdbc_options("t", url | {"query": "q"}) == url | {"query": "q"}


def test_judgments_are_checked_and_appended(spark, table):
    from simtrail.plans import judgment_job as jj

    raw = spark.createDataFrame(
        [("1", "2, 3"), (" 2 ", "1"), (None, "9"), ("", "9"), ("x", "9"), ("1.5", "9"), ("99999999999999999999", "9"), ("3", "8"), ("3", "7"),
         ("+3", "7"), ("4", None)], "raw_id string, expected_id string")
    got = {(r.raw_id, r.expected_id): (r.ticket_id, r.problem) for r in jj.parse_judgments(raw).collect()}
    assert got == {("1", "2, 3"): (1, None), (" 2 ", "1"): (2, None), (None, "9"): (None, "no id"), ("", "9"): (None, "no id"),
                   ("x", "9"): (None, "bad id"), ("1.5", "9"): (None, "bad id"), ("99999999999999999999", "9"): (None, "bad id"),
                   ("3", "8"): (3, "judged twice"), ("3", "7"): (3, "judged twice"), ("+3", "7"): (3, None), ("4", None): (4, None)}
    loaded = lambda: sorted((r.ticket_id, r.expected_id) for r in spark.read.table(table).collect() if r.ticket_id != 4)
    with pytest.raises(ValueError):
        jj.load_judgments(raw, table, strict=True)
    assert not spark.catalog.tableExists(table)
    assert jj.load_judgments(raw, table).count() == 7
    assert loaded() == [(1, "2, 3"), (2, "1"), (3, "7")]
    again = spark.createDataFrame([("1", "5"), ("6", "5")], raw.schema)
    assert jj.load_judgments(again, table, strict=True).count() == 0
    assert loaded() == [(1, "2, 3"), (2, "1"), (3, "7"), (6, "5")]


def test_results_are_reloaded(spark, table):
    from simtrail.plans import judgment_job as jj
    from simtrail.plans.queries import REGISTRY

    results = REGISTRY["batch_similarity"](spark, "/root/testdata/sf0.001")
    first = sorted(map(tuple, jj.reload_results(results, table).collect()))
    assert sorted(map(tuple, jj.reload_results(results, table).collect())) == first and len(first) == 3
    stored = spark.read.table(table)
    assert stored.count() == results.count() and {"top_1", "top_2", "top_3"} <= set(stored.columns)


def test_sample_depends_on_rows_and_seed_only(spark):
    from simtrail.plans.feeds import sample_n

    df = spark.range(500).selectExpr("id", "if(id % 9 = 0, null, concat('t', id % 50)) AS s", "id * 0.5 AS x")
    pick = lambda d, seed=3, n=20: {tuple(r) for r in sample_n(d, n, seed).collect()}
    assert pick(df.repartition(1)) == pick(df.repartition(8, "s")) == pick(df.orderBy("x").coalesce(3)) and len(pick(df)) == 20
    assert pick(df, 4) != pick(df)
    halves = sample_n(df.where("id < 250"), 20, 3).union(sample_n(df.where("id >= 250"), 20, 3))
    assert pick(halves) == pick(df)  # samples merge
    assert len(pick(df, n=600)) == 500 and pick(df.limit(0)) == set()


def test_text_search_gives_the_hits_own_columns(spark):
    from simtrail.operators.embed import hashed_encoder
    from simtrail.plans.evaluation import text_search

    rows = [(1, "printer jam paper", "p1", "m1", 10), (2, "printer paper tray", "p1", "m1", 11), (2, "printer jam paper", "p1x", "m9", 12),
            (3, "printer jam paper", "q", "xm1", 13), (4, "printer jam paper", "q", "other", 14), (5, "!!", "p1", "m1", 15)]
    corpus = hashed_encoder()(spark.createDataFrame(rows, "ticket_id long, sentence string, product string, module string, n int"), "sentence",
                              "sentence_embedding")
    asked = spark.createDataFrame([(1, "Printer paper jam", "p1", "m1"), (8, "...", "p1", "m1"), (9, None, "p1", "m1")],
                                  "ticket_id long, query string, product string, module string")
    got = text_search(asked, corpus, k=5, threshold_percent=40, hit_columns=("product", "n"))
    assert got.columns == ["target", "query", "ticket_id", "score", "hit_sentence", "hit_product", "hit_n", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "Printer paper jam", 2, 1.0, "printer jam paper", "p1x", 12, 1),
                                                      (1, "Printer paper jam", 3, 1.0, "printer jam paper", "q", 13, 2)]
    none = text_search(asked.where("ticket_id > 1"), corpus, hit_columns=("product", "n"))
    assert none.columns == got.columns and none.count() == 0
