import pytest
from pyspark.sql import functions as F

from simtrail.operators import evaluate as ev
from simtrail.operators.search import FilterSpec
from simtrail.sources import fixtures as fx


def test_parse_expected_edge_cases(spark):
    df = spark.createDataFrame([("1, x,,22",), ("",), (None,), (" 7 ,\t8",)], "e string")
    rows = df.select(ev.parse_expected_ids(F.col("e")).alias("ids"),
                     ev.num_expected_ids(F.col("e")).alias("n"),
                     ev.num_expected_ids(F.col("e"), strict=True).alias("ns")).collect()
    assert [r.ids for r in rows] == [[1, 22], [], [], [7, 8]]
    assert [r.n for r in rows] == [4, 0, 0, 2]
    assert [r.ns for r in rows] == [2, 0, 0, 2]


def test_hit_marker_null_expected(spark):
    df = spark.createDataFrame([(1, None), (22, "1, x,,22"), (3, "1")], "t long, e string")
    assert [r.h for r in df.select(ev.hit_marker(F.col("t"), F.col("e")).alias("h")).collect()] == [0, 1, 0]


def _results(spark):
    rows = [  # target, ticket, score, rank, expected, sentence
        (1, 10, 0.9, 1, "11, 12", "s1"), (1, 11, 0.8, 2, "11, 12", "s1"), (1, 13, 0.7, 3, "11, 12", "s1"),
        (2, 20, 0.9, 1, "", "s2"), (2, 21, 0.5, 2, "", "s2"),
        (3, 11, 0.9, 1, "11, 99", "s3"),
    ]
    df = spark.createDataFrame(rows, "target long, ticket_id long, score double, rank long, expected_id string, "
                                     "sentence string")
    return df.withColumn("hit", ev.hit_marker(F.col("ticket_id"), F.col("expected_id"))).withColumn(
        "num_expected_ids", ev.num_expected_ids(F.col("expected_id")))


def test_hit_rate_and_recall(spark):
    r = _results(spark)
    hr = {x.k: x.hit_rate for x in ev.hit_rate_at_k(r, [1, 3]).collect()}
    assert hr == {1: round(1 / 3, 6), 3: round(2 / 3, 6)}
    rc = {x.k: x.recall for x in ev.recall_at_k(r, [1, 3]).collect()}
    # k=1: t1 0/1, t2 0 (0/0), t3 1/1 -> 1/3; k=3: t1 1/min(3,2), t2 0, t3 1/min(1,2) -> 1.5/3
    assert rc == {1: round(1 / 3, 6), 3: 0.5}


def test_found_not_found_global_and_target(spark):
    r = _results(spark)
    g = {x.target: (x.found, x.not_found, x.accuracy) for x in ev.found_not_found(r).collect()}
    assert g[1] == (1, 1, 0.5) and g[2] == (0, 0, 0.0) and g[3] == (1, 1, 0.5)
    t = {x.target: (x.found, x.not_found) for x in ev.found_not_found(r, scope="target").collect()}
    assert t[1] == (1, 1) and t[3] == (1, 1)


def test_rank_flags_and_top1(spark):
    r = _results(spark)
    f = ev.rank_flags(r).where("target = 1").orderBy("rank").collect()
    assert [(x.top_1, x.top_2, x.top_3) for x in f] == [(True, False, False), (False, True, False),
                                                        (False, False, True)]
    freq = {x.top_1: x.n for x in ev.top1_frequency(r).collect()}
    assert freq == {False: 2, True: 1}


def test_duplicate_judgments_rejected(spark):
    q = spark.createDataFrame([(1, "a"), (1, "b")], "ticket_id long, expected_id string")
    with pytest.raises(ValueError):
        ev.check_unique_targets(q)


def test_several_query_rows_per_target_attach_once(spark):
    from simtrail.plans.evaluation import batch_similarity, query_set

    corpus = spark.createDataFrame([
        (1, "subject", "p", "m", "s1", [1.0, 0.0]), (1, "summary", "p", "m", "u1", [0.0, 1.0]),
        (2, "subject", "p", "m", "s2", [1.0, 0.1]), (3, "subject", "p", "m", "s3", [0.1, 1.0]),
    ], "ticket_id long, sentence_source string, product string, module string, sentence string, "
       "sentence_embedding array<float>")
    judg = spark.createDataFrame([(1, "3")], "ticket_id long, expected_id string")
    q = query_set(corpus, judg, kind="summary", sentence_source=None)
    assert q.count() == 2
    res = batch_similarity(q, corpus, k=5)
    rows = res.orderBy("rank").collect()
    assert [(r.ticket_id, r.hit) for r in rows] == [(2, 0), (3, 1)] or [(r.ticket_id, r.hit) for r in rows] == [
        (3, 1), (2, 0)]
    assert len(rows) == 2 and {r.sentence for r in rows} == {"s1"}
    dup = spark.createDataFrame([(1, "3"), (1, "2")], "ticket_id long, expected_id string")
    with pytest.raises(ValueError):
        query_set(corpus, dup, kind="summary", sentence_source=None)


def test_every_query_row_has_its_own_list(spark):
    from simtrail.plans.evaluation import batch_similarity, metrics, query_set

    corpus = spark.createDataFrame([
        (1, "subject", "p", "m", "s1", [1.0, 0.0]), (1, "summary", "p", "m", "u1", [0.0, 1.0]),
        (2, "subject", "p", "m", "s2", [1.0, 0.1]), (3, "subject", "p", "m", "s3", [0.3, 1.0]),
        (4, "subject", "p", "m", "s4", [1.0, 0.9]),
    ], "ticket_id long, sentence_source string, product string, module string, sentence string, "
       "sentence_embedding array<float>")
    judg = spark.createDataFrame([(1, "3, 4")], "ticket_id long, expected_id string")
    q = query_set(corpus, judg, kind="summary", sentence_source=None)
    res = batch_similarity(q, corpus, k=2, query_row="sentence_source")
    got = [(r.query_row, r.row_rank, r.ticket_id, r.sentence, r.hit_sentence, r.hit) for r in
           res.orderBy("query_row", "row_rank").collect()]
    assert got == [("subject", 1, 2, "s1", "s2", 0), ("subject", 2, 4, "s1", "s4", 1),
                   ("summary", 1, 3, "u1", "s3", 1), ("summary", 2, 4, "u1", "s4", 1)]
    assert [(r.ticket_id, r.query_row) for r in res.orderBy("rank").collect()] == [
        (2, "subject"), (3, "summary"), (4, "subject"), (4, "summary")]
    assert {r.k: (r.hit_rate, r.recall) for r in metrics(res, [1, 4]).collect()} == {1: (0.0, 0.0), 4: (1.0, 1.5)}
    blocks = batch_similarity(q, corpus.repartition(3), k=2, filters=FilterSpec(use_product=True), query_row="sentence_source")
    assert sorted(blocks.collect()) == sorted(res.collect())
    twice = q.unionByName(q)
    with pytest.raises(ValueError, match="repeats"):
        batch_similarity(twice, corpus, k=2, query_row="sentence_source")
    none = batch_similarity(q.limit(0), corpus, k=2, query_row="sentence_source")
    assert none.columns == res.columns and none.count() == 0


@pytest.mark.parametrize("name", ["vector_topk_cosine", "vector_topk_l2", "vector_topk_inner", "search_interactive", "rank_flags"])
def test_judged_by_label_across_hundreds_of_ids(spark, tmp_path, name):
    """Ticket 0 shares its label with ticket 250 only, 5 with none, 10 with 11 and 300: targets are 0, 10, 250 and 300."""
    from simtrail.plans.queries import REGISTRY

    labels = {0: 1, 250: 1, 5: 2, 10: 3, 11: 3, 300: 3}
    rows = [(4 * t + 1, [1.0, 0.1 * i], label) for i, (t, label) in enumerate(labels.items())]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = REGISTRY[name](spark, str(tmp_path))
    assert {r.target for r in found.collect()} == {0, 10, 250, 300}


def test_label_judgments_list_every_other_ticket(spark, tmp_path):
    rows = [(4 * t + 1, [1.0], label) for t, label in [(0, 1), (250, 1), (250, 1), (7, 1), (5, 2), (10, None), (15, None)]]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.ticket_id: r.expected_id for r in fx.label_judgments(spark, str(tmp_path)).collect()}
    assert got == {0: "7, 250, 250", 250: "0, 0, 7, 7"}
