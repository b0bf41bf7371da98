import datetime as dt

from pyspark.sql import functions as F

from simtrail.operators import base as bs

SCHEMA = ("ticket_id long, ticket_comment string, subject string, module_name string, product_name string, "
          "ticket_status string, created_at timestamp_ntz, updated_at timestamp_ntz, comment_created_at timestamp_ntz")


def test_ticket_base_order_and_first_comment(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [
        (1, "b", "s1", "m", "p", "open", t0, t0, t0 + dt.timedelta(minutes=1)),
        (1, "a", "s2", "m", "p", "closed", t0, t0 + dt.timedelta(hours=2), t0 + dt.timedelta(minutes=1)),
        (1, "z", "s0", "m", "p", "open", t0, t0, t0),
        (2, "only", "x", "m", "p", "open", t0, t0, None),
        (2, None, "x", "m", "p", "open", t0, t0, t0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    b = {r.ticket_id: r for r in bs.ticket_base(df).collect()}
    assert b[1].ticket_comment == "z╡a╡b"  # by time, ties by text
    assert b[1].first_comment == "z" and b[1].subject == "s2" and b[1].ticket_status == "open"
    assert b[1].updated_at == t0 + dt.timedelta(hours=2)
    assert b[2].first_comment == "only"  # NULL time sorts first
    assert b[2].ticket_comment == "only"  # NULL comments skipped
    assert b[1].summary is None and b[1].sentence_embedding is None


def test_fan_out_hashes(spark):
    import hashlib

    df = spark.createDataFrame([(5, "c1╡c2", "subj", "sum", "c1")],
                               "ticket_id long, ticket_comment string, subject string, summary string, "
                               "first_comment string")
    rows = {r.sentence_source: r for r in bs.fan_out_sources(df).collect()}
    assert list(rows) == ["ticket_comment", "subject", "summary", "first_comment"]
    assert rows["subject"].ticket_sentence_hash == hashlib.md5(b"5subj").hexdigest()
    assert rows["first_comment"].ticket_sentence_hash == hashlib.md5(b"5c1sum").hexdigest()


def test_dedup_keep_first_and_min(spark):
    df = spark.createDataFrame([("p", "m", True, 2), ("p", "m", False, 1), ("q", "m", None, 1)],
                               "product string, module string, homolog boolean, ord int")
    a = sorted(bs.dedup_keep_first(df, ["product", "module"], [F.col("ord")]).collect())
    b = sorted(bs.dedup_keep_min(df, ["product", "module"], ["ord"]).collect())
    assert a == b and len(a) == 2
    assert [r.homolog for r in a if r.product == "p"] == [False]


def test_hot_ticket_is_joined_slice_by_slice(spark):
    """A third of all comments in one ticket; both ways of joining agree, and only joined slices meet in one task."""
    day = "timestamp_ntz'2024-03-31 00:00:00'"
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400 + 10).alias("ticket_id"),
        F.when(F.col("id") % 50 == 0, None).otherwise(F.concat(F.lit("c"), F.col("id").cast("string"))).alias("ticket_comment"),
        F.lit("s").alias("subject"), F.lit("m").alias("module_name"), F.lit("p").alias("product_name"),
        (F.col("id") % 5).cast("string").alias("ticket_status"),
        F.expr(f"{day} + make_dt_interval(0, 0, id)").alias("created_at"),
        F.expr(f"{day} + make_dt_interval(0, 0, id % 77)").alias("updated_at"),
        F.expr(f"if(id % 41 = 0, null, {day} + make_dt_interval(0, 0, (id * 7919) % 3000, 0))").alias("comment_created_at"),
    ).repartition(6)
    two, one = bs.ticket_base(rows), bs.ticket_base(rows, time_slice=None)
    assert two.schema == one.schema
    assert {tuple(r) for r in two.collect()} == {tuple(r) for r in one.collect()}
    hot = rows.where("ticket_id = 7").groupBy(F.date_trunc("hour", "comment_created_at")).count()
    most = hot.agg(F.max("count")).first()[0]
    assert hot.count() > 40 and most < 150  # of 3,000
    assert "_slice" in two._jdf.queryExecution().optimizedPlan().toString()


def test_ticket_without_comments_or_times(spark):
    schema = ("ticket_id long, ticket_comment string, subject string, module_name string, product_name string, ticket_status string, "
              "created_at timestamp_ntz, updated_at timestamp_ntz, comment_created_at timestamp_ntz")
    df = spark.createDataFrame([(1, None, None, None, None, None, None, None, None), (2, "b", "s", "m", "p", "o", None, None, None),
                                (2, "a", "t", "m", "p", "o", None, None, None)], schema)
    got = {r.ticket_id: (r.ticket_comment, r.subject, r.first_comment) for r in bs.ticket_base(df).collect()}
    assert got == {1: (None, None, None), 2: ("a" + bs.COMMENT_SEP + "b", "t", "a")}
    assert bs.ticket_base(df.limit(0)).count() == 0
