import pytest
from pyspark.sql import functions as F

from simtrail.operators import skew
from simtrail.operators import summarize as sm
from simtrail.operators.embed import batch_encoder, embed_unique


def hot(spark, n=6000):
    """A third of the rows share one key, a tenth another; some keys are null."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, "warm").when(F.col("id") % 97 == 2, None)
    return spark.range(n).select("id", key.otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("key")).repartition(5)


def test_heavy_keys_are_found(spark):
    rows = hot(spark)
    hashes = {r.h: r.key for r in spark.createDataFrame([("hot",), ("warm",)], "key string").select("key", F.xxhash64("key").alias("h")).collect()}
    found = skew.heavy_keys(rows, F.col("key"), least=300)
    assert {hashes[h]: n for h, n in found} == {"hot": 2000, "warm": rows.where("key = 'warm'").count()}
    assert skew.heavy_keys(rows, F.col("key"), least=10**6) == [] and skew.heavy_keys(rows.limit(0), F.col("key"), 1) == []


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("least", [100, 10**6])
def test_lookup_join_equals_a_plain_join(spark, how, least):
    rows = hot(spark)
    table = rows.where("key is not null and key <> 'k7'").groupBy("key").agg(F.max("id").alias("top"))
    got = skew.lookup_join(rows, table, "key", ["id"], how, least)
    assert got.columns == ["id", "key", "top"]
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(table, "key", how).select("id", "key", "top").collect()))


def test_rows_of_a_hot_key_go_to_many_tasks(spark):
    rows = hot(spark)
    heavy = skew.heavy_keys(rows, F.col("key"), 100)
    own, copies = skew.salted(F.xxhash64("key"), F.xxhash64("id"), heavy, 100)
    dealt = rows.withColumn("s", own).groupBy("key", "s").count()
    assert dealt.agg(F.max("count")).first()[0] < 200  # of 2,000
    assert dealt.where("key = 'hot'").count() == 20 and dealt.where("key = 'k8'").count() == 1
    assert rows.where("key = 'hot'").limit(1).select(F.size(copies)).first()[0] == 20


def test_hot_text_is_encoded_once_and_found_everywhere(spark):
    rows = hot(spark, 900).withColumnRenamed("key", "sentence")
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def model(texts):
            calls.add(len(texts))
            return [[float(len(t)), 1.0] for t in texts]

        return model

    out = embed_unique(rows, "sentence", batch_encoder(factory), hot_rows=50).cache()
    got = out.collect()
    assert len(got) == 900 and all((r.sentence_embedding is None) == (r.sentence is None) for r in got)
    assert all(r.sentence is None or r.sentence_embedding == [float(len(r.sentence)), 1.0] for r in got)
    assert calls.value == rows.select("sentence").where("sentence is not null").distinct().count()


def test_keywords_with_a_hot_token(spark):
    t = spark.range(300).select(F.col("id").alias("ticket_id"), F.concat(F.lit("common alpha"), F.col("id").cast("string"), F.lit(" common b"),
                                                                        (F.col("id") % 7).cast("string")).alias("ticket_comment"))
    plain = {tuple(r) for r in sm.ticket_keywords(t, n=2).collect()}
    assert {tuple(r) for r in sm.ticket_keywords(t, n=2, hot_rows=20).collect()} == plain and len(plain) == 300
