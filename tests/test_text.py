import numpy as np
from pyspark.sql import functions as F

from simtrail.functions import text as tx


def _one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("o")).first().o


def test_normalize_accents_special_chars_stopwords(spark):
    s = F.col("s")
    assert _one(spark, tx.normalize_text(s, []), "férias Ação ß Æ") == "ferias acao ss ae"
    assert _one(spark, tx.normalize_text(s, []), "MP - SIGAEST - MATA330/MATA331 - HELP") == \
        "mp sigaest mata330 mata331 help"
    # stopwords are matched before lower-casing: 'DE' survives, 'de' does not
    assert _one(spark, tx.normalize_text(s, ["de", "ou"]), "Horario de Data ou DE") == "horario data de"
    assert _one(spark, tx.normalize_text(s), None) is None
    assert _one(spark, tx.normalize_text(s), "") == ""


def test_topic_clean_prompt(spark):
    s = F.col("s")
    assert _one(spark, tx.extract_topic(s), "x **Topic A** y **B**") == "Topic A"
    assert _one(spark, tx.extract_topic(s), "no stars") == "no stars"
    assert _one(spark, tx.extract_topic(s), "empty ****") == "empty ****"
    assert _one(spark, tx.clean_output(s), "1. alpha\n2.  beta\n10.gamma") == "alpha beta gamma"
    assert _one(spark, tx.prompt_column("Q: {text}!", s), "it's") == "Q: it's!"


def test_language_by_locale(spark):
    df = spark.createDataFrame([("en-US",), ("ES",), ("pt-BR",), (None,), ("fr",)], "c string")
    got = [(r.o.language, r.o.code) for r in df.select(tx.language_by_locale(F.col("c")).alias("o")).collect()]
    assert got == [("English", "en"), ("Spanish", "es"), ("Brazilian Portuguese", "pt"),
                   ("Brazilian Portuguese", "pt"), ("Brazilian Portuguese", "pt")]


def test_tags_and_json(spark):
    df = spark.createDataFrame([('["a","b"]',), ("",), (None,), ("[not json",)], "t string")
    got = [r.o for r in df.select(tx.parse_tags(F.col("t")).alias("o")).collect()]
    assert got[:3] == [["a", "b"], [], []]
    assert got[3] is None
    j = spark.createDataFrame([('{"k": 3, "when": "2024-01-02"}',)], "j string")
    r = j.select(tx.decode_json(F.col("j"), "k bigint, when string, missing string", rename={"k": "key"}).alias(
        "o")).first().o
    assert (r.key, r.when, r.missing) == (3, "2024-01-02", None)


def test_datetimes(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05",), ("2024-01-02 03:04:05.123456",), ("bad",), (None,)],
                               "t string")
    rows = df.select(tx.parse_datetime(F.col("t")).alias("ts"), tx.parse_date(F.col("t")).alias("d")).collect()
    assert str(rows[0].ts) == "2024-01-02 03:04:05" and str(rows[0].d) == "2024-01-02"
    assert str(rows[1].ts) == "2024-01-02 03:04:05.123456"
    assert rows[2].ts is None and rows[3].ts is None


def test_shrink_long(spark):
    df = spark.createDataFrame([("abcdef", [1, 2, 3], [0.5, 0.25, 1.0], 7)],
                               "s string, a array<int>, sentence_embedding array<double>, n int")
    r = tx.shrink_long(df, 2).first()
    assert (r.s, r.a, r.sentence_embedding, r.n) == ("ab", [1, 2], [0.5, 0.25, 1.0], 7)


def test_sentence_hash(spark):
    import hashlib

    df = spark.createDataFrame([(12, "olá")], "i long, s string")
    got = df.select(tx.sentence_hash(F.col("i"), F.col("s")).alias("h")).first().h
    assert got == hashlib.md5("12olá".encode()).hexdigest()


def test_wrap_text(spark):
    import textwrap

    s = "word " * 30 + "x" * 120 + " tail\nnext line"
    got = _one(spark, tx.wrap_text(F.col("s"), 40), s)
    assert got == textwrap.fill(s, width=40, break_long_words=False, replace_whitespace=False)


def test_hashed_vector_rule(spark):
    import hashlib
    import math

    from simtrail.operators.embed import hashed_vector

    text = "Ação ação, printer; PRINTER de 42"
    toks = tx_tokens = ["acao", "acao", "printer", "printer", "42"]  # 'de' is a default stopword
    counts = [0.0] * 64
    for t in tx_tokens:
        counts[int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 64] += 1
    norm = math.sqrt(sum(c * c for c in counts))
    got = _one(spark, hashed_vector(F.col("s")), text)
    assert [round(x, 12) for x in got] == [round(c / norm, 12) for c in counts]
    assert _one(spark, tx.normalize_text(F.col("s")), text) == " ".join(toks)
    assert _one(spark, hashed_vector(F.col("s")), "!!! ...") is None


def test_ensure_parallelism(spark):
    from simtrail.sources.io import ensure_parallelism

    one = spark.range(10).coalesce(1)
    assert ensure_parallelism(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(100).repartition(6)
    assert ensure_parallelism(many, 4).rdd.getNumPartitions() == 6


def test_iso_dates_with_zones_fractions_and_junk(spark):
    import datetime as dt

    cases = {
        "2024-01-02T03:04:05Z": dt.datetime(2024, 1, 2, 3, 4, 5), "2024-01-02T03:04:05+02:00": dt.datetime(2024, 1, 2, 1, 4, 5),
        "2024-01-02 03:04:05.25": dt.datetime(2024, 1, 2, 3, 4, 5, 250000), "20240102T030405-0330": dt.datetime(2024, 1, 2, 6, 34, 5),
        "20240102": dt.datetime(2024, 1, 2), "2024-01-02": dt.datetime(2024, 1, 2), "2024-01-02T03:04": dt.datetime(2024, 1, 2, 3, 4),
        "2024-01-02junk": None, "2024-13-02": None, "": None, "2024-01-02T03:04:05.123456789+01": dt.datetime(2024, 1, 2, 2, 4, 5, 123456),
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "s string")
    got = {r.s: r for r in df.select("s", tx.parse_datetime(F.col("s")).alias("t"), tx.parse_date(F.col("s")).alias("d")).collect()}
    for k, want in cases.items():
        assert got[k].t == want, k
        assert (got[k].d is None) == (want is None)
    assert got[None].t is None and got["20240102T030405-0330"].d == dt.date(2024, 1, 2)


def test_hashed_vectors_of_any_length(spark):
    import hashlib
    import math

    from simtrail.operators.embed import hashed_vector

    text = " ".join(f"tok{i % 40}" for i in range(90))
    df = spark.createDataFrame([(text,)], "s string")
    for dim in (64, 384, 1000):
        got = df.select(hashed_vector(F.col("s"), dim).alias("v")).first().v
        want = [0.0] * dim
        for t in text.split():
            want[int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % dim] += 1
        norm = math.sqrt(sum(x * x for x in want))
        assert max(abs(a - b / norm) for a, b in zip(got, want, strict=True)) < 1e-12, dim


def test_remembered_tokens_are_bounded_and_right(monkeypatch):
    import hashlib

    from simtrail.operators import embed as em

    monkeypatch.setattr(em, "REMEMBERED_TOKENS", 50)
    buckets = em._Buckets(64, ["de"])
    for i in range(400):
        text = f"Ação de w{i} w{i % 7}, É"
        want = np.zeros(64)
        for token in ("acao", f"w{i}", f"w{i % 7}", "e"):
            want[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 64] += 1
        assert (em._counts(text, buckets) == want).all()
        assert len(buckets) <= 50 and len(buckets.older) <= 50
    assert em._counts("de", buckets) is None and em._counts("", buckets) is None and em._counts(None, buckets) is None
