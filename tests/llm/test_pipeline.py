import corpus_pipeline
import pytest
from test_jaccard import brute


def test_stages_and_run(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    sizes = [docs.count()]
    for name, step in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, step(spark, kept, sf)
        assert kept.columns == docs.columns, name
        sizes.append(kept.count())
        assert sizes[-1] <= sizes[-2]
        if name == "near_duplicates":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            groups = brute(rows, 5, 80)
            assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, g) in groups.items() if i == g)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = {i for i, q in labels.items() if q == 1}
    assert sizes[2] < sizes[0] and len(good & {r.doc_id for r in before.collect()}) > 0.95 * len(good)
    out = corpus_pipeline.run(spark, sf)
    assert out.select("doc_id").distinct().count() == sizes[-1]


def test_near_duplicates_with_odd_rows(spark, sf):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(3, text, "en", "s", 1), (2, text, "en", "t", 1), (2, text, "en", "t", 1), (None, text, None, None, None), (4, None, "en", "s", 0), (5, "", "en", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, df, sf).collect()
    assert sorted(r.doc_id or -1 for r in got) == [-1, 2, 4, 5]
    assert corpus_pipeline.language(spark, df.limit(0), sf).count() == 0
    pieces = corpus_pipeline.packed(spark, df, sf).where("doc_id is null").collect()
    assert sum(r.length for r in pieces) == pieces[0].doc_tokens


def test_one_row_of_each_kept_id(spark):
    import corpus_pipeline

    words = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    a, b = words("a", 30), words("b", 50)
    rows = [(2, a, "x"), (5, a, "x"), (5, b, "x"), (9, b, "x"), (11, "k", "y"), (11, "k", "x"), (11, None, "a"), (12, "m", "x"), (None, "n", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == [(11, "k", "x"), (12, "m", "x"), (2, a, "x"), (None, "n", "x")]


def test_model_stages_send_every_text_once(spark, sf, monkeypatch):
    """Columns are not sent a second time beside themselves, and those that a stage would replace come out as they were."""
    sent = []
    for module, name in ((corpus_pipeline.langid, "identify"), (corpus_pipeline.quality, "score_quality")):
        step = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, *rest, step=step: (sent.append(df), step(df, *rest))[1])
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    docs = docs.withColumns({"Score": docs["doc_id"], "predicted": docs["lang"], "_aside": docs["source"], "ambiguous": docs["doc_id"] + 1})
    rows = {r.doc_id: r for r in docs.collect()}
    for stage in (corpus_pipeline.language, corpus_pipeline.good_quality):
        got = stage(spark, docs, sf)
        assert got.columns == docs.columns and got.dtypes == docs.dtypes
        found = got.collect()
        assert found and all(rows[r.doc_id] == r for r in found)
    assert len(sent) == 2 and all(df.schema.simpleString().count("text:") == 1 for df in sent)


def test_stages_send_texts_in_small_batches(spark):
    """No stage sends thousands of whole texts to a task at once; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.createDataFrame([(1, "a b c d e f", "en")], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    try:
        for given, least in (("10000", "2048"), ("0", "2048"), ("500", "500")):
            for stage in (corpus_pipeline.language, corpus_pipeline.good_quality, corpus_pipeline.packed):
                spark.conf.set(key, given)
                with pytest.MonkeyPatch.context() as patch:
                    patch.setattr(corpus_pipeline, "table", lambda *_: marks)
                    stage(spark, docs, "")
                assert spark.conf.get(key) == least, (stage, given)
    finally:
        spark.conf.set(key, before)
