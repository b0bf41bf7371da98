import zlib

import numpy as np

from simtrail.llm import langid, quality, sampling
from simtrail.llm.queries import op4_language, op9_quality


def test_codewords_differ_in_many_bits():
    for k in (2, 3, 4, 5, 6, 40):
        code = langid.codewords(k).astype(int)
        gaps = (code.shape[1] - code @ code.T) // 2
        np.fill_diagonal(gaps, 99)
        assert gaps.min() >= (1 if k == 2 else 2 if k < 5 else 4)
        assert (abs(code.sum(0)) < k).all()  # every bit splits the languages
    assert langid.codewords(1).shape == (1, 1)


def test_language_query_on_held_out_rows(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    rows = op4_language(spark, sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_quality_query_on_held_out_rows(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    rows = op9_quality(spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.9
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_odd_rows_of_both(spark):
    schema = "doc_id long, text string, lang string, score string, quality int"
    good = [(i, f"the house of words number {i} and more of the same", "en", "x", 1) for i in range(30)]
    good += [(100 + i, f"das haus der wörter nummer {i} und noch mehr davon", "de", "x", 0) for i in range(30)]
    odd = [(1, None, "en", "x", 1), (None, "", None, None, None), (None, "123 !!", "de", "x", 7), (5, "the " * 50_000, "en", "x", 1)]
    odd += [good[0], good[0]]
    df = spark.createDataFrame(good + odd, schema)
    got = {(r.doc_id, r.text): r for r in langid.identify(df, df).collect()}
    assert got[1, None].lang_pred == got[None, ""].lang_pred == got[None, "123 !!"].lang_pred == "und"
    assert got[good[0][0], good[0][1]].lang_pred == "en" and got[good[40][0], good[40][1]].lang_pred == "de"
    assert got[5, "the " * 50_000].lang_pred == "en"
    out = quality.score_quality(df, df)
    assert out.count() == len(good + odd) and out.columns == ["doc_id", "text", "lang", "quality", "score", "predicted"]
    scores = {(r.doc_id, r.text): r.score for r in out.collect()}
    assert scores[1, None] == scores[None, ""]
    none = df.limit(0)
    assert langid.identify(df, none).where("lang_pred <> 'und'").count() == 0
    assert {r.score for r in quality.score_quality(df, none).collect()} == {0.5}
    assert langid.identify(none, df).count() == quality.score_quality(none, df).count() == 0


def test_one_language_only(spark):
    df = spark.createDataFrame([(i, f"word {i}", "en") for i in range(8)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.identify(df, df).collect()} == {"en"}


def test_folded_table_equals_mean_embedding():
    sample = [("good words here", 1), ("BAD!! BAD!! BAD!!", 0)] * 20
    model, words = quality.fit(sample), quality.WordBuckets()
    assert model.score(b"good words here", words) > 0.5 > model.score(b"BAD!! BAD!! BAD!!", words)
    table, out, bias = quality.train(sample)
    for text in (b"good words here", b"BAD!! BAD!! BAD!!", b"good BAD!! other", b"x", "é ".encode() * 300, b""):
        rows = np.concatenate([*quality.buckets(text, words), np.empty(0, np.int64)])
        z = (table[rows].astype(float).mean(0) if rows.size else np.zeros(table.shape[1])) @ out + bias
        share = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert abs(model.score(text, words) - share[1]) < 1e-5


def test_a_thousand_languages(spark):
    """Every language is learned, however many there are (the sample stays bounded)."""
    rng = np.random.default_rng(4)
    shapes = ["".join(chr(97 + c) for c in rng.integers(0, 26, 4)) for _ in range(3000)]
    rows = [(4 * k + j, " ".join(rng.choice(shapes[3 * k : 3 * k + 3], 30)), f"l{k}") for k in range(1000) for j in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    texts = df.where("doc_id % 4 <> 3")
    sample = sampling.labelled_sample(texts, texts, "doc_id", "text", "lang", 400, 2500)
    assert len({lang for _, lang in sample}) > 900 and len(sample) <= 2500
    got = langid.identify(df.where("doc_id % 4 = 3"), texts, total=3000).collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.9 and all(0 <= r.score <= 1 for r in got)


def test_labels_without_texts_and_hot_ids(spark):
    """Ids are chosen on the slim labels; a repeated id or label sends no unbounded number of texts."""
    texts = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) AS doc_id", "concat('text ', id) AS text").repartition(4)
    labels = texts.selectExpr("doc_id", "doc_id % 2 AS quality").union(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, quality long"))
    sample = sampling.labelled_sample(texts, labels, "doc_id", "text", "quality", 50, 100)
    assert 0 < len(sample) <= 200 and {y for _, y in sample} == {0, 1}
    plain = sampling.labelled_sample(texts.where("doc_id > 0"), labels, "doc_id", "text", "quality", 10**6, 10**6)
    assert sorted(plain) == sorted((f"text {i}", i % 2) for i in range(3000) if i % 3)
    assert sampling.labelled_sample(texts, labels.limit(0), "doc_id", "text", "quality", 9) == []
