"""Registered queries: one callable (spark, sf_dir) -> DataFrame per inventory key.

Every query reads the driver tables through :mod:`simtrail.sources.fixtures` and
runs over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simtrail.operators import evaluate as ev
from simtrail.operators.search import FilterSpec, vector_search
from simtrail.plans import evaluation as evp
from simtrail.sources import fixtures as fx

# Candidates kept per query (20) and the metric cut-offs (1, 3, 5; 20 added
# to report the whole list).
K = 20
KS = (1, 3, 5, 20)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


# ---------------------------------------------------------------- sources
@register("src_tickets_scan")
def q_src_tickets_scan(spark, sf):
    return fx.tickets(spark, sf)


# ---------------------------------------------------------------- search + metrics
def _batch(spark, sf, by_label=False, **kw):
    return evp.batch_similarity(fx.query_subject(spark, sf, by_label), fx.corpus(spark, sf), k=K, **kw)


@register("batch_similarity")
def q_batch_similarity(spark, sf):
    return _batch(spark, sf)


@register("batch_similarity_sources")
def q_batch_similarity_sources(spark, sf):
    c = fx.corpus(spark, sf)
    q = evp.query_set(c, fx.judgments(spark, sf), kind="summary", sentence_source=None)  # four rows a ticket
    return evp.batch_similarity(q, c, k=K, query_row="sentence_source")


@register("vector_topk_cosine")
def q_vector_topk_cosine(spark, sf):
    return vector_search(fx.query_subject(spark, sf, by_label=True), fx.corpus(spark, sf), k=K, metric="cosine")


@register("vector_topk_l2")
def q_vector_topk_l2(spark, sf):
    return vector_search(fx.query_subject(spark, sf, by_label=True), fx.corpus(spark, sf), k=K, metric="l2")


@register("vector_topk_inner")
def q_vector_topk_inner(spark, sf):
    return vector_search(fx.query_subject(spark, sf, by_label=True), fx.corpus(spark, sf), k=K, metric="inner")


@register("search_filter_product")
def q_search_filter_product(spark, sf):
    return _batch(spark, sf, filters=FilterSpec(use_product=True))


@register("search_filter_module")
def q_search_filter_module(spark, sf):
    return _batch(spark, sf, filters=FilterSpec(use_product=True, use_module=True))


@register("search_threshold")
def q_search_threshold(spark, sf):
    return _batch(spark, sf, threshold=0.30)


@register("search_interactive")
def q_search_interactive(spark, sf):
    return evp.interactive_search(fx.query_subject(spark, sf, by_label=True), fx.corpus(spark, sf), k=K, threshold_percent=30)


@register("hit_rate_at_k")
def q_hit_rate_at_k(spark, sf):
    return ev.hit_rate_at_k(_batch(spark, sf), KS)


@register("recall_at_k")
def q_recall_at_k(spark, sf):
    return ev.recall_at_k(_batch(spark, sf), KS)


@register("hit_marker")
def q_hit_marker(spark, sf):
    return _batch(spark, sf).select("target", "ticket_id", "hit")


@register("parse_expected_ids")
def q_parse_expected_ids(spark, sf):
    j = fx.judgments(spark, sf)
    return j.select(
        "ticket_id",
        F.array_join(F.transform(ev.parse_expected_ids(F.col("expected_id")), lambda x: x.cast("string")), "|").alias(
            "ids"
        ),
        ev.num_expected_ids(F.col("expected_id")).alias("num_expected_ids"),
        ev.num_expected_ids(F.col("expected_id"), strict=True).alias("num_parsed_ids"),
    )


@register("rank_flags")
def q_rank_flags(spark, sf):
    return ev.rank_flags(_batch(spark, sf, by_label=True)).select("target", "ticket_id", "rank", "top_1", "top_2", "top_3")


@register("found_not_found")
def q_found_not_found(spark, sf):
    return ev.found_not_found(_batch(spark, sf), scope="global")


@register("top1_frequency")
def q_top1_frequency(spark, sf):
    return ev.top1_frequency(_batch(spark, sf))


@register("query_set_fields")
def q_query_set_fields(spark, sf):
    q = evp.query_set(fx.corpus(spark, sf), fx.judgments(spark, sf), kind="fields", sentence_source="subject",
                      sentence_field="sentence")
    return q.select("ticket_id", "sentence", "product", "module", "expected_id",
                    F.size("sentence_embedding").cast("long").alias("dim"))


@register("query_set_summary")
def q_query_set_summary(spark, sf):
    q = evp.query_set(fx.corpus(spark, sf), fx.judgments(spark, sf), kind="summary", sentence_source="summary")
    return q.select("ticket_id", "sentence", "product", "module", "expected_id",
                    F.size("sentence_embedding").cast("long").alias("dim"))


@register("query_set_chunks")
def q_query_set_chunks(spark, sf):
    c = fx.corpus(spark, sf).select(
        "ticket_id", "product", "module",
        F.col("sentence").alias("subject"),
        F.col("sentence_embedding").alias("subject_embedding"),
        (F.col("vec_id") % 4).alias("chunk_index"),
    )
    q = evp.query_set(c, fx.judgments(spark, sf), kind="chunks")
    return q.select("ticket_id", "sentence", "product", "module", "expected_id",
                    F.size("sentence_embedding").cast("long").alias("dim"))


# ---------------------------------------------------------------- ticket base + scalars
from simtrail.functions import text as tx  # noqa: E402
from simtrail.operators import base as bs  # noqa: E402
from simtrail.operators import embed as em  # noqa: E402
from simtrail.operators import sync as sy  # noqa: E402
from simtrail.plans import judgment_job as jj  # noqa: E402
from simtrail.session import stage  # noqa: E402
from simtrail.sources import io  # noqa: E402

BASE_COLS = ["ticket_id", "ticket_comment", "subject", "summary", "ticket_sentence_hash", "module", "product",
             "sentence_source", "ticket_status", "created_at", "updated_at", "first_comment"]


@register("ticket_base")
def q_ticket_base(spark, sf):
    return bs.ticket_base(fx.tickets(spark, sf)).select(*BASE_COLS)


@register("first_comment")
def q_first_comment(spark, sf):
    return bs.first_comment(fx.tickets(spark, sf))


def _docs(spark, sf):
    return fx._t(spark, sf, "documents")


@register("sentence_hash")
def q_sentence_hash(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", tx.sentence_hash(F.col("doc_id"), F.col("text")).alias("sentence_hash"))


@register("extract_topic")
def q_extract_topic(spark, sf):
    return _docs(spark, sf).select("doc_id", tx.extract_topic(F.col("text")).alias("topic"))


@register("clean_output")
def q_clean_output(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", tx.clean_output(F.concat(F.lit("1. "), F.col("text"))).alias("cleaned"))


@register("normalize_text")
def q_normalize_text(spark, sf):
    return _docs(spark, sf).select("doc_id", tx.normalize_text(F.col("text")).alias("normalized"))


@register("language_by_locale")
def q_language_by_locale(spark, sf):
    l_ = fx.locales(spark, sf)
    lang = tx.language_by_locale(F.col("locale_code"))
    return l_.select("doc_id", "locale_code", lang["language"].alias("language"), lang["code"].alias("code"))


@register("parse_tags")
def q_parse_tags(spark, sf):
    a = fx.articles(spark, sf)
    t = tx.parse_tags(F.col("tags"))
    return a.select("id", F.size(t).cast("long").alias("n_tags"), F.array_join(t, "|").alias("tags_joined"))


@register("decode_records")
def q_decode_records(spark, sf):
    e = fx.json_events(spark, sf)
    st = tx.decode_json(F.col("props"), "k BIGINT", rename=None)
    renamed = tx.decode_json(F.col("props"), tx.T.StructType([tx.T.StructField("k", tx.T.LongType())]),
                             rename={"k": "key"})
    mp = tx.decode_json(F.col("props"), "map<string, bigint>")
    return e.select("event_id", st["k"].alias("k"), renamed["key"].alias("key"),
                    mp["k"].alias("map_k"), F.size(mp).cast("long").alias("n_keys"))


@register("decode_nested")
def q_decode_nested(spark, sf):
    e = fx.nested_json(spark, sf)
    layout = "id BIGINT, on DATE, at TIMESTAMP_NTZ, tags ARRAY<STRING>, inner STRUCT<k: BIGINT, note: STRING>, items ARRAY<STRUCT<n: INT>>"
    d = tx.decode_json(F.col("record"), layout, rename={"id": "event_id", "inner": "detail"})
    return e.select(
        d["event_id"].alias("event_id"), d["on"].cast("string").alias("on_day"), d["at"].alias("at_time"),
        F.array_join(d["tags"], "|").alias("tags"), d["detail"]["k"].alias("k"), d["detail"]["note"].alias("note"),
        F.size(d["items"]).cast("long").alias("n_items"),
        F.aggregate(d["items"], F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x["n"], F.lit(0))).alias("items_sum"))


@register("parse_datetimes")
def q_parse_datetimes(spark, sf):
    e = fx.json_events(spark, sf)
    txt = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return e.select("event_id", txt.alias("ts_text"), tx.parse_datetime(txt).alias("parsed_ts"),
                    tx.parse_date(txt).cast("string").alias("parsed_date"))


@register("shrink_long")
def q_shrink_long(spark, sf):
    s = tx.shrink_long(fx.articles(spark, sf), 5000)
    return s.select("id", F.length("sentence").cast("long").alias("sentence_len"),
                    F.md5("sentence").alias("sentence_md5"), "product", "tags")


HOSTILE = "x' OR '1'='1' --"
PROMPT = "Summarise the following support conversation:\n\n{text}\n\nSUMMARY:"


@register("prompt_column")
def q_prompt_column(spark, sf):
    t = fx.tickets(spark, sf).select("ticket_id", "updated_at", tx.prompt_column(PROMPT, F.col("ticket_comment")).alias("prompt"))
    return t.select("ticket_id", "updated_at", F.md5("prompt").alias("prompt_md5"),
                    F.length("prompt").cast("long").alias("prompt_chars"))


@register("select_bound")
def q_select_bound(spark, sf):
    """A2: bound values, one of them written like an injection."""
    return io.select(
        spark,
        "SELECT ticket_id, subject, module_name, updated_at FROM {tickets} "
        "WHERE module_name = :module AND ticket_status <> :status AND ticket_id >= :least",
        {"module": "mod1", "status": HOSTILE, "least": 10},
        tickets=fx.tickets(spark, sf),
    )


@register("dedup_keep_first")
def q_dedup_keep_first(spark, sf):
    return bs.dedup_keep_first(fx.catalogue(spark, sf), ["product", "module"], [F.col("ord").asc()])


@register("judgments_load")
def q_judgments_load(spark, sf):
    loaded = jj.parse_judgments(fx.judgments_text(spark, sf))
    return loaded.select("raw_id", "ticket_id", "expected_id", "problem")


@register("per_product_counts")
def q_per_product_counts(spark, sf):
    return sy.per_product_counts(fx.articles(spark, sf))


# ---------------------------------------------------------------- article sync
def _md5(c="sentence"):
    return F.md5(F.col(c)).alias("sentence_md5")


def _incoming(spark, sf):
    df = sy.filter_deleted(fx.articles(spark, sf), fx.deleted(spark, sf))
    return tx.ensure_tags(sy.fill_missing(df))


@register("sync_filter_deleted")
def q_sync_filter_deleted(spark, sf):
    return sy.filter_deleted(fx.articles(spark, sf), fx.deleted(spark, sf)).select("id", "product")


@register("fill_missing")
def q_fill_missing(spark, sf):
    f = sy.fill_missing(fx.articles(spark, sf))
    return f.select("id", F.length("sentence").cast("long").alias("sentence_len"), "tags", "homolog")


@register("fill_missing_dropped")
def q_fill_missing_dropped(spark, sf):
    f = sy.fill_missing(fx.articles(spark, sf), drop_missing_first=True)
    return f.select("id", F.length("sentence").cast("long").alias("sentence_len"), "tags", "homolog")


@register("sync_diff")
def q_sync_diff(spark, sf):
    d = sy.sync_diff(_incoming(spark, sf), fx.existing(spark, sf))
    return d.select("id", _md5(), F.col("_merge").alias("merge_status"))


def _plan(spark, sf):
    return sy.prepare_sync(fx.articles(spark, sf), fx.existing(spark, sf), fx.deleted(spark, sf))


@register("sync_watermark")
def q_sync_watermark(spark, sf):
    return _plan(spark, sf).watermark


@register("insert_if_absent")
def q_insert_if_absent(spark, sf):
    return sy.insert_if_absent(fx.vector_table(spark, sf), _plan(spark, sf).new_rows).select("id", _md5())


@register("delete_by_id")
def q_delete_by_id(spark, sf):
    return sy.delete_by_id(fx.vector_table(spark, sf), fx.deleted(spark, sf)).select("id", _md5())


@register("delete_by_pair")
def q_delete_by_pair(spark, sf):
    return sy.delete_by_pair(fx.vector_table(spark, sf), _plan(spark, sf).removed).select("id", _md5())


@register("flag_sync")
def q_flag_sync(spark, sf):
    return sy.flag_sync(fx.vector_table(spark, sf), fx.catalogue(spark, sf)).select("id", "product", "module",
                                                                                     "homolog")


def _vector_digest(col="sentence_embedding"):
    """Length, sum and place-weighted sum of a vector (NULL for NULL)."""
    v = F.col(col)
    total = lambda x: F.round(F.aggregate(x, F.lit(0.0), lambda a, y: a + y), 6)
    return [F.when(v.isNotNull(), F.size(v)).alias("dim"), total(v).alias("vsum"),
            total(F.transform(v, lambda x, i: x * (i + 1))).alias("vplace")]


def _synced(t):
    return t.select("id", _md5(), "product", "module", "homolog", "updated_at",
                    F.array_join("tags", "|").alias("tags"), *_vector_digest())


@register("sync_apply")
def q_sync_apply(spark, sf):
    return _synced(
        sy.apply_sync(fx.vector_table(spark, sf), _plan(spark, sf), fx.deleted(spark, sf), fx.catalogue(spark, sf)))


@register("sync_buckets")
def q_sync_buckets(spark, sf):
    """The same sync on a stored table: only the buckets that change are rewritten."""
    from simtrail.plans import stored_sync as st
    from simtrail.session import new_stage_dir

    path = new_stage_dir(spark, "sync-table")
    st.create_stored_table(fx.vector_table(spark, sf), path)
    st.sync_stored_table(spark, path, fx.articles(spark, sf), fx.deleted(spark, sf), fx.catalogue(spark, sf))
    return _synced(st.read_stored_table(spark, path))


@register("embed_hashed")
def q_embed_hashed(spark, sf):
    d = _docs(spark, sf).select("doc_id", em.hashed_vector(F.col("text")).alias("v"))
    # *_outer generators: the plain ones make Spark infer size(v) > 0 and push the whole
    # expression below the exchange into the scan task
    return d.select("doc_id", F.posexplode_outer("v").alias("dim", "value")).where(F.col("value") > 0).select(
        "doc_id", F.col("dim").cast("long").alias("dim"), F.round("value", 6).alias("value"))


@register("embed_unique")
def q_embed_unique(spark, sf):
    d = _docs(spark, sf).select("doc_id", F.col("text").alias("sentence"))
    e = em.embed_unique(d, "sentence", em.hashed_encoder())
    return e.select(
        "doc_id",
        F.size(F.filter("sentence_embedding", lambda x: x > 0)).cast("long").alias("n_dims"),
        F.round(F.aggregate("sentence_embedding", F.lit(0.0), lambda a, x: a + x), 6).alias("vsum"),
    )


# ---------------------------------------------------------------- text jobs
from simtrail.operators import chunk as ch  # noqa: E402
from simtrail.operators import summarize as sm  # noqa: E402
from simtrail.plans import feeds  # noqa: E402


def _base(spark, sf):
    return bs.ticket_base(fx.tickets(spark, sf))


@register("summary_pieces")
def q_summary_pieces(spark, sf):
    d = _docs(spark, sf)
    p = d.select("doc_id", F.posexplode_outer(ch.summary_pieces(F.col("text"), separator="\n", size=500, overlap=100)).alias(
        "piece_no", "piece")).where(F.col("piece").isNotNull())
    return p.select("doc_id", F.col("piece_no").cast("long").alias("piece_no"), F.md5("piece").alias("piece_md5"),
                    F.length("piece").cast("long").alias("piece_len"))


# Pieces of the text queries: about a paragraph or two, so that most texts have several; and characters of the partial
# summaries that need no merging, so that most tickets take two rounds.
PIECES = {"size": 600, "overlap": 120}
REDUCE = 400
SUMMARY = {"budget": REDUCE, **PIECES}


@register("split_pieces")
def q_split_pieces(spark, sf):
    d = _docs(spark, sf)
    p = d.select("doc_id", F.posexplode_outer(ch.split_pieces(fx.paragraphs(F.col("text")), **PIECES)).alias(
        "piece_no", "piece")).where(F.col("piece").isNotNull())
    return p.select("doc_id", F.col("piece_no").cast("long").alias("piece_no"), F.length("piece").cast("long").alias("piece_len"),
                    F.md5("piece").alias("piece_md5"))


@register("chunk_windows")
def q_chunk_windows(spark, sf):
    c = fx.chunks_source(spark, sf)
    w = c.select("ticket_id", F.posexplode_outer(ch.chunk_windows(F.col("ticket_comment"))).alias(
        "chunk_index", "chunk")).where(F.col("chunk").isNotNull())
    return w.select("ticket_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.md5("chunk").alias("chunk_md5"),
                    F.size(F.split("chunk", " ")).cast("long").alias("n_tokens"))


@register("chunk_recursive")
def q_chunk_recursive(spark, sf):
    c = ch.recursive_chunks(fx.chunks_source(spark, sf), "ticket_comment")
    return c.select("ticket_id", F.posexplode("chunks").alias("chunk_index", "chunk")).select(
        "ticket_id", "chunk_index", F.length("chunk").alias("chunk_len"))


@register("profile")
def q_profile(spark, sf):
    c = fx.chunks_source(spark, sf).select("ticket_id", ch.chunk_windows(F.col("ticket_comment")).alias("chunks"))
    return c.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.size("chunks")).cast("long").alias("n_chunks"),
                 F.lit(len(c.columns)).cast("long").alias("n_columns"))


@register("summarize_stuff")
def q_summarize_stuff(spark, sf):
    return sm.summarize_stuff(_base(spark, sf))


@register("summarize_map_reduce")
def q_summarize_map_reduce(spark, sf):
    return sm.summarize_map_reduce(_base(spark, sf), **SUMMARY)


@register("summarize_refine")
def q_summarize_refine(spark, sf):
    return sm.summarize_refine(_base(spark, sf), **PIECES)


@register("ticket_topic")
def q_ticket_topic(spark, sf):
    return sm.ticket_topic(_base(spark, sf))


@register("ticket_keywords")
def q_ticket_keywords(spark, sf):
    return sm.ticket_keywords(_base(spark, sf))


@register("union_sources")
def q_union_sources(spark, sf):
    return feeds.summary_sources(_base(spark, sf)).select(
        "ticket_id", "sentence_source", "sentence", "ticket_sentence_hash")


@register("fan_out_sources")
def q_fan_out_sources(spark, sf):
    f = feeds.four_sources(_base(spark, sf), SUMMARY)
    return f.select("ticket_id", "sentence_source", F.md5("sentence").alias("sentence_md5"), "ticket_sentence_hash")


@register("feed_summary")
def q_feed_summary(spark, sf):
    return feeds.feed_summary(_base(spark, sf)).select(
        "ticket_id", "sentence_source", "ticket_sentence_hash", *_vector_digest())


@register("feed_chunks")
def q_feed_chunks(spark, sf):
    return feeds.feed_chunks(_base(spark, sf)).select(
        "ticket_id", "chunk_index", "ticket_chunk_hash", F.size("sentence_embedding").alias("dim"),
        F.size("subject_embedding").alias("subject_dim"))


@register("ingest_four_sources")
def q_ingest_four_sources(spark, sf):
    return feeds.ingest_four_sources(_base(spark, sf), summary=SUMMARY).select(
        "ticket_id", "sentence_source", "ticket_sentence_hash", *_vector_digest())


@register("sample_n")
def q_sample_n(spark, sf):
    sample = feeds.sample_n(fx.tickets(spark, sf), 5, seed=7, columns=["ticket_id", "ticket_status", "ticket_comment"])
    return sample.select("ticket_id", "ticket_status", F.md5("ticket_comment").alias("comment_md5"))


@register("vector_topk_ivf")
def q_vector_topk_ivf(spark, sf):
    from simtrail.operators.search import build_ivf

    idx = build_ivf(fx.corpus(spark, sf), n_lists=8, seed=3)
    # nprobe is measured, see enough_lists
    return vector_search(fx.query_subject(spark, sf, by_label=True), idx.corpus, k=K, ivf=idx)


@register("vector_topk_ivf_all")
def q_vector_topk_ivf_all(spark, sf):
    """The stored index with every list probed: the exact result by way of the index."""
    from simtrail.operators.search import build_ivf, store_ivf
    from simtrail.session import new_stage_dir

    idx = store_ivf(build_ivf(fx.corpus(spark, sf), n_lists=8, seed=3), new_stage_dir(spark, "ivf"))
    return vector_search(fx.query_subject(spark, sf), idx.corpus, k=K, ivf=idx, nprobe=8)


@register("search_text")
def q_search_text(spark, sf):
    """Texts encoded and searched in one call; every hit with its own columns."""
    texts = fx.chunks_source(spark, sf).withColumnRenamed("ticket_comment", "sentence")
    # few documents are copies: encoding them again is cheaper than a shuffle of all texts to find them
    c = stage(em.hashed_encoder()(texts, "sentence", "sentence_embedding"), "search-corpus")
    # a threshold that no cosine of two short count vectors equals (0.5 is one: the engines' last digits would decide)
    f = evp.text_search(fx.text_queries(spark, sf), c, k=K, threshold_percent=51.7)
    return f.withColumn("hit_md5", F.md5("hit_sentence")).drop("hit_sentence")


def _rejoined(chunks, text):
    """Per ticket: chunks, words, most words of a chunk, and a digest of all words in order."""
    words = F.array_remove(F.split(F.col(text), r"\s+"), "")
    per = chunks.select("ticket_id", "chunk_index", F.array_join(words, " ").alias("w"), F.size(words).alias("n"))
    joined = F.expr("listagg(w, ' ') WITHIN GROUP (ORDER BY chunk_index)")
    return per.groupBy("ticket_id").agg(
        F.sum("n").cast("long").alias("n_words"), (F.max("n") <= ch.CHUNK_TOKENS).alias("within_budget"), F.md5(joined).alias("words_md5"))


@register("chunk_recursive_rejoin")
def q_chunk_recursive_rejoin(spark, sf):
    c = ch.recursive_chunks(fx.chunks_source(spark, sf).select("ticket_id", "ticket_comment"), "ticket_comment")
    return _rejoined(c.select("ticket_id", F.posexplode("chunks").alias("chunk_index", "chunk")), "chunk")


@register("feed_chunks_rejoin")
def q_feed_chunks_rejoin(spark, sf):
    return _rejoined(feeds.feed_chunks(_base(spark, sf)), "chunk")
