"""Ingest jobs (K2–K4): derive texts per ticket, encode distinct texts once, hash, and
produce the rows of the ticket vector tables (ready for an append / insert-if-absent)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simtrail.functions.text import sentence_hash
from simtrail.operators import summarize as sm
from simtrail.operators.base import fan_out_sources
from simtrail.operators.chunk import recursive_chunks
from simtrail.operators.embed import Encoder, embed_unique, hashed_encoder
from simtrail.session import stage

# Between the values of a sampled row, and in place of NULL.
SAMPLE_SEPARATOR, SAMPLE_NULL = "\x1f", "\u2400"
TICKET_ATTRS = ["ticket_id", "module", "product", "ticket_status", "created_at", "updated_at"]


def summary_sources(base: DataFrame) -> DataFrame:
    """G1: three derived texts per ticket (central topic, keywords, subject) as one frame."""
    topic = sm.ticket_topic(base).select("ticket_id", F.lit("summary").alias("sentence_source"),
                                         F.col("topic").alias("sentence"))
    kw = sm.ticket_keywords(base).select("ticket_id", F.lit("keywords").alias("sentence_source"),
                                         F.col("keywords").alias("sentence"))
    subj = base.select("ticket_id", F.lit("subject").alias("sentence_source"), F.col("subject").alias("sentence"))
    u = topic.unionByName(kw).unionByName(subj)
    return u.withColumn("ticket_sentence_hash", sentence_hash(F.col("ticket_id"), F.col("sentence")))


def four_sources(base: DataFrame, summary: dict | None = None) -> DataFrame:
    """G3 with the map-reduce summary (I3, its parameters in ``summary``): ticket_comment, subject, summary, first_comment."""
    summ = sm.summarize_map_reduce(base, **(summary or {}))
    b = base.drop("summary").join(summ, "ticket_id", "left")
    return fan_out_sources(b)


def feed_summary(base: DataFrame, encoder: Encoder | None = None) -> DataFrame:
    """K3: summary/keywords/subject rows with vectors (distinct texts encoded once)."""
    base = stage(base, "feed-base")  # read by four branches
    texts = stage(summary_sources(base), "feed-texts")
    rows = texts.join(base.select(*TICKET_ATTRS, "ticket_comment"), "ticket_id")
    return embed_unique(rows, "sentence", encoder or hashed_encoder())


def feed_chunks(base: DataFrame, encoder: Encoder | None = None, budget: int = 512) -> DataFrame:
    """K4: one row per chunk of the joined comments, with chunk hash, chunk vector, and the
    ticket subject with its vector (what the chunk query set reads)."""
    enc = encoder or hashed_encoder()
    base = stage(base, "feed-base")
    c = recursive_chunks(base.select("ticket_id", "ticket_comment"), "ticket_comment", budget=budget)
    rows = c.select("ticket_id", F.posexplode_outer("chunks").alias("chunk_index", "chunk")).where(F.col("chunk").isNotNull())
    rows = stage(rows.withColumn("ticket_chunk_hash", sentence_hash(F.col("ticket_id"), F.col("chunk"))), "feed-chunks")
    rows = embed_unique(rows, "chunk", enc, "sentence_embedding")
    # the ticket's own columns, the whole text among them, come after the chunks are encoded; its subject is encoded once
    own = embed_unique(base.select(*TICKET_ATTRS, "subject", "ticket_comment"), "subject", enc, "subject_embedding")
    return rows.join(own, "ticket_id")


def ingest_four_sources(base: DataFrame, encoder: Encoder | None = None, summary: dict | None = None) -> DataFrame:
    """K2: the four-source rows of `tickets_embeddings` with vectors."""
    base = stage(base, "feed-base")
    rows = stage(four_sources(base, summary).drop("sentence_embedding"), "feed-texts")
    return embed_unique(rows, "sentence", encoder or hashed_encoder())


def sample_n(df: DataFrame, n: int = 5, seed: int = 0, columns: list[str] | None = None) -> DataFrame:
    """n random rows, the n smallest md5 of the seed and the row's content (``columns``, by default all).

    Which rows are taken depends on the rows and the seed only, not on files, partitions or cores; two samples merge into one
    by taking the n smallest again. Each task keeps n rows before the merge."""
    names = columns or df.columns
    content = [F.coalesce(F.col(c).cast("string"), F.lit(SAMPLE_NULL)) for c in names]
    key = F.md5(F.concat_ws(SAMPLE_SEPARATOR, F.lit(str(seed)), *content))
    return df.withColumn("_k", key).orderBy("_k", *names).limit(n).drop("_k")
