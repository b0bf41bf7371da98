"""Views over the driver tables that give the inputs the ticket/article jobs expect.

Each function reads the parquet tables under ``sf_dir`` and derives one input
table with column expressions only, so its work grows with the tables. The
same derivations are written in SQL in :mod:`simtrail.plans.oracle` (one rule,
two engines). Rules are listed in FIXTURES.md §3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from simtrail.sources.io import ensure_parallelism, read_table

# Tables whose rows carry long texts: per-row work on them is CPU heavy.
TEXT_TABLES = {"documents", "conversations"}

# The four text sources of a ticket, in vec_id % 4 order.
SOURCE_NAMES = ["ticket_comment", "subject", "summary", "first_comment"]

EPOCH = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
    return ensure_parallelism(df) if name in TEXT_TABLES else df


def paragraphs(text: Column) -> Column:
    """The text with every sentence and every line a paragraph of its own (a blank line between)."""
    return F.replace(F.replace(text, F.lit("\n"), F.lit("\n\n")), F.lit(". "), F.lit(".\n\n"))


def first_line(text: Column) -> Column:
    return F.element_at(F.split(text, "\n"), 1)


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per comment (the warehouse `tickets` table), from `conversations`."""
    c = _t(spark, sf_dir, "conversations")
    return c.select(
        F.col("conv_id").alias("ticket_id"),
        paragraphs(F.col("text")).alias("ticket_comment"),
        first_line(F.col("text")).alias("subject"),
        F.concat(F.lit("mod"), (F.col("conv_id") % 5).cast("string")).alias("module_name"),
        F.concat(F.lit("prod"), (F.col("conv_id") % 3).cast("string")).alias("product_name"),
        F.col("role").alias("ticket_status"),
        F.expr(f"{EPOCH} + make_dt_interval(conv_id, 0, 0, 0)").alias("created_at"),
        F.expr(f"{EPOCH} + make_dt_interval(conv_id, turn, 0, 0)").alias("updated_at"),
        F.expr(f"{EPOCH} + make_dt_interval(conv_id, 0, turn div 2, 0)").alias("comment_created_at"),
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticket vector table (`tickets_embeddings` layout), four rows per ticket, from `embeddings`."""
    e = _t(spark, sf_dir, "embeddings")
    tid = F.expr("vec_id div 4")
    return e.select(
        tid.alias("ticket_id"),
        F.element_at(F.array(*[F.lit(s) for s in SOURCE_NAMES]), (F.col("vec_id") % 4 + 1).cast("int")).alias(
            "sentence_source"
        ),
        F.concat(F.lit("prod"), (tid % 3).cast("string")).alias("product"),
        F.concat(F.lit("mod"), (tid % 5).cast("string")).alias("module"),
        F.concat(F.lit("text "), F.col("vec_id").cast("string")).alias("sentence"),
        F.col("embedding").alias("sentence_embedding"),
        F.col("label"),
        F.col("vec_id"),
    )


def judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged tickets: for ticket_id % 5 = 0, all other tickets of the same hundred of ids whose subject row has the same
    label, joined with ', ' in ascending order.

    The hundred bounds the pairs of a target by the ids themselves, however many tickets share a label.
    """
    hundred = F.expr("ticket_id div 100")
    subj = corpus(spark, sf_dir).where(F.col("sentence_source") == "subject").select("ticket_id", "label", hundred.alias("h"))
    targets = subj.where(F.col("ticket_id") % 5 == 0)
    others = subj.withColumnRenamed("ticket_id", "other_id")
    pairs = targets.join(others, ["label", "h"]).where(F.col("other_id") != F.col("ticket_id"))
    return pairs.groupBy("ticket_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("other_id")), lambda x: x.cast("string")), ", ").alias("expected_id")
    )


def label_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged tickets by the label alone: for ticket_id % 5 = 0, all other tickets whose subject row has the same label, joined
    with ', ' in ascending order.

    The tickets of a label are listed once and looked up by its targets, so no pair of tickets is shuffled; who is judged
    needs only the label's least and greatest id, and Spark leaves the lists out where no one reads ``expected_id``.
    """
    subj = corpus(spark, sf_dir).where(F.col("sentence_source") == "subject").select("ticket_id", "label")
    targets = subj.where(F.col("ticket_id") % 5 == 0)
    lists = subj.where("ticket_id is not null").groupBy("label").agg(
        F.min("ticket_id").alias("_least"), F.max("ticket_id").alias("_most"), F.collect_list("ticket_id").alias("_ids"))
    mine = targets.join(lists, "label").where((F.col("_least") != F.col("ticket_id")) | (F.col("_most") != F.col("ticket_id")))
    others = F.filter("_ids", lambda x: x != F.col("ticket_id"))
    per = mine.select("ticket_id", others.alias("_others")).groupBy("ticket_id").agg(F.flatten(F.collect_list("_others")).alias("_o"))
    return per.select("ticket_id", F.array_join(F.transform(F.sort_array("_o"), lambda x: x.cast("string")), ", ").alias("expected_id"))


def judgments_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The judgments as an unchecked upload (raw_id, expected_id): ids as text, some of them padded, some no number."""
    i = F.col("ticket_id")
    text = i.cast("string")
    raw = (
        F.when(i % 35 == 0, F.concat(F.lit("T-"), text))
        .when(i % 20 == 0, F.concat(F.lit(" "), text, F.lit(" ")))
        .when(i % 55 == 0, F.lit(None).cast("string"))
        .when(i % 65 == 0, F.concat(text, F.lit(".5")))
        .otherwise(text)
    )
    return judgments(spark, sf_dir).select(raw.alias("raw_id"), "expected_id")


def query_subject(spark: SparkSession, sf_dir: str, by_label: bool = False) -> DataFrame:
    """Subject rows of the judged tickets: the query set of the batch evaluation; ``by_label``: judged by the label alone."""
    c = corpus(spark, sf_dir).where(F.col("sentence_source") == "subject")
    judged = label_judgments(spark, sf_dir) if by_label else judgments(spark, sf_dir)
    return c.join(judged, "ticket_id").select(
        "ticket_id", "sentence", "product", "module", "sentence_embedding", "expected_id"
    )


def chunks_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long ticket texts for the chunk feed, from `documents`."""
    d = _t(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("ticket_id"),
        F.col("text").alias("ticket_comment"),
        first_line(F.col("text")).alias("subject"),
        F.col("source").alias("product"),
        F.col("lang").alias("module"),
    )


def _tags_json(a: Column, b: Column) -> Column:
    return F.concat(F.lit('["'), a, F.lit('","'), b, F.lit('"]'))


def text_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches typed by a user, from `documents`: the first line of every 25th, its product and language."""
    c = chunks_source(spark, sf_dir)
    return c.where(F.col("ticket_id") % 25 == 0).select("ticket_id", F.col("subject").alias("query"), "product", "module")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming knowledge-base articles (the sync input), from `documents`."""
    d = _t(spark, sf_dir, "documents")
    i = F.col("doc_id")
    return d.select(
        i.alias("id"),
        F.when(i % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("text")).alias("sentence"),
        F.col("source").alias("product"),
        F.col("lang").alias("module"),
        F.when(i % 19 == 0, F.lit(None).cast("boolean")).otherwise(i % 2 == 0).alias("homolog"),
        F.when(i % 10 == 0, F.lit(None).cast("string")).otherwise(_tags_json(F.col("lang"), F.col("source"))).alias(
            "tags"
        ),
        i.alias("updated_at"),
    )


def existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, sentence) pairs already in the vector table."""
    d = _t(spark, sf_dir, "documents")
    i = F.col("doc_id")
    kept = d.where(i % 3 != 0).select(
        i.alias("id"),
        F.when(i % 7 == 0, F.concat(F.col("text"), F.lit("!"))).otherwise(F.col("text")).alias("sentence"),
    )
    stale = d.where(i % 11 == 0).select((i + 1000000).alias("id"), F.col("text").alias("sentence"))
    return kept.unionByName(stale)


def deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of deleted articles (one column `id`)."""
    d = _t(spark, sf_dir, "documents")
    return d.where(F.col("doc_id") % 13 == 0).select(F.col("doc_id").alias("id"))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(product, module, homolog, ord) with a flipped repeat (ord 2) of every pair."""
    d = _t(spark, sf_dir, "documents")
    first = (
        d.groupBy(F.col("source").alias("product"), F.col("lang").alias("module"))
        .agg(F.min("doc_id").alias("m"))
        .where(F.col("m") % 5 != 0)
    )
    one = first.select("product", "module", (F.col("m") % 2 == 0).alias("homolog"), F.lit(1).alias("ord"))
    two = first.select("product", "module", (F.col("m") % 2 != 0).alias("homolog"), F.lit(2).alias("ord"))
    return one.unionByName(two)


def locales(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents")
    r = F.col("doc_id") % 4
    code = (
        F.when(r == 0, F.col("lang"))
        .when(r == 1, F.concat(F.col("lang"), F.lit("-XX")))
        .when(r == 2, F.lit("pt-BR"))
        .otherwise(F.lit(None).cast("string"))
    )
    return d.select("doc_id", code.alias("locale_code"))


def json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", "ts", "event_type", "props")


def nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON record an event with a date, a time, lists and a nested object; some parts missing or null."""
    i, text = F.col("event_id"), F.col("event_id").cast("string")
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    tags = F.when(i % 3 == 0, F.lit("[]")).when(i % 3 == 1, F.lit("null")).otherwise(
        F.concat(F.lit('["a b","'), F.col("event_type"), F.lit('"]')))
    note = F.when(i % 4 == 0, F.lit("")).otherwise(F.concat(F.lit(',"note":"n\\u00e9 \\"'), text, F.lit('\\""')))
    items = F.when(i % 5 == 0, F.lit("[]")).otherwise(F.concat(F.lit('[{"n":1},{"n":'), (i % 7).cast("string"), F.lit("},{}]")))
    record = F.concat(
        F.lit('{"id":'), text, F.lit(',"on":"'), F.substring(at, 1, 10), F.lit('","at":"'), at, F.lit('","tags":'), tags,
        F.lit(',"inner":{"k":'), (i % 11).cast("string"), note, F.lit('},"items":'), items, F.lit("}"))
    return _t(spark, sf_dir, "events").select("event_id", "event_type", record.alias("record"))


def vector_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current article vector table: the existing (id, sentence) pairs with their attributes
    (the document with doc_id = id % 1000000; flag = doc_id % 3 = 1)."""
    ex = existing(spark, sf_dir)
    d = _t(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    j = ex.join(d, ex["id"] % 1000000 == d["doc_id"])
    return j.select(
        "id", "sentence",
        F.col("source").alias("product"), F.col("lang").alias("module"),
        (F.col("doc_id") % 3 == 1).alias("homolog"),
        F.col("id").alias("updated_at"),
    )
