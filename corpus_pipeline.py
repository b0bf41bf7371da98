"""A text corpus from raw documents to packed training sequences.

Language (unreadable or undecided texts go), quality (texts predicted bad go), near
duplicates (one document of each group stays), packing. Every stage is written and read
again before the next, so a lost executor costs one stage at most. Every stage sends texts to Python in
small batches (a setting of the session, :func:`small_batches`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simtrail.llm import jaccard, langid, packing, quality
from simtrail.llm.common import fresh_name, table
from simtrail.llm.queries import TOKENIZER, packed_digest
from simtrail.session import small_batches, stage

# The model stages and the incidence product have no SQL form; tests check every stage against brute force.
ORACLE_SQL = None


def _passed(docs: DataFrame, step: Callable[[DataFrame], DataFrame], added: set[str], condition: str) -> DataFrame:
    """The rows of ``docs`` that meet ``condition`` after ``step``, which adds columns; those of ``docs`` it would replace are set
    aside. Every other column is sent once, so no text goes through a task twice."""
    hidden = [c for c in docs.columns if c.lower() in added]
    aside = fresh_name([*docs.columns, *added], "_aside")
    found = step(docs.withColumn(aside, F.struct(*hidden)) if hidden else docs).where(condition)
    return found.select(*[f"{aside}.{c}" if c in hidden else c for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found without doubt; null texts and texts without a letter go."""
    small_batches(spark)
    clear = f"lang_pred <> '{langid.UNKNOWN}' and not ambiguous"
    return _passed(docs, lambda rows: langid.identify(rows, docs), {"lang_pred", "score", "ambiguous"}, clear)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, does not reject."""
    small_batches(spark)
    marks = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return _passed(docs, lambda rows: quality.score_quality(rows, marks), {"score", "predicted"}, "predicted = 1")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard similarity of at least 0.8): that with the
    smallest doc_id; of several rows with that id, the one with the smallest text. Null ids stay."""
    small_batches(spark)
    groups = jaccard.jaccard_groups(docs, size=5, percent=80)
    others = groups.where("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(others, "doc_id", "left_anti")
    several = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not several.limit(1).count():
        return kept
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    first = F.min(F.struct(F.col("text").isNull().alias("_none"), "text", *rest)).alias("_row")
    one = kept.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(first).select("doc_id", "_row.*")
    return kept.join(several, "doc_id", "left_anti").unionByName(one.select(docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, one row per piece."""
    small_batches(spark)
    return packed_digest(packing.pack(docs, TOKENIZER))


STAGES = [("language", language), ("quality", good_quality), ("near_duplicates", near_duplicates), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each staged in the shared folder; the last is returned as it is."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
