"""User-level retrieval jobs: query-set selection (B2/B3, C1), batch similarity with
metrics (K6), the evaluation report (K7) and the interactive search (K5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simtrail.operators.embed import Encoder, embed_unique, hashed_encoder
from simtrail.operators.evaluate import attach_judgments, check_unique_targets, hit_rate_at_k, recall_at_k
from simtrail.operators.search import FilterSpec, vector_search
from simtrail.session import stage


def query_set(
    table: DataFrame,
    judgments: DataFrame,
    kind: str = "fields",
    sentence_source: str | None = "subject",
    sentence_field: str | None = None,
    validate: bool = True,
) -> DataFrame:
    """B2 + B3 + C1: the query rows of a judged evaluation.

    kind="summary": text column ``sentence``, optional source filter.
    kind="chunks":  text ``subject`` and vector ``subject_embedding``, one row per ticket
                    (the first chunk by ``chunk_index``), no source filter.
    kind="fields":  text column ``sentence_field`` (default: the source name, else
                    ``subject``), optional source filter.
    Returns (ticket_id, sentence, product, module, sentence_embedding, expected_id); with no
    source filter (several rows a ticket) also sentence_source, the key of a ticket's rows.
    With ``validate`` a ticket judged twice raises (instead of silently losing the target).
    """
    if validate:
        check_unique_targets(judgments)
    j = judgments.select("ticket_id", "expected_id")
    if kind == "chunks":
        w = Window.partitionBy("ticket_id").orderBy(F.col("chunk_index").asc_nulls_last())
        first = table.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
        q = first.select(
            "ticket_id",
            F.col("subject").alias("sentence"),
            "product",
            "module",
            F.col("subject_embedding").alias("sentence_embedding"),
        )
    else:
        if kind == "summary":
            field = "sentence"
        elif kind == "fields":
            field = sentence_field or sentence_source or "subject"
        else:
            raise ValueError(f"unknown query-set kind {kind!r}")
        t = table.where(F.col("sentence_source") == sentence_source) if sentence_source else table
        q = t.select("ticket_id", F.col(field).alias("sentence"), "product", "module", "sentence_embedding",
                     *([] if sentence_source else ["sentence_source"]))
    return q.join(j, "ticket_id")


def batch_similarity(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 20,
    metric: str = "cosine",
    filters: FilterSpec = FilterSpec(),
    threshold: float | None = None,
    inclusive: bool = False,
    strict_expected: bool = False,
    query_row: str | None = None,
) -> DataFrame:
    """K6: top-k similar tickets for every judged target, with hit marker and
    expected count. Columns: target, ticket_id, score, hit_sentence (text of the ticket's
    best row), rank, sentence (the query's), expected_id, hit, num_expected_ids.

    A target with several query rows has one list over all of them, unless ``query_row`` names the
    column that tells them apart (``sentence_source``): then every query row has its own k tickets,
    with its own sentence. The result carries ``query_row`` after ``target`` and ``row_rank`` (place
    in the query row's list) after ``rank``; ``rank`` counts over all rows of the target (score desc,
    ticket_id, query_row), so a ticket may fill several slots of the metrics."""
    res = vector_search(queries, corpus, k=k, metric=metric, filters=filters, threshold=threshold,
                        inclusive=inclusive, hit_text="sentence", query_row=query_row)
    if "hit_text" not in res.columns:  # no query rows
        res = res.withColumn("hit_text", F.lit(None).cast("string"))
    if query_row:
        w = Window.partitionBy("target").orderBy(F.col("score").desc(), "ticket_id", "query_row")
        res = res.withColumnRenamed("rank", "row_rank").withColumn("rank", F.row_number().over(w).cast("long"))
        res = res.select("target", "query_row", "ticket_id", "score", "hit_text", "rank", "row_rank")
    return attach_judgments(res.withColumnRenamed("hit_text", "hit_sentence"), queries, strict_expected, query_row)


def metrics(results: DataFrame, ks: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """The six printed numbers of the batch job as one DataFrame (k, hit_rate, recall)."""
    return hit_rate_at_k(results, ks).join(recall_at_k(results, ks), "k", "full")


def interactive_search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 20,
    threshold_percent: float = 65,
    metric: str = "cosine",
    match: str = "literal",
) -> DataFrame:
    """K5: per query row, candidates whose product starts with the query product OR whose
    module contains the query module, own ticket excluded, score > threshold/100, best row per
    ticket, top k by score desc, ticket_id asc."""
    return vector_search(
        queries,
        corpus,
        k=k,
        metric=metric,
        filters=FilterSpec(interactive=True, match=match),
        threshold=threshold_percent / 100.0,
        inclusive=False,
    )


def text_search(
    queries: DataFrame,
    corpus: DataFrame,
    encoder: Encoder | None = None,
    k: int = 20,
    threshold_percent: float = 65,
    metric: str = "cosine",
    match: str = "literal",
    text_col: str = "query",
    hit_columns: Sequence[str] = ("product", "module"),
) -> DataFrame:
    """K5 from texts: (ticket_id, query text, product, module) rows are encoded (each distinct text once), searched as in
    :func:`interactive_search`, and each hit comes with its own columns.

    Columns: target, query, ticket_id, score, hit_sentence (text of the ticket's best row), hit_<column> for
    ``hit_columns`` of that row, rank. A text without a vector (NULL, no token) finds nothing.
    """
    # written once: the search reads its queries several times
    asked = stage(embed_unique(queries, text_col, encoder or hashed_encoder()), "asked")
    found = vector_search(asked, corpus, k=k, metric=metric, filters=FilterSpec(interactive=True, match=match),
                          threshold=threshold_percent / 100.0, hit_text="sentence", hit_columns=hit_columns)
    if "hit_text" not in found.columns:  # no query has a vector
        found = found.select("*", F.lit(None).cast("string").alias("hit_text"),
                             *[F.lit(None).cast(corpus.schema[c].dataType).alias(f"hit_{c}") for c in hit_columns])
    texts = queries.groupBy(F.col("ticket_id").cast("long").alias("target")).agg(F.min(text_col).alias("query"))
    return found.join(texts, "target").select(
        "target", "query", "ticket_id", "score", F.col("hit_text").alias("hit_sentence"), *[f"hit_{c}" for c in hit_columns], "rank")
