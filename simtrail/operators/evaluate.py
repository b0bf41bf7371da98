"""Retrieval evaluation against judged answers.

All metrics are column functions, one shuffle on ``target`` at most; nothing is
collected. Targets are few compared with the corpus, but a single target's
rows are bounded by k, so no group can grow with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simtrail.functions.text import strip_ws


def parse_expected_ids(expected: Column) -> Column:
    """H7: 'a, b,,x' -> [a, b] as BIGINT: split on ',', trim, keep digit-only pieces."""
    pieces = F.transform(F.split(F.coalesce(expected, F.lit("")), ","), lambda x: strip_ws(x))
    digits = F.filter(pieces, lambda x: x.rlike("^[0-9]+$"))
    return F.transform(digits, lambda x: x.try_cast("bigint"))


def num_expected_ids(expected: Column, strict: bool = False) -> Column:
    """H8: number of pieces of split(',') (blanks and non-digits count), 0 when empty/NULL.

    ``strict=True`` counts parsed ids instead.
    """
    if strict:
        return F.size(parse_expected_ids(expected)).cast("long")
    return (
        F.when(expected.isNull() | (F.length(expected) == 0), F.lit(0))
        .otherwise(F.size(F.split(expected, ",")))
        .cast("long")
    )


def hit_marker(ticket_id: Column, expected: Column) -> Column:
    """H9: 1 when the candidate ticket is among the expected ids, else 0 (NULL expected -> 0)."""
    return F.coalesce(F.array_contains(parse_expected_ids(expected), ticket_id), F.lit(False)).cast("long")


def attach_judgments(results: DataFrame, queries: DataFrame, strict: bool = False, query_row: str | None = None) -> DataFrame:
    """C5 + H8 + H9: add the target's expected ids, query sentence, hit and expected count.

    ``queries`` holds the query rows (ticket_id, sentence, expected_id). With ``query_row`` (the
    column the results were keyed by, there named ``query_row``) every result row gets the
    sentence and expected ids of its own query row. Without it a target with several query rows
    was ranked once over all of them, so it is attached once (smallest query sentence, its
    expected ids).
    """
    if query_row:
        own = queries.select(F.col("ticket_id").alias("target"), F.col(query_row).cast("string").alias("query_row"),
                             "sentence", "expected_id")
        joined = results.join(own, ["target", "query_row"], "left")
    else:
        q = queries.groupBy(F.col("ticket_id").alias("target")).agg(
            F.min("sentence").alias("sentence"), F.min("expected_id").alias("expected_id"))
        joined = results.join(q, "target", "left")
    return joined.withColumn("hit", hit_marker(F.col("ticket_id"), F.col("expected_id"))).withColumn(
        "num_expected_ids", num_expected_ids(F.col("expected_id"), strict)
    )


def check_unique_targets(queries: DataFrame, key: str = "ticket_id") -> None:
    """Q8: a target judged twice is an input error (the scalar subquery would fail)."""
    dup = queries.groupBy(key).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"duplicate judgments for some {key}")


def _at_k(results: DataFrame, ks: Sequence[int]) -> DataFrame:
    spark = results.sparkSession
    kdf = spark.createDataFrame([(int(k),) for k in ks], "k long")
    # one row per (k, row with rank <= k): ks is a handful of cut-offs
    return results.join(F.broadcast(kdf), F.col("rank") <= F.col("k"))


def hit_rate_at_k(results: DataFrame, ks: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """Share of targets with at least one hit in their top k.

    Denominator: targets with at least one result row.
    """
    per = _at_k(results, ks).groupBy("k", "target").agg(F.max("hit").alias("any_hit"))
    return per.groupBy("k").agg(F.round(F.avg(F.col("any_hit").cast("double")), 6).alias("hit_rate"))


def recall_at_k(results: DataFrame, ks: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """Mean over targets of hits@k / min(rows in top k, expected count).

    A target with 0 expected ids contributes 0 but stays in the denominator.
    """
    per = _at_k(results, ks).groupBy("k", "target").agg(
        F.sum("hit").alias("hits"),
        F.count(F.lit(1)).alias("n"),
        F.first("num_expected_ids", ignorenulls=True).alias("ne"),
    )
    ratio = F.coalesce(F.try_divide(F.col("hits").cast("double"), F.least("n", "ne").cast("double")), F.lit(0.0))
    return per.groupBy("k").agg(F.round(F.sum(ratio) / F.count(F.lit(1)), 6).alias("recall"))


def rank_flags(results: DataFrame) -> DataFrame:
    """top_1 / top_2 / top_3 markers from the rank (not from row labels)."""
    return results.select(
        "*",
        (F.col("rank") == 1).alias("top_1"),
        (F.col("rank") == 2).alias("top_2"),
        (F.col("rank") == 3).alias("top_3"),
    )


def found_not_found(results: DataFrame, scope: str = "global") -> DataFrame:
    """C8 + D3 + D8: per target, how many expected ids were retrieved (found) or not.

    scope="global": retrieved by *any* target (as the evaluation notebook does);
    scope="target": retrieved for this target. accuracy = found/(found+not_found), 0 when both 0.
    """
    per_target = results.groupBy("target").agg(
        F.first("expected_id", ignorenulls=True).alias("expected_id"),
        F.first("sentence", ignorenulls=True).alias("sentence"),
    )
    exp = per_target.select(
        "target", F.posexplode_outer(parse_expected_ids(F.col("expected_id"))).alias("pos", "eid")
    )
    if scope == "global":
        retrieved = results.select(F.col("ticket_id").alias("eid")).distinct().withColumn("ok", F.lit(1))
        marked = exp.join(retrieved, "eid", "left")
    elif scope == "target":
        retrieved = results.select("target", F.col("ticket_id").alias("eid")).distinct().withColumn("ok", F.lit(1))
        marked = exp.join(retrieved, ["target", "eid"], "left")
    else:
        raise ValueError("scope must be 'global' or 'target'")
    counts = marked.groupBy("target").agg(
        F.sum(F.when(F.col("eid").isNotNull() & F.col("ok").isNotNull(), 1).otherwise(0)).cast("long").alias("found"),
        F.sum(F.when(F.col("eid").isNotNull() & F.col("ok").isNull(), 1).otherwise(0)).cast("long").alias("not_found"),
    )
    out = per_target.join(counts, "target", "left")
    acc = F.coalesce(F.try_divide(F.col("found").cast("double"), (F.col("found") + F.col("not_found")).cast("double")),
                     F.lit(0.0))
    return out.select("target", "expected_id", "sentence", "found", "not_found", F.round(acc, 6).alias("accuracy"))


def top1_frequency(results: DataFrame) -> DataFrame:
    """How many targets have a hit at rank 1 (top_1 true) and how many not."""
    per = results.groupBy("target").agg(F.max(F.when(F.col("rank") == 1, F.col("hit") == 1)).alias("top_1"))
    return per.groupBy("top_1").agg(F.count(F.lit(1)).alias("n"))
