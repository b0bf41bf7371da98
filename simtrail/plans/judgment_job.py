"""Judgment load (A9) and result reload (A10) as jobs on catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simtrail.operators.evaluate import rank_flags
from simtrail.plans.evaluation import metrics
from simtrail.sources import io


def parse_judgments(raw: DataFrame) -> DataFrame:
    """(raw_id, ticket_id, expected_id, problem) of an upload (raw_id text, expected_id text): blanks around an id are cut;
    ``problem`` is 'no id', 'bad id' (not a whole number of 64 bits) or 'judged twice' (any further row of an id, in
    order of its answers), and NULL for a row that can be loaded."""
    text = F.trim("raw_id")
    number = F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))
    rows = raw.select("raw_id", number.alias("ticket_id"), "expected_id")
    first = rows.where("ticket_id is not null").groupBy("ticket_id").agg(
        F.min(F.struct(F.col("expected_id"), F.col("raw_id"))).alias("_first"), F.count(F.lit(1)).alias("_n"))
    j = rows.join(first, "ticket_id", "left")
    own = F.struct("expected_id", "raw_id")
    problem = (
        F.when(F.col("raw_id").isNull() | (text == ""), "no id").when(F.col("ticket_id").isNull(), "bad id")
        .when((F.col("_n") > 1) & ~own.eqNullSafe(F.col("_first")), "judged twice")
    )
    return j.select("raw_id", "ticket_id", "expected_id", problem.alias("problem"))


def load_judgments(raw: DataFrame, table: str, strict: bool = False) -> DataFrame:
    """Append the rows without a problem to the catalog table (ticket_id, expected_id), leaving out tickets it already has;
    returns the rows with a problem. With ``strict`` any problem raises and nothing is written."""
    spark = raw.sparkSession
    parsed = parse_judgments(raw)
    rejected = parsed.where("problem is not null")
    if strict and rejected.limit(1).count():
        raise ValueError(f"judgments with problems: {rejected.limit(5).collect()}")
    good = parsed.where("problem is null").select("ticket_id", "expected_id").distinct()
    if spark.catalog.tableExists(table):
        good = good.join(spark.read.table(table).select("ticket_id"), "ticket_id", "left_anti")
    io.save_table(good, table, "append")
    return rejected


def reload_results(results: DataFrame, name: str, ks=(1, 3, 5)) -> DataFrame:
    """A10: the hits of a batch run (with rank flags) replace the catalog table ``name`` and its metrics ``name_metrics``; the
    metrics are read from the stored hits, so the search runs once."""
    spark = results.sparkSession
    io.save_table(rank_flags(results), name, "replace")
    io.save_table(metrics(spark.read.table(name), ks), f"{name}_metrics", "replace")
    return spark.read.table(f"{name}_metrics")
