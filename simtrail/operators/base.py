"""Ticket base (K1): one row per ticket from one row per comment (D1, D2, E1, C2, B1),
the four-source fan-out (G3, H1, H2) and keep-first deduplication (D11).

Everything is an aggregate on (ticket_id, time slice) and one on ticket_id, both with map-side partial aggregation;
the earliest comment is an aggregate (min of a (time, text) struct), not a window,
so a ticket with a huge number of comments is combined partially on every mapper.
The joined comment text is by definition one value per ticket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simtrail.functions.text import sentence_hash

# Fixed value: separator between the comments of a ticket (U+2561).
COMMENT_SEP = "╡"

# The four text sources, in fan-out order.
FOUR_SOURCES = ["ticket_comment", "subject", "summary", "first_comment"]


def first_comment(tickets: DataFrame) -> DataFrame:
    """Earliest comment per ticket; ties on time broken by the text (NULL times first)."""
    first = F.min(F.struct(F.col("comment_created_at"), F.col("ticket_comment")))
    return tickets.groupBy("ticket_id").agg(first.alias("_f")).select(
        "ticket_id",
        F.col("_f.ticket_comment").alias("first_comment"),
        F.col("_f.comment_created_at").alias("comment_created_at"),
    )


def ticket_base(tickets: DataFrame, sep: str = COMMENT_SEP, time_slice: str | None = "hour") -> DataFrame:
    """K1: joined comments (ordered by comment time, then text), MAX of the descriptive
    columns, earliest comment, and typed NULL placeholders for the derived fields.

    The comments are joined in two levels: in order within each (ticket, slice of time), then slice after slice, so a
    ticket with very many comments is sorted by many tasks and only its joined slices meet in one. ``time_slice`` is a unit
    of ``date_trunc``; None joins each ticket in one step."""
    if "'" in sep:
        raise ValueError("separator must not contain a quote")

    def joined(text: str, order: str) -> Column:
        return F.expr(f"listagg({text}, '{sep}') WITHIN GROUP (ORDER BY {order})").alias("ticket_comment")

    rest = ["subject", "module_name", "product_name", "ticket_status", "created_at", "updated_at"]
    most = [F.max(c).alias(c) for c in rest]
    first = F.struct(F.col("comment_created_at"), F.col("ticket_comment"))
    if time_slice is None:
        agg = tickets.groupBy("ticket_id").agg(
            joined("ticket_comment", "comment_created_at, ticket_comment"), *most, F.min(first).alias("_f"))
    else:
        sliced = tickets.withColumn("_slice", F.date_trunc(time_slice, F.col("comment_created_at").cast("timestamp")))
        runs = sliced.groupBy("ticket_id", "_slice").agg(
            joined("ticket_comment", "comment_created_at, ticket_comment"), *most, F.min(first).alias("_f"))
        agg = runs.groupBy("ticket_id").agg(joined("ticket_comment", "_slice"), *most, F.min("_f").alias("_f"))
    agg = agg.withColumnsRenamed({"module_name": "module", "product_name": "product"})
    return agg.select(
        "ticket_id",
        "ticket_comment",
        "subject",
        F.lit(None).cast("string").alias("summary"),
        F.lit(None).cast("string").alias("ticket_sentence_hash"),
        "module",
        "product",
        F.lit(None).cast("string").alias("sentence_source"),
        "ticket_status",
        F.lit(None).cast("array<float>").alias("sentence_embedding"),
        "created_at",
        "updated_at",
        F.col("_f.ticket_comment").alias("first_comment"),
    )


def fan_out_sources(base: DataFrame, summary: Column | None = None) -> DataFrame:
    """G3 + H1 + H2: one row per (ticket, source) with the text and its hash.

    The first_comment hash also covers the summary (a fixed rule of the table layout).
    ``summary`` defaults to the base's ``summary`` column.
    """
    s = summary if summary is not None else F.col("summary")
    b = base.withColumn("summary", s)
    tid = F.col("ticket_id")

    def item(name: str, text: Column, h: Column) -> Column:
        return F.struct(F.lit(name).alias("sentence_source"), text.alias("sentence"), h.alias("ticket_sentence_hash"))

    arr = F.array(
        item("ticket_comment", F.col("ticket_comment"), sentence_hash(tid, F.col("ticket_comment"))),
        item("subject", F.col("subject"), sentence_hash(tid, F.col("subject"))),
        item("summary", F.col("summary"), sentence_hash(tid, F.col("summary"))),
        item("first_comment", F.col("first_comment"),
             sentence_hash(tid, F.col("first_comment"), F.col("summary"))),
    )
    keep = [c for c in b.columns if c not in ("sentence_source", "ticket_sentence_hash", "sentence")]
    return b.select(*keep, F.inline(arr))


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order`` (a total order makes it deterministic).

    ``row_number() = 1`` runs as a partial WindowGroupLimit before the shuffle, so a key
    repeated in many rows sends at most one row per map task; :func:`dedup_keep_min` is
    the aggregate form for orders over plain columns.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup_keep_min(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """D11 (skew-safe form): per key keep the row with the smallest (order_cols..., rest...)
    via a min-of-struct aggregate (partial aggregation, no per-key sort)."""
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.min(F.struct(*[F.col(c) for c in list(order_cols) + rest])).alias("_m")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in list(order_cols) + rest]).select(*df.columns)
