"""Article vector-table sync (K8): diff, embed-only-new, truncate, watermark, then apply
(insert-if-absent, deletes, flag update). B8–B10, C3, C4, C9, D9, D11, D13, H10, H13, J1–J4.

The original tool mutates a database row by row; here each step computes the new
table state as a DataFrame (anti/semi/outer joins), which a caller writes with
one overwrite or append. Every step is a join on keys; no key list is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simtrail.functions.text import ensure_tags, shrink_long
from simtrail.operators.base import dedup_keep_first
from simtrail.operators.embed import Encoder, embed_unique, hashed_encoder
from simtrail.session import stage

KEYS = ("id", "sentence")


def filter_deleted(df: DataFrame, deleted_ids: DataFrame, key: str = "id") -> DataFrame:
    """Drop rows whose id is in the deleted list (left anti join)."""
    return df.join(deleted_ids.select(F.col(deleted_ids.columns[0]).alias(key)), key, "left_anti")


def fill_missing(df: DataFrame, drop_missing_first: bool = False, subset: str = "sentence") -> DataFrame:
    """Text NULLs -> ''. With ``drop_missing_first`` rows without a sentence are
    dropped first (filling first, the default, drops nothing)."""
    if drop_missing_first:
        df = df.na.drop(subset=[subset])
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill("", subset=text_cols) if text_cols else df


def _pair_cond(left: DataFrame, right: DataFrame, prefix: str, null_safe: bool):
    """Join condition on (id, sentence): equi-keys (id, xxhash64(sentence)) so that shuffles
    hash and sort two longs, plus the exact text comparison as a residual condition
    (written as a >= / <= pair so the planner does not turn the long text into a sort key)."""
    i, s = KEYS
    eq = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    ls, rs = left[s], right[f"{prefix}{s}"]
    exact = (ls >= rs) & (ls <= rs)
    if null_safe:
        exact = exact | (ls.isNull() & rs.isNull())
    return [eq(left[i], right[f"{prefix}{i}"]), left["_h"] == right[f"{prefix}_h"], exact]


def _with_hash(df: DataFrame, col: str = "sentence") -> DataFrame:
    return df.withColumn("_h", F.coalesce(F.xxhash64(F.col(col)), F.lit(0).cast("long")))


def _with_digest(df: DataFrame) -> DataFrame:
    """The text's hash and its SHA-256 (NULL for NULL): what tells pairs apart where the text itself need not travel."""
    return _with_hash(df).withColumn("_d", F.sha2(F.col("sentence"), 256))


def _pair_anti(table: DataFrame, pairs: DataFrame) -> DataFrame:
    """``table`` (with its ``_h`` and ``_d`` if it has them, else they are added for the join) without the pairs. Only the
    pairs' ids and digests are shuffled, and a plan that needs no text of the table shuffles none of it."""
    i, s = KEYS
    own = "_d" in table.columns
    left = table if own else _with_digest(table)
    right = (pairs if "_d" in pairs.columns else _with_digest(pairs.select(i, s))).select(
        *[F.col(c).alias(f"_p_{c}") for c in (i, "_h", "_d")])
    same = (left["_d"] >= right["_p__d"]) & (left["_d"] <= right["_p__d"])  # no sort key
    kept = left.join(right, [left[i] == right[f"_p_{i}"], left["_h"] == right["_p__h"], same], "left_anti")
    return kept if own else kept.drop("_h", "_d")


def sync_diff(incoming: DataFrame, existing: DataFrame, keys=KEYS) -> DataFrame:
    """Full outer join on (id, sentence) with provenance ``_merge`` in
    {'left_only', 'right_only', 'both'}; keys compared null-safely."""
    if tuple(keys) != KEYS:
        raise ValueError("sync_diff compares (id, sentence) pairs")
    left = _with_hash(incoming).withColumn("_l", F.lit(True))
    right = _with_hash(existing.select(*keys)).select(
        *[F.col(k).alias(f"_r_{k}") for k in (*keys, "_h")]).withColumn("_r", F.lit(True))
    j = left.join(right, _pair_cond(left, right, "_r_", True), "full_outer")
    merge = (
        F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left_only").otherwise("right_only")
    )
    out = j.select(
        *[F.coalesce(F.col(k), F.col(f"_r_{k}")).alias(k) for k in keys],
        *[F.col(c) for c in incoming.columns if c not in keys],
        merge.alias("_merge"),
    )
    return out


def watermark(df: DataFrame, col: str = "updated_at") -> DataFrame:
    """High-water mark of the new rows (NULL when there are none); any orderable type."""
    return df.agg(F.max(col).alias("updated_at_max"))


@dataclass
class SyncPlan:
    new_rows: DataFrame
    removed: DataFrame
    watermark: DataFrame


def prepare_sync(
    incoming: DataFrame,
    existing: DataFrame,
    deleted_ids: DataFrame,
    encoder: Encoder | None = None,
    cache: bool = True,
    shrink: int | None = None,
    drop_missing_first: bool = False,
) -> SyncPlan:
    """K8 (first half): which rows to embed and insert, which (id, sentence) pairs to remove,
    and the new high-water mark. With ``cache=False`` every row is new and nothing is removed.
    Texts are kept whole (``shrink`` cuts them: a cut text no longer matches its source in the next diff)."""
    enc = encoder or hashed_encoder()
    df = filter_deleted(incoming, deleted_ids)
    df = fill_missing(df, drop_missing_first)
    df = ensure_tags(df)
    if cache:
        diff = stage(sync_diff(df, existing), "sync-diff")  # read by the new rows, the removed pairs, the mark and the encoder
        new = diff.where(F.col("_merge") == "left_only").drop("_merge")
        removed = diff.where(F.col("_merge") == "right_only").select(*KEYS)
    else:
        new = df
        removed = existing.select(*KEYS).limit(0)
    mark = watermark(new)  # before the encoder: it needs no vectors
    new = embed_unique(new, "sentence", enc)
    if shrink is not None and shrink > 0:
        new = shrink_long(new, shrink)
    return SyncPlan(new, removed, mark)


def insert_if_absent(table: DataFrame, rows: DataFrame, keys=KEYS,
                     order_col: str | None = None) -> DataFrame:
    """Rows to append: one per (id, sentence) (keep first), and only keys absent from the table."""
    # rows alike in the order column are told apart by their whole content, so the same row stays in every run
    order = [F.col(order_col).asc()] if order_col else []
    order += [F.xxhash64(*rows.columns), F.hash(*rows.columns)]
    d = dedup_keep_first(rows, list(keys), order)
    return _pair_anti(d, table)


def delete_by_id(table: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Table without the listed ids."""
    return table.join(ids.select(F.col(ids.columns[0]).alias(key)), key, "left_anti")


def delete_by_pair(table: DataFrame, pairs: DataFrame, keys=KEYS) -> DataFrame:
    """Table without the listed (id, sentence) pairs (plain equality, as SQL row comparison; texts by their SHA-256)."""
    return _pair_anti(table, pairs)


def flag_sync(table: DataFrame, catalogue: DataFrame, mode: str = "as_written",
              order_col: str = "ord") -> DataFrame:
    """J4 + C9 + D11: update the ``homolog`` flag of table rows from the catalogue.

    Catalogue rows are deduplicated on (product, module), keeping the first by ``order_col``.
    mode="as_written": where the catalogue says False and the row holds False, set True;
    where the catalogue says True and the row holds True, set False (the update as written).
    mode="catalogue": matched rows take the catalogue value. NULL flags are never touched.
    """
    cat = dedup_keep_first(catalogue, ["product", "module"], [F.col(order_col).asc()]).select(
        "product", "module", F.col("homolog").alias("_cat")
    )
    j = table.join(cat, ["product", "module"], "left")
    h, c = F.col("homolog"), F.col("_cat")
    if mode == "as_written":
        new = F.when(h.isNotNull() & c.isNotNull() & (h == c), ~h).otherwise(h)
    elif mode == "catalogue":
        new = F.when(h.isNotNull() & c.isNotNull(), c).otherwise(h)
    else:
        raise ValueError("mode must be 'as_written' or 'catalogue'")
    return j.withColumn("homolog", new).select(*table.columns)


def apply_sync(table: DataFrame, plan: SyncPlan, deleted_ids: DataFrame, catalogue: DataFrame | None = None,
               flag_mode: str = "as_written") -> DataFrame:
    """K8 (second half): new table state = table - deleted ids - removed pairs + new rows
    (insert-if-absent), then the flag update. Columns that the new rows carry and the table lacks
    (vectors, tags) are added to it, NULL in its old rows."""
    # digests first: the second reading of the table, for the rows to insert, then needs no text
    kept = delete_by_pair(delete_by_id(_with_digest(table), deleted_ids), plan.removed)
    ins = insert_if_absent(kept, plan.new_rows)
    t = kept.drop("_h", "_d")
    added = [f for f in ins.schema.fields if f.name not in table.columns]
    t = t.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    cols = t.columns
    ins = ins.select(*[F.col(c) if c in ins.columns else F.lit(None).cast(t.schema[c].dataType).alias(c)
                       for c in cols])
    t = t.unionByName(ins)
    if catalogue is not None:
        t = flag_sync(t, catalogue, flag_mode)
    return t


def per_product_counts(df: DataFrame, col: str = "product") -> DataFrame:
    """Rows per product (what each per-product insert batch would hold)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def write_per_product(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet",
                      max_records_per_file: int = 5_000_000) -> None:
    """D13 + J1 sink: one folder per product, written by the tasks that already hold the rows
    (no shuffle on product, so a product with a third of the rows is still written by
    every task in parallel); files are capped at ``max_records_per_file`` rows."""
    (df.write.mode(mode).format(fmt).option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("product").save(path))
