"""Bounded, repeatable samples of labelled texts for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts of a sample in all, whatever the number of labels.
TOTAL = 8000


def crc_mod(column: Column, mod: int) -> Column:
    """crc32 of the value as text, modulo ``mod`` (null for null)."""
    return F.crc32(column.cast("string").cast("binary")) % mod


def _place(*columns: str) -> Column:
    """A number in [0, 1) by the low 30 bits of a hash."""
    return F.xxhash64(*columns).bitwiseAND(2**30 - 1) / 2**30


def labelled_sample(
    texts: DataFrame, labels: DataFrame, key: str, text: str, label: str, bound: int, total: int = TOTAL
) -> list[tuple[str, object]]:
    """About ``bound`` texts per label value, fewer when there are so many values that ``total`` would be passed (every value
    has its share, however many there are); at most ``2 * total`` rows of (text, label) reach the driver.

    ``labels`` is (key, label), one label a key; it may be ``texts`` itself. Which keys are taken is decided by a hash of the
    key on the slim label rows; only the chosen keys (bounded by ``total``) are then sent to the texts, which are
    neither shuffled nor joined otherwise. Rows without key, label or text are left out.
    """
    slim = labels.select(F.col(key).alias("_key"), F.col(label).alias("_label")).where("_key is not null and _label is not null")
    slim = slim.distinct()
    counts = slim.groupBy("_label").agg(F.count(F.lit(1)).alias("_n"))
    values = counts.count()
    if not values:
        return []
    each = max(1, min(bound, total // values))
    chosen = slim.join(counts, "_label").where(_place("_key") < F.lit(float(each)) / F.col("_n")).select("_key", "_label")
    chosen = chosen.orderBy(F.xxhash64("_key"), "_label").limit(total)
    own = texts.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where("_text is not null")
    got = own.join(F.broadcast(chosen), "_key").orderBy(F.xxhash64("_key", "_text"), "_label").limit(2 * total).collect()
    return [(r["_text"], r["_label"]) for r in got]
