"""Scalar text functions (H1–H13, H18, H19) as Column -> Column builders.

All of them are built-in Spark expressions (JVM side, no Python per row).
Each has a twin SQL expression in :mod:`simtrail.plans.oracle` built from the
same constants so that DuckDB can check the results.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping

import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Accent folding table, built by rule: every Latin letter in U+00C0..U+024F whose
# compatibility decomposition (NFKD) keeps exactly one ASCII letter maps to it;
# decompositions to several ASCII letters become multi-letter replacements.
# ---------------------------------------------------------------------------

# Letters with no decomposition, folded the way common
# transliteration does (single letter, then multi-letter).
EXTRA_SINGLE = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ð": "d", "Ð": "D",
                "ı": "i", "ħ": "h", "Ħ": "H", "ŧ": "t", "Ŧ": "T"}
EXTRA_MULTI = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th"}


def _accent_tables() -> tuple[list[tuple[str, str]], str, str]:
    multi = dict(EXTRA_MULTI)
    src, dst = [], []
    for cp in range(0x00C0, 0x0250):
        ch = chr(cp)
        if not ch.isalpha() or ch in multi:
            continue
        if ch in EXTRA_SINGLE:
            src.append(ch)
            dst.append(EXTRA_SINGLE[ch])
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if c.isascii() and c.isalpha())
        if len(base) == 1:
            src.append(ch)
            dst.append(base)
        elif len(base) > 1:
            multi[ch] = base
    return sorted(multi.items()), "".join(src), "".join(dst)


ACCENT_MULTI, ACCENT_FROM, ACCENT_TO = _accent_tables()

# Code point ranges whose non-letter characters are blanked by a plain
# translate (ASCII, Latin-1 and Latin Extended, spacing modifiers and combining marks,
# general punctuation, box drawing); anything else falls back to the regex per row.
BLANK_RANGES = [(0x0000, 0x024F), (0x02B0, 0x036F), (0x2000, 0x206F), (0x2500, 0x257F)]


def _blank_table() -> str:
    keep = set(ACCENT_FROM) | {a for a, _ in ACCENT_MULTI}
    out = []
    for lo, hi in BLANK_RANGES:
        for cp in range(lo, hi + 1):
            ch = chr(cp)
            if ch.isascii() and ch.isalnum():
                continue
            if ch in keep or ch == " ":
                continue
            out.append(ch)
    return "".join(out)


BLANK_FROM = _blank_table()

# Default stopword list (Portuguese function words). The operator takes any list:
# pass your own, or load one with :func:`load_stopwords`.
DEFAULT_STOPWORDS = [
    "a", "o", "e", "as", "os", "um", "uma", "uns", "umas", "de", "da", "do", "das", "dos",
    "em", "na", "no", "nas", "nos", "ao", "aos", "para", "por", "pela", "pelo", "com",
    "sem", "que", "se", "ou", "mas", "como", "mais", "muito", "foi", "ser", "esta", "este",
    "isso", "isto", "ja", "nao", "sim", "tem", "sao", "seu", "sua",
]


def load_stopwords(path: str) -> list[str]:
    """Stopwords from a text file, one per line (blank lines ignored, order and repeats kept)."""
    with open(path, encoding="utf-8") as fh:
        return [w for w in fh.read().splitlines() if w]


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` (a one-element transform)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_ws(c: Column) -> Column:
    """Python-style strip(): remove leading/trailing whitespace (Spark trim only removes blanks)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def sentence_hash(ticket_id: Column, *texts: Column) -> Column:
    """H1/H2: md5 hex of str(ticket_id) + texts (UTF-8). NULL when any part is NULL."""
    return F.md5(F.concat(ticket_id.cast("string"), *texts))


def extract_topic(text: Column) -> Column:
    """H3: first text between double asterisks, else the whole text."""
    return F.coalesce(F.nullif(F.regexp_extract(text, r"\*\*(.*?)\*\*", 1), F.lit("")), text)


def clean_output(text: Column) -> Column:
    """H4: drop list numbering (digits, dot, blanks) and turn newlines into blanks."""
    return F.replace(F.regexp_replace(text, r"[0-9]+\.\s*", ""), F.lit("\n"), F.lit(" "))


def fold_accents(text: Column) -> Column:
    s = text
    for a, b in ACCENT_MULTI:
        s = F.replace(s, F.lit(a), F.lit(b))
    # one scan decides whether the multi-letter replacements are needed at all
    multi_class = "[" + "".join(a for a, _ in ACCENT_MULTI) + "]"
    s = F.when(text.rlike(multi_class), s).otherwise(text)
    return F.translate(s, ACCENT_FROM, ACCENT_TO)


def alnum_blank(text: Column) -> Column:
    """Accent folding, then every character outside [0-9a-zA-Z] becomes a blank.

    One translate pass folds accents and blanks the listed ranges; a row that still holds
    a non-ASCII character (UTF-8 length differs from character length) takes the regex."""
    t = text
    for a, b in ACCENT_MULTI:
        t = F.replace(t, F.lit(a), F.lit(b))
    multi_class = "[" + "".join(a for a, _ in ACCENT_MULTI) + "]"
    t = F.when(text.rlike(multi_class), t).otherwise(text)
    t = F.translate(t, ACCENT_FROM + BLANK_FROM, ACCENT_TO + " " * len(BLANK_FROM))
    # bind t once: inside higher-order functions Spark evaluates without subexpression
    # elimination, and t is used four times below
    return let(t, lambda u: F.when(F.length(u) == F.octet_length(u), u).otherwise(
        F.regexp_replace(u, "[^0-9a-zA-Z]", " ")))


def _stopword_pattern(words: list[str]) -> str | None:
    # only alphanumeric words can ever equal a token; others are dropped from the pattern
    alnum = sorted({w for w in words if w and w.isascii() and w.isalnum()}, key=lambda w: (-len(w), w))
    if not alnum:
        return None
    return "(?<= |^)(?:" + "|".join(alnum) + ")(?= |$)"


def normalize_text(text: Column, stopwords: Iterable[str] | None = None) -> Column:
    """H5 (+H18): fold accents, non-alphanumerics to blanks, drop stopwords (case-sensitive,
    before lower-casing), lower-case, tokens joined by one blank. NULL stays NULL.

    Native string functions only (no per-token lambda): after the blank replacement a token
    is a maximal run between blanks, so a stopword is removed by one boundary regex."""
    words = list(DEFAULT_STOPWORDS if stopwords is None else stopwords)
    s = alnum_blank(text.cast("string"))
    pat = _stopword_pattern(words)
    if pat:
        s = F.regexp_replace(s, pat, "")
    return F.trim(F.regexp_replace(F.lower(s), " +", " "))


def normalize_tokens(text: Column, stopwords: Iterable[str] | None = None) -> Column:
    """Tokens of H5 (see :func:`normalize_text`) as an array; empty text gives no token."""
    return F.array_remove(F.split(normalize_text(text, stopwords), " "), "")


def language_by_locale(code: Column) -> Column:
    """H6: struct(name, code): contains 'en' -> English, else 'es' -> Spanish, else Brazilian Portuguese."""
    c = F.lower(F.coalesce(code, F.lit("")))
    name = (
        F.when(c.contains("en"), F.lit("English"))
        .when(c.contains("es"), F.lit("Spanish"))
        .otherwise(F.lit("Brazilian Portuguese"))
    )
    short = F.when(c.contains("en"), F.lit("en")).when(c.contains("es"), F.lit("es")).otherwise(F.lit("pt"))
    return F.struct(name.alias("language"), short.alias("code"))


def parse_tags(tags: Column) -> Column:
    """JSON text -> array<string>; empty array when NULL or blank; NULL when malformed."""
    return F.when(tags.isNull() | (F.length(tags) == 0), F.array().cast("array<string>")).otherwise(
        F.from_json(tags, T.ArrayType(T.StringType()))
    )


def ensure_tags(df: DataFrame, col: str = "tags") -> DataFrame:
    """H10 at table level: parse only when the column is still text (schema check)."""
    if col in df.columns and isinstance(df.schema[col].dataType, T.StringType):
        return df.withColumn(col, parse_tags(F.col(col)))
    return df


def decode_json(text: Column, schema: T.DataType | str, rename: Mapping[str, str] | None = None) -> Column:
    """Typed JSON decode (struct / array / map, nested, missing fields -> NULL).

    ``rename`` maps JSON attribute names to output field names for struct schemas.
    """
    if isinstance(schema, str) and rename:
        schema = T._parse_datatype_string(schema)
    parsed = F.from_json(text, schema)
    if rename and isinstance(schema, T.StructType):
        return F.struct(*[parsed[f.name].alias(rename.get(f.name, f.name)) for f in schema.fields])
    return parsed


# Accepted text layouts for dates and date-times (ISO 8601 forms).
ISO_DAY = r"(\d{4})-?(\d{2})-?(\d{2})"
ISO_TEXT = ISO_DAY + r"(?:[T ](\d{2}):?(\d{2})(?::?(\d{2})(?:[.,](\d{1,9}))?)?\s*(Z|[+-]\d{2}(?::?\d{2})?)?)?"


def _iso_parts(text: Column, group: int) -> Column:
    return F.regexp_extract(text, "^" + ISO_TEXT + "$", group)


def parse_date(text: Column) -> Column:
    """Text -> DATE of an ISO date or date-time (the whole text must be one), NULL when empty or invalid."""
    return parse_datetime(text, shift=False).cast("date")


def parse_datetime(text: Column, shift: bool = True) -> Column:
    """ISO text -> zone-less TIMESTAMP, NULL when empty or invalid.

    Basic and extended forms, fractions to the microsecond. A text with a zone (Z or an offset) is moved to
    UTC (with ``shift=False`` its local time stays); one without is taken as it is.
    """
    day = F.concat_ws("-", *[_iso_parts(text, g) for g in (1, 2, 3)])
    time = F.concat_ws(":", *[F.when(_iso_parts(text, g) == "", "00").otherwise(_iso_parts(text, g)) for g in (4, 5, 6)])
    fraction = F.rpad(F.substring(_iso_parts(text, 7), 1, 6), 6, "0")
    whole = F.when(text.rlike("^" + ISO_TEXT + "$"), F.concat(day, F.lit(" "), time, F.lit("."), fraction))
    at = F.try_to_timestamp(whole, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")).cast("timestamp_ntz")
    if not shift:
        return at
    zone = F.regexp_replace(_iso_parts(text, 8), "[Z:]", "")
    minutes = F.when(zone == "", 0).otherwise(
        F.concat(F.substring(zone, 1, 1), F.lit("1")).cast("int")
        * (F.substring(zone, 2, 2).cast("int") * 60 + F.when(F.length(zone) > 3, F.substring(zone, 4, 2).cast("int")).otherwise(0))
    )
    return at - F.make_dt_interval(F.lit(0), F.lit(0), minutes)


def shrink_long(df: DataFrame, n: int = 5000, skip: Iterable[str] = ("sentence_embedding",)) -> DataFrame:
    """Cut text columns to n characters and array columns to n elements; others untouched."""
    skip = set(skip)
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in skip:
            cols.append(c)
        elif isinstance(f.dataType, T.StringType):
            cols.append(F.substring(c, 1, n).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType):
            cols.append(F.slice(c, 1, n).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def prompt_column(template: str, text: Column, placeholder: str = "{text}") -> Column:
    """Fill a prompt template with the text (ready for any batch inference step)."""
    return F.replace(F.lit(template), F.lit(placeholder), text)


def wrap_text(text: Column, width: int = 100) -> Column:
    """Wrap text at ``width`` characters, keeping long words whole and the original
    whitespace (a small per-row helper in Arrow batches; optional last step of a summary)."""
    import textwrap

    @F.pandas_udf(T.StringType())
    def _wrap(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else textwrap.fill(
            x, width=width, break_long_words=False, replace_whitespace=False))

    return _wrap(text)
