"""Text splitting (I1, I2, B11) and fixed token windows.

* :func:`split_pieces` — split on a separator and greedily pack the parts up to a
  character budget, carrying the last parts of a piece into the next as overlap (Arrow batches);
* :func:`chunk_windows` — blank-separated tokens in windows of n, rejoined;
* :func:`recursive_chunks` — recursive split (paragraph, line, word, character)
  under a token budget with a pluggable token counter, in Arrow batches.

Each returns an array column; ``posexplode`` gives one row per piece.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simtrail.functions.text import let

# Library defaults of the piece splitter used before summarising.
PIECE_SEPARATOR = "\n\n"
PIECE_SIZE = 4000
PIECE_OVERLAP = 200
# White space that is stripped from a piece.
BLANKS = " \t\n\x0b\f\r"
# Chunk feed budget and the recursive separators (coarse to fine).
CHUNK_TOKENS = 512
RECURSIVE_SEPARATORS = ["\n\n", "\n", " ", ""]


def piece_bounds(lengths: np.ndarray, sep: int, size: int, overlap: int) -> list[tuple[int, int]]:
    """First and past-the-last part of every piece, for parts of the given lengths joined by ``sep`` characters.

    A piece takes parts while the joined length stays within ``size`` (a longer part is a piece of its own). The next
    one starts with the longest run of last parts that is within ``overlap`` and leaves room for the next part. Found
    by search in the running lengths, so a text costs its parts once and each piece two look-ups.
    """
    many = len(lengths)
    ends = np.concatenate([[0], np.cumsum(lengths + sep)])  # ends[i]: length of the first i parts with separators
    out, first, past = [], 0, 0
    while past < many:
        past = max(past + 1, int(np.searchsorted(ends, ends[first] + size + sep, side="right")) - 1)
        out.append((first, past))
        if past < many:
            room = min(overlap, size - sep - int(lengths[past]))
            first = min(past, int(np.searchsorted(ends, ends[past] - sep - room, side="left")))
    return out


def pieces_of(text: str | None, separator: str, size: int, overlap: int) -> list[str] | None:
    """I1 for one text (None for None)."""
    if text is None:
        return None
    parts = [x for x in text.split(separator) if x]
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    found = [separator.join(parts[a:b]).strip(BLANKS) for a, b in piece_bounds(lengths, len(separator), size, overlap)]
    return [x for x in found if x]


def split_pieces(
    text: Column, separator: str = PIECE_SEPARATOR, size: int = PIECE_SIZE, overlap: int | None = None
) -> Column:
    """Non-empty parts between separators packed greedily while the joined length stays <= ``size`` (a longer part
    stays whole), each piece beginning with up to ``overlap`` characters of whole parts of the one before; pieces stripped,
    empty ones dropped. NULL for NULL, no piece for an empty text. ``overlap`` defaults to 200, or ``size`` if that is less."""
    overlap = min(PIECE_OVERLAP, size) if overlap is None else overlap
    if not separator or size <= 0 or not 0 <= overlap <= size:
        raise ValueError("needs a separator, a positive size and an overlap between 0 and the size")

    @F.arrow_udf("array<string>")
    def pack(texts: pa.Array) -> pa.Array:
        return pa.array([pieces_of(t, separator, size, overlap) for t in texts.to_pylist()], pa.list_(pa.string()))

    return pack(text)


def summary_pieces(text: Column, n: int = 4, **kw) -> Column:
    """The first n pieces."""
    return F.slice(split_pieces(text, **kw), 1, n)


def chunk_windows(text: Column, n: int = CHUNK_TOKENS) -> Column:
    """Blank-separated tokens in windows of n (no overlap), each rejoined with one blank.
    Empty text gives no chunk."""
    def windows(toks: Column) -> Column:
        k = F.ceil(F.size(toks) / F.lit(n)).cast("int")
        idx = F.when(k > 0, F.sequence(F.lit(0), k - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(idx, lambda i: F.array_join(F.slice(toks, i * n + 1, n), " "))

    # the token array is bound once (the per-window lambda would otherwise re-split the text)
    return let(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"\s+"), ""), windows)


def word_count(text: str) -> int:
    """Default token counter: blank-separated words."""
    return len(text.split())


def _pack(parts: list[str], budget: int, count: Callable[[str], int]) -> list[str]:
    """Greedy packing of consecutive parts while the summed token count stays within budget.
    Parts carry their leading separator, so the counter is assumed additive over them."""
    out, cur, n = [], [], 0
    for p in parts:
        c = count(p)
        if cur and n + c > budget:
            out.append("".join(cur))
            cur, n = [p], c
        else:
            cur.append(p)
            n += c
    if cur:
        out.append("".join(cur))
    return out


def _recursive(text: str, seps: Sequence[str], budget: int, count: Callable[[str], int]) -> list[str]:
    if count(text) <= budget:
        return [text]
    for i, sep in enumerate(seps):
        if sep == "":
            # last resort: characters, packed up to the budget
            return _pack(list(text), budget, count)
        if sep in text:
            rest = seps[i + 1:]
            pieces = text.split(sep)
            # keep the separator at the start of the following piece
            parts = [pieces[0]] + [sep + p for p in pieces[1:]]
            out: list[str] = []
            for p in _pack([p for p in parts if p], budget, count):
                out.extend(_recursive(p, rest, budget, count) if count(p) > budget else [p])
            return out
    return [text]


def split_recursive(text: str, budget: int = CHUNK_TOKENS, count: Callable[[str], int] = word_count,
                    separators: Sequence[str] = RECURSIVE_SEPARATORS) -> list[str]:
    """I2 for one text: chunks under ``budget`` tokens, stripped, empty ones dropped."""
    if not text:
        return []
    return [c.strip() for c in _recursive(text, list(separators), budget, count) if c.strip()]


def recursive_chunks(df: DataFrame, text_col: str, out_col: str = "chunks", budget: int = CHUNK_TOKENS,
                     counter_factory: Callable[[], Callable[[str], int]] | None = None) -> DataFrame:
    """I2 over a DataFrame: adds ``out_col`` (array<string>) computed in Arrow batches.

    ``counter_factory`` is called once per batch iterator (load a tokenizer there)."""
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.ArrayType(T.StringType()))])

    def run(it):
        count = counter_factory() if counter_factory else word_count
        for pdf in it:
            pdf[out_col] = pd.Series([split_recursive(t, budget, count) if isinstance(t, str) else []
                                      for t in pdf[text_col]], index=pdf.index, dtype=object)
            yield pdf

    return df.mapInPandas(run, schema)
