"""Encoders (I8) and the distinct-text lookup join.

An *encoder* turns a DataFrame with a text column into the same rows plus a
vector column. Two kinds are provided:

* :func:`hashed_encoder` — model-free hashed bag of words (row-local Arrow batches, no
  shuffle, a fixed rule that SQL can check);
* :func:`batch_encoder` — any Python batch model (a callable on a list of texts)
  run over Arrow batches with ``mapInPandas``; model loading happens once per task.

:func:`embed_unique` encodes each distinct text once and joins the vectors back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simtrail.functions.text import ACCENT_FROM, ACCENT_MULTI, ACCENT_TO, DEFAULT_STOPWORDS
from simtrail.operators.skew import ROWS_A_TASK, lookup_join

Encoder = Callable[[DataFrame, str, str], DataFrame]

# Accent folding as a translation, tokens of a folded text, tokens remembered per task (in each half) and rows encoded at once.
FOLD = {ord(a): b for a, b in [*ACCENT_MULTI, *zip(ACCENT_FROM, ACCENT_TO, strict=True)]}
TOKEN = re.compile("[0-9a-zA-Z]+")
FOLDED = re.compile(f"[{re.escape(''.join(map(chr, FOLD)))}]")
REMEMBERED_TOKENS = 50_000
ENCODED_ROWS = 1024


class _Buckets(dict):
    """Buckets of tokens, ``dim`` for a stopword, the latest tokens remembered per task (they repeat far more than they differ).

    A full memory becomes the older half and is asked once more before a token is hashed anew, so tokens in use stay."""

    def __init__(self, dim: int, stopwords: Iterable[str]):
        super().__init__()
        self.dim, self.stopwords, self.older = dim, frozenset(stopwords), {}

    def __missing__(self, token: str) -> int:
        got = self.older.get(token)
        if got is None:
            got = self.dim if token in self.stopwords else int.from_bytes(hashlib.md5(token.lower().encode()).digest()[:4]) % self.dim
        if len(self) >= REMEMBERED_TOKENS:
            self.older = dict(self)
            self.clear()
        self[token] = got
        return got


def _counts(text: str | None, buckets: _Buckets) -> np.ndarray | None:
    """Tokens a bucket (a token is a run of letters and digits of the accent-folded text, as in ``normalize_tokens``)."""
    # most texts have few folded characters: replacing those takes a fifth of a translation of the whole text
    folded = text if not text or text.isascii() else FOLDED.sub(lambda m: FOLD[ord(m[0])], text)
    tokens = TOKEN.findall(folded) if folded else []
    found = np.fromiter(map(buckets.__getitem__, tokens), np.int64, len(tokens))
    counts = np.bincount(found, minlength=buckets.dim + 1)[:buckets.dim].astype(np.float64)
    return counts if counts.any() else None


def hashed_vector(text: Column, dim: int = 64, stopwords: Iterable[str] | None = None) -> Column:
    """I8 default: token counts per bucket divided by their L2 norm; NULL for text without tokens. The bucket of a
    normalised token is the number of the first 8 hex digits of its md5, modulo ``dim`` (up to 10,000).

    Arrow batches: with each frequent token hashed once a task this costs about a tenth of the same rule written
    as column functions, which fold and hash every token anew.
    """
    if not 0 < dim <= 10_000:
        raise ValueError("hashed_vector supports 1 to 10,000 buckets")
    stop = list(DEFAULT_STOPWORDS if stopwords is None else stopwords)

    @F.arrow_udf("array<double>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        buckets = _Buckets(dim, stop)

        def encoded(texts: list[str | None]) -> pa.Array:
            counts = [_counts(t, buckets) for t in texts]
            there = [c / np.sqrt((c * c).sum()) for c in counts if c is not None]
            null = np.array([c is None for c in counts] + [False])
            ends = np.concatenate([[0], np.cumsum(~null[:-1]) * dim]).astype(np.int32)
            values = pa.array(np.concatenate(there) if there else np.empty(0))
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32(), mask=null), values)

        for texts in batches:
            # a few texts as Python strings at a time, however long the batch
            parts = [encoded(texts.slice(at, ENCODED_ROWS).to_pylist()) for at in range(0, len(texts), ENCODED_ROWS)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float64()))

    return vectors(text.cast("string"))


def hashed_encoder(dim: int = 64, stopwords: Iterable[str] | None = None) -> Encoder:
    def enc(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        return df.withColumn(out_col, hashed_vector(F.col(text_col), dim, stopwords))

    return enc


def batch_encoder(model_factory: Callable[[], Callable[[list[str]], list[list[float]]]]) -> Encoder:
    """Wrap a batch model: ``model_factory()`` is called once per task and returns a function
    mapping a list of texts to a list of vectors."""

    def enc(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.ArrayType(T.DoubleType()))])

        def run(it):
            model = model_factory()
            for pdf in it:
                texts = pdf[text_col].fillna("").astype(str).tolist()
                vecs = model(texts) if texts else []
                pdf[out_col] = [list(map(float, v)) if v is not None else None for v in vecs]
                yield pdf

        return df.mapInPandas(run, schema)

    return enc


def embed_unique(
    df: DataFrame, text_col: str, encoder: Encoder, out_col: str = "sentence_embedding", hot_rows: int = ROWS_A_TASK
) -> DataFrame:
    """Encode each distinct text once (D10), then look the vectors up by text.

    Copies of a text are dropped in the tasks that read them, before the shuffle. The look-up joins on the text's 64-bit
    hash with the exact text as a residual condition; a text in more than ``hot_rows`` rows is found by a sketch
    and its rows are dealt over several tasks (:mod:`simtrail.operators.skew`). NULL texts get a NULL vector. Column order:
    the text first.
    """
    uniq = df.select(text_col).where(F.col(text_col).isNotNull()).distinct()
    vecs = encoder(uniq, text_col, out_col).select(text_col, out_col)
    base = df.drop(out_col) if out_col in df.columns else df
    rest = [c for c in base.columns if c != text_col]
    # rows of one text differ in their other columns (maps have no hash)
    spread = [f.name for f in base.schema.fields if f.name in rest and not isinstance(f.dataType, T.MapType)] or [text_col]
    return lookup_join(base, vecs, text_col, spread, "left", hot_rows).select(text_col, *rest, out_col)
