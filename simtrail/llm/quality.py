"""Quality score by supervised subword embeddings.

Words, word trigrams and character n-grams (3 and 4 bytes) hash to rows of an embedding table;
a document is the mean of its rows, a linear layer and a softmax give the classes. Word
trigrams are taken in relative form (which of the three words are the same), so that what is
learned of repetition holds for words never seen. Table and layer
are trained together by stochastic gradient descent in numpy. As the softmax sees only a
linear function of the mean, the fitted table folds to one number per bucket (the row
times the difference of the two output vectors), and scoring adds up looked-up numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from simtrail.llm.common import extended_schema, slices, utf8_bytes
from simtrail.llm.sampling import labelled_sample

BITS = 16
BUCKETS = 1 << BITS
ORDERS = (3, 4)
# First of the rows (buckets beyond the hashed ones) of the relative word trigrams.
PATTERNS = BUCKETS
ROWS = BUCKETS + 8
SPAN = 1 << 20
MEMORY_WORDS = 200_000


class WordBuckets(dict):
    """Bucket of a word, remembered per task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word) >> (64 - BITS)
        return got


def buckets(raw: bytes, words: WordBuckets) -> Iterator[np.ndarray]:
    """Table rows of the words, word trigrams and byte n-grams of a text, in spans of bounded size."""
    parts = raw.split()
    for at in range(0, len(parts), SPAN // 8):
        some = parts[at : at + SPAN // 8]
        ids = np.fromiter(map(words.__getitem__, some), np.int64, len(some))
        yield ids
        if ids.size > 2:
            same, skip = ids[1:] == ids[:-1], ids[2:] == ids[:-2]
            yield PATTERNS + same[:-1] + 2 * same[1:] + 4 * skip
    for at in range(0, len(raw), SPAN):
        a = np.frombuffer(raw[at : at + SPAN + max(ORDERS) - 1], np.uint8).astype(np.uint32)
        for order in ORDERS:
            n = min(SPAN, a.size - order + 1)
            if n <= 0:
                continue
            code = np.full(n, 0x811C9DC5 + order, np.uint32)
            for i in range(order):
                code = (code ^ a[i : i + n]) * np.uint32(0x01000193)
            yield ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)


class Model:
    """One number per bucket and a bias: the difference of the two classes' outputs."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table, bias

    def score(self, raw: bytes | None, words: WordBuckets) -> float:
        total, n = 0.0, 0
        for some in buckets(raw or b"", words):
            total += float(self.table[some].sum(dtype=np.float64))
            n += some.size
        return float(1 / (1 + np.exp(-np.clip(total / max(n, 1) + self.bias, -60, 60))))


def train(
    sample: list[tuple[str, int]], dim: int = 12, epochs: int = 4, rate: float = 0.4, seed: int = 3
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedding table, output vectors and biases learned from (text, label) rows with label 0 or 1."""
    words, rng = WordBuckets(), np.random.default_rng(seed)
    docs = []
    for text, label in sample:
        found = np.concatenate([*buckets((text or "").encode(), words), np.empty(0, np.int64)])
        at, n = np.unique(found, return_counts=True)
        docs.append((at, (n / max(found.size, 1)).astype(np.float32), int(label)))
    table = ((rng.random((ROWS, dim)) - 0.5) / dim).astype(np.float32)
    out = ((rng.random((dim, 2)) - 0.5) / dim).astype(np.float32)
    bias = np.zeros(2, np.float32)
    counts = np.bincount([label for *_, label in docs], minlength=2)
    weight = np.minimum(len(docs) / (2 * np.maximum(counts, 1)), 4.0)  # the rarer label counts as much, up to 4 times
    epochs = max(epochs, min(40, 8000 // len(docs)))  # few rows are seen more often
    steps, step = epochs * len(docs), 0
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            at, share, label = docs[i]
            pace = rate * (1 - step / steps)
            step += 1
            mean = share @ table[at]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            p *= weight[label]
            pull = out @ p
            out -= pace * np.outer(mean, p)
            bias -= pace * 0.1 * p
            # a bucket's share of the mean is small: rows move by the share relative to the largest
            table[at] -= np.outer((pace * 20) * share, pull)
    return table, out, bias


def fit(sample: list[tuple[str, int]], **training) -> Model | None:
    """The trained layers folded to one number per bucket; None without rows."""
    if not sample:
        return None
    table, out, bias = train(sample, **training)
    return Model((table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def score_quality(
    df: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    bound: int = 2000, threshold: float = 0.3,
) -> DataFrame:
    """Add ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 if score >= threshold) to every row.

    The model is fitted on about ``bound`` rows per label of ``labelled``: ids with label 0 or 1 (others are left out),
    with their texts, or without, if they are the texts of ``df``. Null and empty texts get the score of the bias alone;
    without any labelled row every score is 0.5. Whole texts of any length count; repeated rows score alike.
    Columns of ``df`` with the new names are replaced, others kept; an empty table gives an empty one.
    A narrow step: no shuffle of ``df``.
    """
    rows = labelled.where(f"{label_col} in (0, 1)")
    texts = rows if text_col in labelled.columns else df
    model = fit(labelled_sample(texts, rows, id_col, text_col, label_col, bound))
    sent = df.sparkSession.sparkContext.broadcast(model)
    schema, arrow = extended_schema(df, [("score", T.DoubleType()), ("predicted", T.IntegerType())])
    kept = [f.name for f in schema.fields[:-2]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known = WordBuckets(), sent.value
        for batch in slices(batches):
            texts = utf8_bytes(batch.column(text_col))
            scores = [known.score(t, words) if known is not None else 0.5 for t in texts]
            cols = [pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + cols, schema=arrow)

    return df.mapInArrow(run, schema)
