"""Language identification by error-correcting output codes.

Every language has a codeword of bits; one binary classifier per bit (logistic
regression on hashed character n-gram frequencies) predicts it. A text gets the
language whose codeword has the least weighted loss against the predicted bits; a bit
weighs as much as its classifier is better than chance on rows kept out of the fit.
If the two nearest codewords are almost equally near, the row is flagged ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from simtrail.llm.common import extended_schema, slices
from simtrail.llm.sampling import TOTAL, labelled_sample

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
BUCKETS = 1 << 13
ORDERS = (1, 2, 3)
# Bytes counted at a time (bounds the memory a very long text needs).
SPAN = 1 << 20
# ASCII bytes that are no letters become a blank; bytes of other characters are kept.
BLANKED = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def features(text: str) -> np.ndarray:
    """Hashed counts of the byte 1- to 3-grams of the lower-cased text, square-rooted and of length 1."""
    raw = text.lower().encode().translate(BLANKED)
    raw = b" " + b" ".join(raw.split()) + b" "
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(raw), SPAN):
        a = np.frombuffer(raw[at : at + SPAN + max(ORDERS) - 1], np.uint8).astype(np.uint32)
        for order in ORDERS:
            n = min(SPAN, a.size - order + 1)
            if n <= 0:
                continue
            code = np.full(n, order, np.uint32)
            for i in range(order):
                code = code * np.uint32(0x01000193) ^ a[i : i + n]
            code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 13)
            counts += np.bincount(code, minlength=BUCKETS)
    out = np.sqrt(counts).astype(np.float32)
    norm = float(np.sqrt(counts.sum()))
    return out / norm if norm else out


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """One row of +1 / -1 per language, no two alike: all different splits of up to 5 languages, else random ones far apart."""
    if languages == 1:
        return np.ones((1, 1), np.int8)
    if languages <= 5:
        splits = [[1 if (s >> k) & 1 or k == 0 else -1 for k in range(languages)] for s in range(0, 2**languages, 2)]
        return np.array([c for c in splits if min(c) < 0], np.int8).T
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(languages)))
    best, apart = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (languages, bits))
        gaps = bits - code.astype(int) @ code.T.astype(int)
        np.fill_diagonal(gaps, 2 * bits)
        if gaps.min() > apart and (abs(code.sum(0)) < languages).all():
            best, apart = code, gaps.min()
    if best is None or apart <= 0:
        raise ValueError(f"no {bits}-bit code tells {languages} languages apart")
    return best


class Model:
    """Codewords, bit classifiers and their weights; small (8,192 x bits) and sent to every task."""

    def __init__(self, languages: list, code: np.ndarray, weights: np.ndarray, bias: np.ndarray, trust: np.ndarray, scale: float):
        self.languages, self.code, self.weights, self.bias, self.trust, self.scale = languages, code, weights, bias, trust, scale

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of every codeword, one row per text."""
        margin = x @ self.weights + self.bias
        loss = np.log1p(np.exp(-np.clip(margin[:, None, :] * self.code[None], -30, 30)))
        return (loss * self.trust).sum(2) / self.trust.sum()

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, its share of the softmax over all, and the lead over the second."""
        loss = self.losses(x)
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(len(x))
        e = np.exp(-self.scale * (loss - loss.min(1, keepdims=True)))
        share = e / e.sum(1, keepdims=True)
        first = order[:, 0]
        second = share[rows, order[:, 1]] if loss.shape[1] > 1 else np.zeros(len(x))
        return first, share[rows, first], share[rows, first] - second


def _descend(x: np.ndarray, y: np.ndarray, steps: int = 120, rate: float = 80.0, decay: float = 1e-5):
    """Logistic regression of several bits at once: full-batch descent with momentum."""
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        pull = -y / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30))) / len(x)
        vw = 0.9 * vw - rate * (1 - 0.9) * (x.T @ pull + decay * w)
        vb = 0.9 * vb - 1.0 * (1 - 0.9) * pull.sum(0)
        w, b = w + vw, b + vb
    return w, b


def fit(sample: list[tuple[str, str]]) -> Model | None:
    """Fit on (text, language) rows; every fifth is kept out to weigh the bits and to scale the scores."""
    sample = [(t, lang) for t, lang in sample if t and LETTER.search(t)]
    languages = sorted({lang for _, lang in sample})
    if not languages:
        return None
    index = {lang: i for i, lang in enumerate(languages)}
    x = np.stack([features(t) for t, _ in sample])
    code = codewords(len(languages))
    y = code[[index[lang] for _, lang in sample]].astype(np.float32)
    kept = np.arange(len(sample)) % 5 == 4
    if kept.sum() < 5 * len(languages):
        kept[:] = False
    w, b = _descend(x[~kept], y[~kept])
    check = kept if kept.any() else ~kept
    right = ((x[check] @ w + b) * y[check] > 0).mean(0)
    return Model(languages, code, w, b, np.maximum(2 * right - 1, 0.05), 12.0)


def identify(
    df: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    bound: int = 400, narrow: float = 0.05, total: int = TOTAL,
) -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` to every row of ``df``.

    The model is fitted on about ``bound`` rows per language of ``labelled`` (rows without text or language
    are left out), fewer where there are so many languages that ``total`` rows would be passed; every language is learned. Texts that are null, empty or without a letter, and all texts where nothing could be
    learned, get ``und`` with score 0, flagged ambiguous. Whole texts of any length are read; repeated rows are
    predicted alike; equal losses go to the language first in order. Columns of ``df`` with the new names are
    replaced, others kept; an empty table gives an empty one. A narrow step: no shuffle of ``df``.
    """
    model = fit(labelled_sample(labelled, labelled, id_col, text_col, lang_col, bound, total))
    sent = df.sparkSession.sparkContext.broadcast(model)
    schema, arrow = extended_schema(
        df, [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("ambiguous", T.BooleanType())]
    )
    kept = [f.name for f in schema.fields[:-3]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in slices(batches, 256):
            texts = batch.column(text_col).to_pylist()
            lang, score, close = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
            at = [i for i, t in enumerate(texts) if known is not None and t and LETTER.search(t)]
            if at:
                first, share, lead = known.decode(np.stack([features(texts[i]) for i in at]))
                for i, f, s, gap in zip(at, first, share, lead, strict=True):
                    lang[i], score[i], close[i] = known.languages[f], float(s), bool(gap < narrow)
            cols = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(close, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + cols, schema=arrow)

    return df.mapInArrow(run, schema)
