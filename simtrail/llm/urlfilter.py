"""URL filter: host and path rules, and for the rest a logistic regression on hashed character n-grams.

Byte n-grams of host and path (marked at both ends, digits taken alike) hash to one weight each; the
two parts have their own hash and are scaled to unit length apart, so a long path does not drown
the host. The regression is fitted by Newton steps on a small labelled URL table: with few rows and
many n-grams the weights are a combination of the rows, so a step solves one system of the rows' size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simtrail.llm.common import extended_schema, slices, utf8_bytes
from simtrail.llm.sampling import labelled_sample

BITS, ORDERS = 15, (2, 3, 4)
SPAN = 1 << 18
BLOCK, ALLOW = "block", "allow"
# (verdict, host, path): a rule holds for its host, all subdomains of it, and paths that start with its path.
RULES = [
    (BLOCK, "net", "/"),
    (ALLOW, "example.net", "/en/"),
    (BLOCK, "example.com", "/de/"),
    (ALLOW, "org", "/fr/"),
]

# Words of the labelled URL table, by hand: of sites one keeps out of a corpus, and of sites one keeps; and words
# that go with either.
UNWANTED = """
adult ads banner bets betting bingo bitcoin cams casino cheap click crack crypto dating diet escort fake farm free
gambling generic giveaway hot jackpot keygen loans lottery malware meds money nude payday pharma phishing pills poker
popup porn promo replica rich roulette sex singles slots spam torrent track tracker traffic viagra warez win xxx
""".split()
WANTED = """
anderson archive arts artist art-history astronomy atlantic biology book-reviews bread-and-salt breakfast brothers cambridge city-library
classical-music climate coast cooking country-life daily-news dictionary earthen education election engineering essays
family-doctor farmers-market festival film-journal football-club forest foundation garden geography gothic grammar
hand-made harbour harvest health heritage history honest-words hospital house-and-home inland interesting journal kitchen
language law-review leather library literature local-paper lighthouse magazine mathematics medicine methods military
mountain museum nation national-park nature neighbours north northern novels observer ocean open-data orchestra painting
parents parliament philosophy physics poetry politics public-health publisher railway recipes research river rotterdam
school science seasons shelter short-stories singing society south southern sports-page station story-teller strength student summer
teachers technology theatre thermal things-we-read thorne thunder times tradition train-travel translation travel
university trust village volunteers water weather whether wine-and-food winter women-in-science wood-work world-atlas writers youth
""".split()
EITHER = "online world house best my one club x city big".split()
# Shapes of the table's URLs, the same for both labels, so that only the names tell them apart.
FRONTS = ("http://www.", "https://", "http://blog.", "https://m.")
DOMAINS = (".com", ".org", ".net", ".example.com", ".example.org", ".example.net")
PATHS = ("/en/12", "/de/7.html", "/fr/3045/", "/es/88", "", "/", "/index.html", "/2019/05/story")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table (url, unwanted): every word in a few site names, shapes of URLs taken in turn."""
    rows = []
    for label, words in ((1, UNWANTED), (0, WANTED)):
        for i, word in enumerate(words):
            mate, other = EITHER[i % len(EITHER)], words[(i + 7) % len(words)]
            for name in (word, f"{word}-{mate}", f"{mate}-{word}") + ((f"{other}-{word}", other + word) if label else ()):
                at = zlib.crc32(name.encode())
                url = FRONTS[at % len(FRONTS)] + name + DOMAINS[at % len(DOMAINS)] + PATHS[at // 64 % len(PATHS)]
                rows.append((url, label))
    return spark.createDataFrame(rows, "url string, unwanted int")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and path (from there up to
    ``?``, ``#`` or the end); both empty for null and for a URL without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule (host and path as one string; of equal ones the first) and its verdict, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


_ALIKE = bytes(ord("0") if chr(c).isdigit() and c < 128 else c for c in range(256))


def part_grams(raw: bytes, salt: int) -> Iterator[np.ndarray]:
    """Weight numbers of the byte n-grams of one part, in spans of bounded size."""
    marked = b"\x02" + raw.translate(_ALIKE) + b"\x03"
    for at in range(0, len(marked), SPAN):
        a = np.frombuffer(marked[at : at + SPAN + max(ORDERS) - 1], np.uint8).astype(np.uint32)
        for order in ORDERS:
            n = min(SPAN, a.size - order + 1)
            if n <= 0:
                continue
            code = np.full(n, 0x811C9DC5 + 31 * order + salt, np.uint32)
            for i in range(order):
                code = (code ^ a[i : i + n]) * np.uint32(0x01000193)
            yield ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)


class Model:
    """One weight per hashed n-gram and a bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def score(self, host: bytes, path: bytes) -> float:
        """Probability that a URL is unwanted."""
        z = self.bias
        for salt, raw in enumerate((host, path)):
            total, n = 0.0, 0
            for some in part_grams(raw, salt):
                total += float(self.weights[some].sum())
                n += some.size
            z += total / max(n, 1) ** 0.5
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def fit(sample: list[tuple[bytes, bytes, int]], ridge: float = 0.01, steps: int = 30) -> Model:
    """Logistic regression with a ridge penalty on (host, path, label) rows; without rows every score is 0.5."""
    if not sample:
        return Model(np.zeros(1 << BITS), 0.0)
    x = np.zeros((len(sample), 1 << BITS))
    for row, (host, path, _) in zip(x, sample, strict=True):
        for salt, raw in enumerate((host, path)):
            found = np.concatenate([*part_grams(raw, salt), np.empty(0, np.int64)])
            np.add.at(row, found, 1 / max(found.size, 1) ** 0.5)
    y = np.array([label for *_, label in sample], float)
    kernel = x @ x.T + 1  # the bias is a constant feature
    share = np.zeros(len(y))  # the weights are x.T @ share
    for _ in range(steps):
        z = kernel @ share
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        curve = np.maximum(p * (1 - p), 1e-6)
        last, share = share, np.linalg.solve(kernel + np.diag(ridge / curve), z + (y - p) / curve)
        if np.abs(share - last).max() < 1e-10:
            break
    return Model(x.T @ share, float(share.sum()))


def judge(
    df: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", label_col: str = "unwanted",
    bound: int = 1000, threshold: float = 0.5,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (the longest fitting one, else null), ``verdict`` (the rule's; without a rule
    'block' if the score reaches ``threshold``, else 'allow') and ``score`` (0 to 1, higher: likelier unwanted; for every
    row, also where a rule decides).

    ``labelled`` is a small table of ``url`` and a 0/1 label; about ``bound`` rows a label are fitted, rows with a null
    or another label are left out, and without any row all scores are 0.5. A null url, one without ``://`` and an empty
    one have empty parts, fit no rule and get the score of two empty parts. A path shorter than a rule's does not fit it
    (``http://a.net`` has the path '' and does not start with '/'). Whole URLs of any length count; repeated rows are
    judged alike. Columns of ``df`` with the new names are replaced, others kept; an empty table gives an empty one.
    A narrow step: no shuffle.
    """
    known = labelled.where(f"{label_col} in (0, 1)")
    host, path = url_parts(F.col("url"))
    pairs = [(u, int(y)) for u, y in labelled_sample(known, known, "url", "url", label_col, bound)]
    spark = df.sparkSession
    split = spark.createDataFrame(pairs, "url string, y int").select(host.alias("h"), path.alias("p"), "y") if pairs else None
    sample = sorted((r.h.encode(), r.p.encode(), r.y) for r in split.collect()) if pairs else []
    sent = spark.sparkContext.broadcast(fit(sample))

    names = {"host", "path", "rule", "verdict", "score"}
    kept = [c for c in df.columns if c.lower() not in names]
    host, path = url_parts(F.col(url_col))
    parts = df.select(*kept, host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    schema, arrow = extended_schema(parts, [("score", T.DoubleType())])
    known_columns = parts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches):
            hosts, paths = utf8_bytes(batch.column("host")), utf8_bytes(batch.column("path"))
            scores = [model.score(h, p) for h, p in zip(hosts, paths, strict=True)]
            columns = [batch.column(c) for c in known_columns]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], schema=arrow)

    own = F.when(F.col("score") >= threshold, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return parts.mapInArrow(run, schema).select(
        *known_columns, rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "score"
    )
