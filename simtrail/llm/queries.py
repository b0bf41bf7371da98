"""Registered queries of the corpus operators, one per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simtrail.llm import ann, bpe, collocation, extract, jaccard, langid, packing, pq, quality, sharding, urlfilter, warc, whitening
from simtrail.llm.common import table
from simtrail.llm.sampling import crc_mod

# Shard size of the sharding query, in bytes of text.
SHARD_BYTES = 1 << 20
# The vocabulary of the token queries; every operator takes its path as a parameter.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back from the archives."""
    records = warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")))
    body_digest = F.sha2("payload", 256)
    return records.select(
        warc.record_key("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        F.when(F.col("record_type") == "response", body_digest).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        warc.record_key("refers_to").alias("refers_to"),
    )


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of 3-word shingles have a Jaccard similarity of at least 0.9."""
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"), size=3, percent=90)


def op3_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract.extract(pages)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them (by the id's crc32)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    found = langid.identify(docs.select("doc_id", "text"), docs.where(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine at least 0.9 among all vectors."""
    return pq.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, none over 1 MiB of text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, SHARD_BYTES).select("doc_id", "shard_id", "depth", "n_bytes")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from four fifths of the labelled ones (by the id's crc32)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    marks = table(spark, sf_dir, "labels").where(~held_out & F.col("quality").isNotNull()).select("doc_id", "quality")
    found = quality.score_quality(docs, marks)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode(docs, TOKENIZER, decoded_col="decoded")
    return out.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def packed_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and packed into sequences of at most 2048 tokens."""
    return packed_digest(packing.pack(table(spark, sf_dir, "documents"), TOKENIZER))


def op11_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of two and three words of each language."""
    return collocation.collocations(table(spark, sf_dir, "documents"), least=10, top=2000, percent=50)


def op12_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: the rules, else a classifier fitted on the small labelled table."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, urlfilter.labelled_urls(spark), urlfilter.RULES).drop("url")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of every vector, covariance from exact integer products."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), scale=64.0, components=32)


REGISTRY = {
    "op1_warc": op1_warc,
    "op2_jaccard": op2_jaccard,
    "op3_extract": op3_extract,
    "op4_language": op4_language,
    "op5_bpe": op5_bpe,
    "op6_ann": op6_ann,
    "op7_neardup": op7_neardup,
    "op8_sharding": op8_sharding,
    "op9_quality": op9_quality,
    "op10_packing": op10_packing,
    "op11_collocation": op11_collocation,
    "op12_urlfilter": op12_urlfilter,
    "op13_whitening": op13_whitening,
}
ORACLE: dict[str, str] = {
    "op11_collocation": r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), p AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (
  SELECT lang, [x for x in string_split_regex(piece, '[\x20\x09]+') if x <> ''] AS ws FROM p
), g AS (
  SELECT lang, ws[i] AS w1, ws[i + 1] AS w2, ws[i + 2] AS w3
  FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)
), c1 AS (
  SELECT lang, w1, count(*) AS n FROM g GROUP BY ALL
), c2 AS (
  SELECT lang, w1, w2, count(*) AS n FROM g WHERE w2 IS NOT NULL GROUP BY ALL
), c3 AS (
  SELECT lang, w1, w2, w3, count(*) AS n FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), longer AS (
  SELECT lang, w1, w2, max(n) AS n
  FROM (SELECT lang, w1, w2, n FROM c3 UNION ALL SELECT lang, w2, w3, n FROM c3) GROUP BY lang, w1, w2
), cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.n AS a, 1 AS k, x.n AS l, y.n AS r
  FROM c2 c JOIN c1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN c1 y ON y.lang = c.lang AND y.w1 = c.w2
  LEFT JOIN longer o ON o.lang = c.lang AND o.w1 = c.w1 AND o.w2 = c.w2
  WHERE c.n >= 10 AND 100 * coalesce(o.n, 0) < 50 * c.n
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.n, 1, x.n, y.n
  FROM c3 c JOIN c1 x ON x.lang = c.lang AND x.w1 = c.w1
  JOIN c2 y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.n, 2, x.n, y.n
  FROM c3 c JOIN c2 x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2
  JOIN c1 y ON y.lang = c.lang AND y.w1 = c.w3
), scored AS (
  SELECT *, (CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS score FROM cuts
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), total AS (
  SELECT lang, count(*) AS n FROM g GROUP BY lang
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, total.n AS n, CAST(score AS BIGINT) AS score
FROM best JOIN total USING (lang)
QUALIFY rank <= 2000
""",
    "op1_warc": """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.first_id < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id < p.page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f ON f.payload_digest = p.payload_digest
""",
    "op8_sharding": f"""
WITH d AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents
), levels AS (
  SELECT depth, h >> (60 - depth) AS bucket, sum(n_bytes) AS bytes
  FROM d, (SELECT CAST(unnest(range(0, 61)) AS INTEGER) AS depth) GROUP BY ALL
), fits AS (
  SELECT d.doc_id, min(l.depth) AS depth
  FROM d JOIN levels l ON l.bucket = d.h >> (60 - l.depth)
  WHERE l.bytes <= {SHARD_BYTES} GROUP BY d.doc_id
)
SELECT d.doc_id, f.depth || '-' || (d.h >> (60 - f.depth)) AS shard_id, CAST(f.depth AS INTEGER) AS depth, d.n_bytes
FROM d JOIN fits f USING (doc_id)
""",
}
