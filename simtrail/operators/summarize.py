"""Model-free summaries and keywords per ticket (I3–I7, H3, H4) as Spark jobs.

Hosted language models are replaced by an extractive
ranker with fixed rules, so Spark and SQL agree exactly:

* tokens: normalised text (H5) split on blanks;
* sentences: text split on ``[.\\n]+``, stripped, empty ones dropped, position kept;
* sentence score: mean, over the sentence's distinct tokens, of the token's count in
  the whole ticket; rounded to 6; order score desc, position asc; 0 without tokens;
* map-reduce: best sentences of each piece; while a ticket's kept sentences, joined, are longer than the
  budget, neighbouring groups are merged and cut to their best again; then the best of what is left;
* refine: the pieces in order, an answer of n sentences carried along; a sentence counts less the more of its
  tokens the answer has, so a piece that repeats what is known changes nothing;
* keywords: tf * ln((N + 1) / (df + 1)) over tickets, rounded to 6, weight desc,
  term asc, first 8, joined with a blank.

Plan: sentences are exploded once; token counts per (ticket, token) are a hash
aggregate (map-side partial); scores are a join on (ticket, token) and an
aggregate on (ticket, sentence). No key is a single ticket, so a huge ticket is
spread over many tasks. The model steps stay pluggable (``step_fn`` for refine).
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simtrail.functions.text import clean_output, extract_topic, let, normalize_tokens, strip_ws, wrap_text
from simtrail.operators.chunk import split_pieces
from simtrail.operators.skew import ROWS_A_TASK, lookup_join

SENTENCE_SPLIT = "[.\\n]+"
SUMMARY_JOIN = ". "
# Characters of a ticket's partial summaries, joined, that need no further merging.
REDUCE_BUDGET = 4000


def sentences(df: DataFrame, key: str = "ticket_id", text: str = "ticket_comment",
              pieces: Column | None = None, max_pieces: int | None = None) -> DataFrame:
    """(key, piece, pos, sentence): one row per non-empty sentence. With ``pieces`` (an array
    column of text pieces) sentences are numbered inside each piece; ``max_pieces`` keeps
    only the first pieces (B11)."""
    if pieces is None:
        p = df.select(key, F.lit(0).alias("piece"), F.col(text).alias("_t"))
    else:
        arr = F.slice(pieces, 1, max_pieces) if max_pieces else pieces
        p = df.select(key, F.posexplode_outer(arr).alias("piece", "_t")).where(F.col("_t").isNotNull())
    # *_outer generators throughout: a plain explode makes Spark infer size(array) > 0 and push
    # the (expensive) array expression below any exchange into the scan
    s = p.select(key, "piece", F.posexplode_outer(F.split(F.col("_t"), SENTENCE_SPLIT)).alias("pos", "_s"))
    return s.select(key, "piece", "pos", strip_ws(F.col("_s")).alias("sentence")).where(F.col("sentence") != "")


def term_counts(df: DataFrame, key: str = "ticket_id", text: str = "ticket_comment") -> DataFrame:
    """(key, token, tf): token counts per ticket (hash aggregate with partial combine)."""
    t = df.select(key, F.explode_outer(normalize_tokens(F.col(text))).alias("token")).where(F.col("token").isNotNull())
    return t.groupBy(key, "token").agg(F.count(F.lit(1)).alias("tf"))


def score_sentences(sent: DataFrame, tf: DataFrame, key: str = "ticket_id") -> DataFrame:
    """Adds ``score`` to every sentence row (see module rules)."""
    toks = sent.select(key, "piece", "pos", F.explode_outer(F.array_distinct(normalize_tokens(F.col("sentence")))).alias(
        "token")).where(F.col("token").isNotNull())
    scored = toks.join(tf, [key, "token"]).groupBy(key, "piece", "pos").agg(
        F.round(F.sum("tf") / F.count(F.lit(1)), 6).alias("score"))
    return sent.join(scored, [key, "piece", "pos"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def _best(scored: DataFrame, n: int, by: list[str], key: str = "ticket_id") -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("piece").asc(), F.col("pos").asc())
    return scored.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def _join_in_order(rows: DataFrame, key: str, out: str) -> DataFrame:
    # at most a handful of sentences per ticket (bounded by the rule), joined in text order
    agg = F.expr(f"listagg(sentence, '{SUMMARY_JOIN}') WITHIN GROUP (ORDER BY piece, pos)")
    return rows.groupBy(key).agg(agg.alias(out))


def summarize_stuff(df: DataFrame, key: str = "ticket_id", text: str = "ticket_comment", n: int = 3) -> DataFrame:
    """I4: best n sentences over the whole ticket, in text order, joined with '. '."""
    sc = score_sentences(sentences(df, key, text), term_counts(df, key, text), key)
    return _join_in_order(_best(sc, n, [key], key), key, "summary")


def _merge_rounds(mapped: DataFrame, key: str, per_group: int, budget: int, fan_in: int, rounds: int) -> DataFrame:
    """Tree reduce: kept sentences of tickets over ``budget`` characters, cut to the best of merged groups, round by round."""
    kept = mapped.withColumn("grp", F.col("piece"))
    for _ in range(rounds):
        whole = Window.partitionBy(key)
        chars = F.sum(F.length("sentence") + len(SUMMARY_JOIN)).over(whole) - len(SUMMARY_JOIN)
        sized = kept.withColumn("_over", chars > budget)
        merged = sized.withColumn("grp", F.when(F.col("_over"), F.floor(F.col("grp") / fan_in)).otherwise(F.col("grp")).cast("int"))
        best = Window.partitionBy(key, "grp").orderBy(F.col("score").desc(), F.col("piece").asc(), F.col("pos").asc())
        place = F.row_number().over(best)
        kept = merged.withColumn("_r", place).where(~F.col("_over") | (F.col("_r") <= per_group)).drop("_r", "_over")
    return kept.drop("grp")


def summarize_map_reduce(df: DataFrame, key: str = "ticket_id", text: str = "ticket_comment", per_piece: int = 2,
                         n: int = 3, max_pieces: int | None = None, with_steps: bool = False, wrap_width: int | None = None,
                         budget: int = REDUCE_BUDGET, fan_in: int = 2, rounds: int | None = None, **piece):
    """map = best ``per_piece`` sentences of each piece (of the first ``max_pieces``, if given); reduce = merge the
    groups of ``fan_in`` neighbouring pieces and keep their best ``per_piece``, as long as the ticket's sentences joined
    are longer than ``budget`` characters; then the best n, in text order, joined with '. '. A sentence in the overlap of
    two pieces counts once, in the first.

    ``rounds`` defaults to what merges all pieces of the longest ticket into one group (counted). ``piece``: size, overlap
    and separator of the pieces. With ``with_steps`` also returns the intermediate (map) results."""
    sent = sentences(df, key, text, pieces=split_pieces(F.col(text), **piece), max_pieces=max_pieces)
    sc = score_sentences(sent, term_counts(df, key, text), key)
    mapped = _best(sc, per_piece, [key, "piece"], key)
    again = Window.partitionBy(key, "sentence").orderBy("piece", "pos")
    mapped = mapped.withColumn("_r", F.row_number().over(again)).where(F.col("_r") == 1).drop("_r")
    if rounds is None:
        most = df.agg(F.max(F.size(split_pieces(F.col(text), **piece)))).first()[0] or 1
        most = min(most, max_pieces or most)
        rounds = max(0, math.ceil(math.log(max(most, 1), fan_in)))
    kept = _merge_rounds(mapped, key, per_piece, budget, fan_in, rounds)
    out = _join_in_order(_best(kept, n, [key], key), key, "summary")
    if wrap_width:
        out = out.withColumn("summary", wrap_text(F.col("summary"), wrap_width))
    return (out, mapped) if with_steps else out


def ticket_topic(df: DataFrame, key: str = "ticket_id", text: str = "ticket_comment") -> DataFrame:
    """I6 + H3: the best sentence, then the text between double asterisks if any."""
    sc = score_sentences(sentences(df, key, text), term_counts(df, key, text), key)
    best = _best(sc, 1, [key], key)
    return best.select(key, extract_topic(F.col("sentence")).alias("topic"))


def ticket_keywords(df: DataFrame, key: str = "ticket_id", text: str = "ticket_comment", n: int = 8,
                    hot_rows: int = ROWS_A_TASK) -> DataFrame:
    """I7 + H4: TF-IDF keywords per ticket (document frequency over all tickets).

    A token in more than ``hot_rows`` tickets is dealt over several tasks when its frequency is looked up."""
    tf = term_counts(df, key, text)
    n_docs = df.select(key).distinct().agg(F.count(F.lit(1))).scalar()  # scalar subquery
    dfreq = tf.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    w = lookup_join(tf, dfreq, "token", [key], "inner", hot_rows).select(
        key, "token",
        F.round(F.col("tf") * F.log((n_docs + 1) / (F.col("df") + 1)), 6).alias("weight"))
    win = Window.partitionBy(key).orderBy(F.col("weight").desc(), F.col("token").asc())
    top = w.withColumn("_r", F.row_number().over(win)).where(F.col("_r") <= n)
    agg = F.expr("listagg(token, ' ') WITHIN GROUP (ORDER BY weight DESC, token)")
    return top.groupBy(key).agg(clean_output(agg).alias("keywords"))


def _refined(pieces: Column, n: int) -> Column:
    """Fold of an array of (piece, candidates), in order, to an array of at most n chosen sentences."""
    state = "array<struct<weight: double, piece: int, pos: int, sentence: string, tokens: array<string>>>"

    def weighed(known: Column, c: Column) -> Column:
        shared = F.size(F.array_intersect(c["tokens"], known))
        return F.struct(F.round(c["score"] / (shared + 1), 6).alias("weight"), (-c["piece"]).alias("piece"), (-c["pos"]).alias("pos"),
                        c["sentence"].alias("sentence"), c["tokens"].alias("tokens"))

    def step(answer: Column, piece: Column) -> Column:
        known = F.flatten(F.transform(answer, lambda a: a["tokens"]))
        # the greatest (weight, -piece, -pos): the heaviest, of equal ones the first in the text
        return let(known, lambda k: let(F.array_max(F.transform(piece["candidates"], lambda c: weighed(k, c))), lambda best: let(
            F.array_min(answer), lambda worst: F.when(F.size(answer) < n, F.concat(answer, F.array(best)))
            .when(best["weight"] > worst["weight"], F.concat(F.filter(answer, lambda a: a != worst), F.array(best)))
            .otherwise(answer))))

    return F.aggregate(pieces, F.array().cast(state), step)


def summarize_refine(df: DataFrame, key: str = "ticket_id", text: str = "ticket_comment", n: int = 3,
                     max_pieces: int | None = None, per_piece: int = 3,
                     step_fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame] | None = None, **piece) -> DataFrame:
    """Ordered fold over the pieces of each ticket carrying the answer so far.

    Default step: the candidates are the piece's best ``per_piece`` sentences; each weighs its score divided by one plus the
    number of its distinct tokens that the answer has. The heaviest one joins the answer, in place of its
    lightest sentence once there are n, if that weighs less. The answer is in text order, joined with '. '.
    ``step_fn(so_far, piece_rows) -> new so_far`` plugs in any model; it runs as ``applyInPandas`` over one ticket's
    scored sentences. ``piece``: size, overlap and separator of the pieces.
    """
    sent = sentences(df, key, text, pieces=split_pieces(F.col(text), **piece), max_pieces=max_pieces)
    sc = score_sentences(sent, term_counts(df, key, text), key)
    if step_fn is None:
        best = _best(sc, per_piece, [key, "piece"], key)
        tokens = F.array_distinct(normalize_tokens(F.col("sentence"))).alias("tokens")
        candidate = F.struct("score", F.col("piece").cast("int").alias("piece"), F.col("pos").cast("int").alias("pos"), "sentence", tokens)
        by_piece = best.groupBy(key, "piece").agg(F.collect_list(candidate).alias("candidates"))  # per_piece at most
        folded = by_piece.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("piece", "candidates"))).alias("_p"))
        chosen = folded.select(key, F.sort_array(F.transform(_refined(F.col("_p"), n), lambda a: F.struct(
            (-a["piece"]).alias("piece"), (-a["pos"]).alias("pos"), a["sentence"].alias("sentence")))).alias("_a"))
        return chosen.select(key, F.array_join(F.transform("_a", lambda a: a["sentence"]), SUMMARY_JOIN).alias("summary"))
    out_schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("summary", T.StringType())])

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        so_far = pdf.iloc[0:0]
        for _, rows in pdf.sort_values(["piece", "pos"]).groupby("piece", sort=True):
            so_far = step_fn(so_far, rows)
        best = so_far.sort_values(["piece", "pos"])
        return pd.DataFrame({key: [pdf[key].iloc[0]], "summary": [SUMMARY_JOIN.join(best["sentence"].tolist())]})

    return sc.select(key, "piece", "pos", "sentence", "score").groupBy(key).applyInPandas(fold, out_schema)
