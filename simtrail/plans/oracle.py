"""DuckDB SQL twins of the registered queries (the correctness oracle).

Fixture views are written once as CTE text and reused; scalar expressions that
must equal the Spark ones are generated from the same constants
(:mod:`simtrail.functions.text`).
"""

from __future__ import annotations

from simtrail.functions import text as tx

# ------------------------------------------------------------------ fixture CTEs
def paragraphs_sql(x: str) -> str:
    return f"replace(replace({x}, chr(10), chr(10) || chr(10)), '. ', '.' || chr(10) || chr(10))"


TICKETS = f"""v_tickets AS (
  SELECT conv_id AS ticket_id, {paragraphs_sql('text')} AS ticket_comment, string_split(text, chr(10))[1] AS subject,
         'mod' || CAST(conv_id % 5 AS VARCHAR) AS module_name,
         'prod' || CAST(conv_id % 3 AS VARCHAR) AS product_name,
         role AS ticket_status,
         TIMESTAMP '2024-01-01' + to_days(CAST(conv_id AS INTEGER)) AS created_at,
         TIMESTAMP '2024-01-01' + to_days(CAST(conv_id AS INTEGER)) + to_hours(CAST(turn AS BIGINT)) AS updated_at,
         TIMESTAMP '2024-01-01' + to_days(CAST(conv_id AS INTEGER)) + to_minutes(CAST(turn // 2 AS BIGINT)) AS comment_created_at
  FROM conversations)"""

CORPUS = """v_corpus AS (
  SELECT vec_id // 4 AS ticket_id,
         ['ticket_comment','subject','summary','first_comment'][CAST(vec_id % 4 AS INTEGER) + 1] AS sentence_source,
         'prod' || CAST((vec_id // 4) % 3 AS VARCHAR) AS product,
         'mod' || CAST((vec_id // 4) % 5 AS VARCHAR) AS module,
         'text ' || CAST(vec_id AS VARCHAR) AS sentence,
         CAST(embedding AS DOUBLE[]) AS sentence_embedding, label, vec_id
  FROM embeddings)"""

JUDGMENTS = """v_subj AS (SELECT ticket_id, label FROM v_corpus WHERE sentence_source = 'subject'),
v_jpairs AS (
  SELECT t.ticket_id, o.ticket_id AS other_id
  FROM v_subj t JOIN v_subj o ON o.label = t.label AND o.ticket_id // 100 = t.ticket_id // 100 AND o.ticket_id <> t.ticket_id
  WHERE t.ticket_id % 5 = 0),
v_judgments AS (
  SELECT ticket_id, string_agg(CAST(other_id AS VARCHAR), ', ' ORDER BY other_id) AS expected_id
  FROM v_jpairs GROUP BY ticket_id)"""

QUERY_SUBJECT = """v_query_subject AS (
  SELECT c.ticket_id, c.sentence, c.product, c.module, c.sentence_embedding, j.expected_id
  FROM v_corpus c JOIN v_judgments j USING (ticket_id)
  WHERE c.sentence_source = 'subject')"""

# Judged by the label alone, whatever the ids: who is judged does not depend on a hundred of ids.
LABEL_JUDGMENTS = JUDGMENTS.replace("AND o.ticket_id // 100 = t.ticket_id // 100 ", "")

CHUNKS = """v_chunks AS (
  SELECT doc_id AS ticket_id, text AS ticket_comment, string_split(text, chr(10))[1] AS subject,
         source AS product, lang AS module
  FROM documents)"""

ARTICLES = """v_articles AS (
  SELECT doc_id AS id,
         CASE WHEN doc_id % 17 = 0 THEN NULL ELSE text END AS sentence,
         source AS product, lang AS module,
         CASE WHEN doc_id % 19 = 0 THEN NULL ELSE doc_id % 2 = 0 END AS homolog,
         CASE WHEN doc_id % 10 = 0 THEN NULL ELSE '["' || lang || '","' || source || '"]' END AS tags,
         doc_id AS updated_at
  FROM documents)"""

EXISTING = """v_existing AS (
  SELECT doc_id AS id, CASE WHEN doc_id % 7 = 0 THEN text || '!' ELSE text END AS sentence
  FROM documents WHERE doc_id % 3 <> 0
  UNION ALL
  SELECT doc_id + 1000000 AS id, text AS sentence FROM documents WHERE doc_id % 11 = 0)"""

DELETED = """v_deleted AS (SELECT doc_id AS id FROM documents WHERE doc_id % 13 = 0)"""

CATALOGUE = """v_cat_first AS (
  SELECT source AS product, lang AS module, min(doc_id) AS m FROM documents GROUP BY source, lang),
v_catalogue AS (
  SELECT product, module, m % 2 = 0 AS homolog, 1 AS ord FROM v_cat_first WHERE m % 5 <> 0
  UNION ALL
  SELECT product, module, m % 2 <> 0 AS homolog, 2 AS ord FROM v_cat_first WHERE m % 5 <> 0)"""

LOCALES = """v_locales AS (
  SELECT doc_id,
         CASE doc_id % 4 WHEN 0 THEN lang WHEN 1 THEN lang || '-XX' WHEN 2 THEN 'pt-BR' ELSE NULL END AS locale_code
  FROM documents)"""


# As in the query with bound parameters.
HOSTILE = "x' OR '1'='1' --"


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


BASE_EVAL = (CORPUS, JUDGMENTS, QUERY_SUBJECT)
LABEL_EVAL = (CORPUS, LABEL_JUDGMENTS, QUERY_SUBJECT)


# ------------------------------------------------------------------ scalar SQL helpers
def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def parsed_ids(e: str) -> str:
    return (
        f"list_transform(list_filter(list_transform(string_split(coalesce({e}, ''), ','), "
        f"lambda x: {strip_ws('x')}), lambda x: regexp_matches(x, '^[0-9]+$')), lambda x: TRY_CAST(x AS BIGINT))"
    )


def num_expected(e: str) -> str:
    return f"CAST(CASE WHEN {e} IS NULL OR length({e}) = 0 THEN 0 ELSE len(string_split({e}, ',')) END AS BIGINT)"


def hit(tid: str, e: str) -> str:
    return f"CAST(coalesce(list_contains({parsed_ids(e)}, {tid}), false) AS BIGINT)"


def score_expr(metric: str, a: str, b: str) -> str:
    if metric == "cosine":
        return f"list_cosine_similarity({a}, {b})"
    if metric == "l2":
        return f"1 - list_distance({a}, {b})"
    if metric == "inner":
        return f"1 + list_inner_product({a}, {b})"
    raise ValueError(metric)


def topk_sql(metric: str = "cosine", cond: str = "TRUE", thr: str | None = None, k: int = 20,
             queries: str = "v_query_subject", with_hit: bool = False) -> str:
    """CTEs `scored` -> `best` -> `ranked` for the vector top-k (optionally with the text of
    each ticket's best row, ties to the smallest text)."""
    raw = score_expr(metric, "q.sentence_embedding", "c.sentence_embedding")
    thr_cond = f" AND {raw} > {thr}" if thr is not None else ""
    if with_hit:
        best = """best AS (SELECT target, ticket_id, score, hit FROM (
  SELECT *, row_number() OVER (PARTITION BY target, ticket_id ORDER BY score DESC, hit ASC NULLS LAST) AS rb
  FROM scored WHERE NOT isnan(score)) WHERE rb = 1)"""
        hit_col = ", hit"
    else:
        best = ("best AS (SELECT target, ticket_id, max(score) AS score FROM scored WHERE NOT isnan(score) "
                "GROUP BY target, ticket_id)")
        hit_col = ""
    return f""",
scored AS (
  SELECT q.ticket_id AS target, c.ticket_id, round({raw}, 6) AS score, c.sentence AS hit
  FROM {queries} q JOIN v_corpus c ON c.ticket_id <> q.ticket_id AND ({cond}){thr_cond}),
{best},
ranked AS (
  SELECT target, ticket_id, score{hit_col},
         row_number() OVER (PARTITION BY target ORDER BY score DESC, ticket_id) AS rank
  FROM best QUALIFY rank <= {k})
"""


def batch_sql(metric="cosine", cond="TRUE", thr=None, k=20, views=BASE_EVAL) -> str:
    return (
        with_(*views)[:-1]
        + topk_sql(metric, cond, thr, k, with_hit=True)
        + f""", batch AS (
  SELECT r.target, r.ticket_id, r.score, r.hit AS hit_sentence, r.rank, q.sentence, q.expected_id,
         {hit('r.ticket_id', 'q.expected_id')} AS hit,
         {num_expected('q.expected_id')} AS num_expected_ids
  FROM ranked r LEFT JOIN v_query_subject q ON q.ticket_id = r.target)
"""
    )


KS_SQL = "(SELECT CAST(unnest([1, 3, 5, 20]) AS BIGINT) AS k)"

ORACLE: dict[str, str] = {}

ORACLE["src_tickets_scan"] = with_(TICKETS) + "SELECT * FROM v_tickets"

ORACLE["batch_similarity"] = batch_sql() + "SELECT * FROM batch"

ORACLE["batch_similarity_sources"] = (
    with_(CORPUS, JUDGMENTS)[:-1]
    + f""",
scored AS (
  SELECT q.ticket_id AS target, q.sentence_source AS query_row, q.sentence, j.expected_id, c.ticket_id,
         c.sentence AS hit_sentence, round({score_expr('cosine', 'q.sentence_embedding', 'c.sentence_embedding')}, 6) AS score
  FROM v_corpus q JOIN v_judgments j ON j.ticket_id = q.ticket_id JOIN v_corpus c ON c.ticket_id <> q.ticket_id),
best AS (
  SELECT * FROM scored WHERE NOT isnan(score)
  QUALIFY row_number() OVER (PARTITION BY target, query_row, ticket_id ORDER BY score DESC, hit_sentence ASC NULLS LAST) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY target, query_row ORDER BY score DESC, ticket_id) AS row_rank
  FROM best QUALIFY row_rank <= 20)
SELECT target, query_row, ticket_id, score, hit_sentence,
       row_number() OVER (PARTITION BY target ORDER BY score DESC, ticket_id, query_row) AS rank, row_rank,
       sentence, expected_id, {hit('ticket_id', 'expected_id')} AS hit, {num_expected('expected_id')} AS num_expected_ids
FROM ranked"""
)

ORACLE["vector_topk_cosine"] = with_(*LABEL_EVAL)[:-1] + topk_sql("cosine") + "SELECT * FROM ranked"
ORACLE["vector_topk_inner"] = with_(*LABEL_EVAL)[:-1] + topk_sql("inner") + "SELECT * FROM ranked"
ORACLE["vector_topk_ivf_all"] = with_(*BASE_EVAL)[:-1] + topk_sql("cosine") + "SELECT * FROM ranked"
ORACLE["vector_topk_l2"] = with_(*LABEL_EVAL)[:-1] + topk_sql("l2") + "SELECT * FROM ranked"

ORACLE["search_filter_product"] = batch_sql(cond="starts_with(c.product, q.product)") + "SELECT * FROM batch"
ORACLE["search_filter_module"] = (
    batch_sql(cond="starts_with(c.product, q.product) AND starts_with(c.module, q.module)") + "SELECT * FROM batch"
)
ORACLE["search_threshold"] = batch_sql(thr="0.3") + "SELECT * FROM batch"
ORACLE["search_interactive"] = (
    with_(*LABEL_EVAL)[:-1]
    + topk_sql("cosine", cond="starts_with(c.product, q.product) OR contains(c.module, q.module)", thr="0.3")
    + "SELECT * FROM ranked"
)

ORACLE["hit_rate_at_k"] = (
    batch_sql()
    + f"""SELECT k, round(avg(CAST(any_hit AS DOUBLE)), 6) AS hit_rate FROM (
  SELECT ks.k, b.target, max(b.hit) AS any_hit FROM batch b JOIN {KS_SQL} ks ON b.rank <= ks.k
  GROUP BY ks.k, b.target) GROUP BY k"""
)

ORACLE["recall_at_k"] = (
    batch_sql()
    + f"""SELECT k, round(sum(coalesce(CASE WHEN least(n, ne) = 0 THEN NULL ELSE hits / least(n, ne) END, 0.0))
                 / count(*), 6) AS recall FROM (
  SELECT ks.k, b.target, CAST(sum(b.hit) AS DOUBLE) AS hits, count(*) AS n, first(b.num_expected_ids) AS ne
  FROM batch b JOIN {KS_SQL} ks ON b.rank <= ks.k GROUP BY ks.k, b.target) GROUP BY k"""
)

ORACLE["hit_marker"] = batch_sql() + "SELECT target, ticket_id, hit FROM batch"

ORACLE["parse_expected_ids"] = (
    with_(CORPUS, JUDGMENTS)
    + f"""SELECT ticket_id,
  array_to_string(list_transform({parsed_ids('expected_id')}, lambda x: CAST(x AS VARCHAR)), '|') AS ids,
  {num_expected('expected_id')} AS num_expected_ids,
  CAST(len({parsed_ids('expected_id')}) AS BIGINT) AS num_parsed_ids
FROM v_judgments"""
)

ORACLE["rank_flags"] = (
    batch_sql(views=LABEL_EVAL) + "SELECT target, ticket_id, rank, rank = 1 AS top_1, rank = 2 AS top_2, rank = 3 AS top_3 FROM batch"
)

ORACLE["found_not_found"] = (
    batch_sql()
    + f""", per_target AS (SELECT target, first(expected_id) AS expected_id, first(sentence) AS sentence
                FROM batch GROUP BY target),
exp AS (SELECT target, unnest({parsed_ids('expected_id')}) AS eid FROM per_target),
retrieved AS (SELECT DISTINCT ticket_id AS eid FROM batch),
counts AS (
  SELECT e.target,
         CAST(sum(CASE WHEN r.eid IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS found,
         CAST(sum(CASE WHEN r.eid IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS not_found
  FROM exp e LEFT JOIN retrieved r ON r.eid = e.eid GROUP BY e.target)
SELECT p.target, p.expected_id, p.sentence, coalesce(c.found, 0) AS found, coalesce(c.not_found, 0) AS not_found,
       round(CASE WHEN coalesce(c.found, 0) + coalesce(c.not_found, 0) = 0 THEN 0.0
                  ELSE c.found / (c.found + c.not_found) END, 6) AS accuracy
FROM per_target p LEFT JOIN counts c USING (target)"""
)

ORACLE["top1_frequency"] = (
    batch_sql()
    + """SELECT top_1, count(*) AS n FROM (
  SELECT target, max(CASE WHEN rank = 1 THEN hit = 1 END) AS top_1 FROM batch GROUP BY target) GROUP BY top_1"""
)

_QS_COLS = "ticket_id, sentence, product, module, expected_id, CAST(len(sentence_embedding) AS BIGINT) AS dim"
ORACLE["query_set_fields"] = with_(*BASE_EVAL) + f"SELECT {_QS_COLS} FROM v_query_subject"
ORACLE["query_set_summary"] = (
    with_(CORPUS, JUDGMENTS)
    + f"SELECT {_QS_COLS} FROM v_corpus c JOIN v_judgments USING (ticket_id) WHERE sentence_source = 'summary'"
)
ORACLE["query_set_chunks"] = (
    with_(CORPUS, JUDGMENTS)
    + f"""SELECT {_QS_COLS} FROM (
  SELECT ticket_id, sentence, product, module, sentence_embedding,
         row_number() OVER (PARTITION BY ticket_id ORDER BY vec_id % 4) AS rn FROM v_corpus)
JOIN v_judgments USING (ticket_id) WHERE rn = 1"""
)

VECTOR_TABLE = """v_table AS (
  SELECT e.id, e.sentence, d.source AS product, d.lang AS module, d.doc_id % 3 = 1 AS homolog, e.id AS updated_at
  FROM v_existing e JOIN documents d ON e.id % 1000000 = d.doc_id)"""


# ------------------------------------------------------------------ text SQL twins
def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def fold_accents_sql(x: str) -> str:
    for a, b in tx.ACCENT_MULTI:
        x = f"replace({x}, {sql_str(a)}, {sql_str(b)})"
    return f"translate({x}, {sql_str(tx.ACCENT_FROM)}, {sql_str(tx.ACCENT_TO)})"


def tokens_sql(x: str, stopwords=None) -> str:
    words = list(tx.DEFAULT_STOPWORDS if stopwords is None else stopwords)
    stop = "[" + ", ".join(sql_str(w) for w in words) + "]::VARCHAR[]"
    s = f"regexp_replace({fold_accents_sql(f'CAST({x} AS VARCHAR)')}, '[^0-9a-zA-Z]', ' ', 'g')"
    return (f"list_transform(list_filter(string_split({s}, ' '), lambda w: w <> '' AND NOT list_contains({stop}, w)), "
            f"lambda w: lower(w))")


def normalize_sql(x: str, stopwords=None) -> str:
    return f"array_to_string({tokens_sql(x, stopwords)}, ' ')"


def hashed_vectors_sql(table: str, key: str, text: str, dim: int = 64) -> str:
    """Subquery (key, v) of hashed vectors, computed in stages so nothing is recomputed."""
    b = f"list_transform({tokens_sql(text)}, lambda t: ('0x' || substr(md5(t), 1, 8))::BIGINT % {dim})"
    counts = f"list_transform(range({dim}), lambda i: CAST(len(list_filter(b, lambda z: z = i)) AS DOUBLE))"
    return f"""(SELECT {key}, CASE WHEN len(b) > 0 THEN list_transform(c, lambda x: x / nrm) END AS v FROM (
  SELECT {key}, b, c, sqrt(list_sum(list_transform(c, lambda u: u * u))) AS nrm FROM (
    SELECT {key}, b, {counts} AS c FROM (SELECT {key}, {b} AS b FROM {table}))))"""


def hit_sql_ids(e: str) -> str:
    return parsed_ids(e)

BASE_SQL = """v_base AS (
  SELECT ticket_id,
         string_agg(ticket_comment, '╡' ORDER BY comment_created_at NULLS FIRST, ticket_comment NULLS FIRST) AS ticket_comment,
         max(subject) AS subject, CAST(NULL AS VARCHAR) AS summary, CAST(NULL AS VARCHAR) AS ticket_sentence_hash,
         max(module_name) AS module, max(product_name) AS product, CAST(NULL AS VARCHAR) AS sentence_source,
         max(ticket_status) AS ticket_status, max(created_at) AS created_at, max(updated_at) AS updated_at
  FROM v_tickets GROUP BY ticket_id),
v_first AS (
  SELECT ticket_id, ticket_comment AS first_comment, comment_created_at FROM (
    SELECT *, row_number() OVER (PARTITION BY ticket_id
                                 ORDER BY comment_created_at NULLS FIRST, ticket_comment NULLS FIRST) AS rn
    FROM v_tickets) WHERE rn = 1)"""

ORACLE["ticket_base"] = with_(TICKETS, BASE_SQL) + "SELECT b.*, f.first_comment FROM v_base b JOIN v_first f USING (ticket_id)"
ORACLE["first_comment"] = with_(TICKETS, BASE_SQL) + "SELECT * FROM v_first"
ORACLE["sentence_hash"] = "SELECT doc_id, md5(CAST(doc_id AS VARCHAR) || text) AS sentence_hash FROM documents"
ORACLE["extract_topic"] = ("SELECT doc_id, coalesce(nullif(regexp_extract(text, '\\*\\*(.*?)\\*\\*', 1), ''), text) "
                           "AS topic FROM documents")
ORACLE["clean_output"] = ("SELECT doc_id, replace(regexp_replace('1. ' || text, '[0-9]+\\.\\s*', '', 'g'), chr(10), ' ') "
                          "AS cleaned FROM documents")
ORACLE["normalize_text"] = f"SELECT doc_id, {normalize_sql('text')} AS normalized FROM documents"
_LC = "lower(coalesce(locale_code, ''))"
ORACLE["language_by_locale"] = with_(LOCALES) + f"""SELECT doc_id, locale_code,
  CASE WHEN contains({_LC}, 'en') THEN 'English' WHEN contains({_LC}, 'es') THEN 'Spanish' ELSE 'Brazilian Portuguese' END AS language,
  CASE WHEN contains({_LC}, 'en') THEN 'en' WHEN contains({_LC}, 'es') THEN 'es' ELSE 'pt' END AS code
FROM v_locales"""
_TAGS = "(CASE WHEN tags IS NULL OR length(tags) = 0 THEN []::VARCHAR[] ELSE CAST(json(tags) AS VARCHAR[]) END)"
ORACLE["parse_tags"] = with_(ARTICLES) + f"""SELECT id, CAST(len({_TAGS}) AS BIGINT) AS n_tags,
  array_to_string({_TAGS}, '|') AS tags_joined FROM v_articles"""
ORACLE["decode_records"] = """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  CAST(json_extract(props, '$.k') AS BIGINT) AS key,
  CAST(json_extract(props, '$.k') AS BIGINT) AS map_k,
  CAST(len(json_keys(props)) AS BIGINT) AS n_keys FROM events"""
_EV_AT = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"
ORACLE["decode_nested"] = f"""SELECT event_id, substring({_EV_AT}, 1, 10) AS on_day,
  try_strptime({_EV_AT}, '%Y-%m-%dT%H:%M:%S') AS at_time,
  CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'a b|' || event_type END AS tags,
  event_id % 11 AS k, CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'né "' || event_id || '"' END AS note,
  CAST(CASE WHEN event_id % 5 = 0 THEN 0 ELSE 3 END AS BIGINT) AS n_items,
  CASE WHEN event_id % 5 = 0 THEN 0 ELSE 1 + event_id % 7 END AS items_sum FROM events"""
ORACLE["parse_datetimes"] = """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts_text,
  try_strptime(strftime(ts, '%Y-%m-%dT%H:%M:%S'), '%Y-%m-%dT%H:%M:%S') AS parsed_ts,
  CAST(CAST(try_strptime(substring(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 1, 10), '%Y-%m-%d') AS DATE) AS VARCHAR) AS parsed_date
FROM events"""
ORACLE["shrink_long"] = with_(ARTICLES) + """SELECT id, CAST(length(substring(sentence, 1, 5000)) AS BIGINT) AS sentence_len,
  md5(substring(sentence, 1, 5000)) AS sentence_md5, product, substring(tags, 1, 5000) AS tags FROM v_articles"""


def _prompt_sql(x: str) -> str:
    from simtrail.plans.queries import PROMPT

    return f"replace({sql_str(PROMPT)}, '{{text}}', {x})"


ORACLE["prompt_column"] = with_(TICKETS) + f"""SELECT ticket_id, updated_at, md5({_prompt_sql('ticket_comment')}) AS prompt_md5,
  CAST(length({_prompt_sql('ticket_comment')}) AS BIGINT) AS prompt_chars FROM v_tickets"""
ORACLE["select_bound"] = with_(TICKETS) + f"""SELECT ticket_id, subject, module_name, updated_at FROM v_tickets
  WHERE module_name = 'mod1' AND ticket_status <> {sql_str(HOSTILE)} AND ticket_id >= 10"""
ORACLE["sample_n"] = with_(TICKETS) + """SELECT ticket_id, ticket_status, md5(ticket_comment) AS comment_md5 FROM v_tickets
  ORDER BY md5(concat_ws(chr(31), '7', coalesce(CAST(ticket_id AS VARCHAR), chr(9216)), coalesce(ticket_status, chr(9216)),
                         coalesce(ticket_comment, chr(9216)))), ticket_id, ticket_status, ticket_comment LIMIT 5"""
ORACLE["dedup_keep_first"] = with_(CATALOGUE) + """SELECT product, module, homolog, ord FROM (
  SELECT *, row_number() OVER (PARTITION BY product, module ORDER BY ord) AS rn FROM v_catalogue) WHERE rn = 1"""
ORACLE["judgments_load"] = with_(CORPUS, JUDGMENTS, """v_raw AS (
  SELECT CASE WHEN ticket_id % 35 = 0 THEN 'T-' || ticket_id WHEN ticket_id % 20 = 0 THEN ' ' || ticket_id || ' '
              WHEN ticket_id % 55 = 0 THEN NULL WHEN ticket_id % 65 = 0 THEN ticket_id || '.5'
              ELSE CAST(ticket_id AS VARCHAR) END AS raw_id, expected_id FROM v_judgments)""") + """SELECT raw_id,
  CASE WHEN regexp_full_match(trim(raw_id), '[0-9]+') THEN CAST(trim(raw_id) AS BIGINT) END AS ticket_id, expected_id,
  CASE WHEN raw_id IS NULL THEN 'no id' WHEN NOT regexp_full_match(trim(raw_id), '[0-9]+') THEN 'bad id' END AS problem FROM v_raw"""
ORACLE["per_product_counts"] = with_(ARTICLES) + "SELECT product, count(*) AS n FROM v_articles GROUP BY product"

DIGEST = """CAST(len(v) AS INTEGER) AS dim, round(list_sum(v), 6) AS vsum,
  round(list_sum(list_transform(v, lambda x, i: x * i)), 6) AS vplace"""

# ---- sync
INCOMING = """v_incoming AS (
  SELECT id, coalesce(sentence, '') AS sentence, coalesce(product, '') AS product, coalesce(module, '') AS module,
         homolog, coalesce(tags, '') AS tags, updated_at
  FROM v_articles a WHERE NOT EXISTS (SELECT 1 FROM v_deleted d WHERE d.id = a.id)),
v_diff AS (
  SELECT coalesce(i.id, e.id) AS id, coalesce(i.sentence, e.sentence) AS sentence, i.product, i.module, i.homolog,
         i.tags, i.updated_at,
         CASE WHEN i.id IS NOT NULL AND e.id IS NOT NULL THEN 'both' WHEN i.id IS NOT NULL THEN 'left_only'
              ELSE 'right_only' END AS merge_status
  FROM v_incoming i FULL OUTER JOIN v_existing e ON i.id IS NOT DISTINCT FROM e.id
                                                AND i.sentence IS NOT DISTINCT FROM e.sentence),
v_new AS (SELECT * FROM v_diff WHERE merge_status = 'left_only'),
v_removed AS (SELECT id, sentence FROM v_diff WHERE merge_status = 'right_only')"""
SYNC_CTES = (ARTICLES, DELETED, EXISTING, INCOMING)

ORACLE["sync_filter_deleted"] = with_(ARTICLES, DELETED) + """SELECT id, product FROM v_articles a
  WHERE NOT EXISTS (SELECT 1 FROM v_deleted d WHERE d.id = a.id)"""
ORACLE["fill_missing"] = with_(ARTICLES) + """SELECT id, CAST(length(coalesce(sentence, '')) AS BIGINT) AS sentence_len,
  coalesce(tags, '') AS tags, homolog FROM v_articles"""
ORACLE["fill_missing_dropped"] = with_(ARTICLES) + """SELECT id, CAST(length(sentence) AS BIGINT) AS sentence_len,
  coalesce(tags, '') AS tags, homolog FROM v_articles WHERE sentence IS NOT NULL"""
ORACLE["sync_diff"] = with_(*SYNC_CTES) + "SELECT id, md5(sentence) AS sentence_md5, merge_status FROM v_diff"
ORACLE["sync_watermark"] = with_(*SYNC_CTES) + "SELECT max(updated_at) AS updated_at_max FROM v_new"
ORACLE["insert_if_absent"] = with_(*SYNC_CTES, VECTOR_TABLE) + """SELECT DISTINCT n.id, md5(n.sentence) AS sentence_md5
  FROM v_new n WHERE NOT EXISTS (SELECT 1 FROM v_table t WHERE t.id = n.id AND t.sentence = n.sentence)"""
ORACLE["delete_by_id"] = with_(EXISTING, DELETED, VECTOR_TABLE) + """SELECT id, md5(sentence) AS sentence_md5 FROM v_table t
  WHERE NOT EXISTS (SELECT 1 FROM v_deleted d WHERE d.id = t.id)"""
ORACLE["delete_by_pair"] = with_(*SYNC_CTES, VECTOR_TABLE) + """SELECT id, md5(sentence) AS sentence_md5 FROM v_table t
  WHERE NOT EXISTS (SELECT 1 FROM v_removed r WHERE r.id = t.id AND r.sentence = t.sentence)"""
FLAG_SQL = """v_cat1 AS (SELECT product, module, homolog AS cat FROM (
  SELECT *, row_number() OVER (PARTITION BY product, module ORDER BY ord) AS rn FROM v_catalogue) WHERE rn = 1)"""
_NEW_FLAG = "CASE WHEN t.homolog IS NOT NULL AND c.cat IS NOT NULL AND t.homolog = c.cat THEN NOT t.homolog ELSE t.homolog END"
ORACLE["flag_sync"] = with_(EXISTING, CATALOGUE, VECTOR_TABLE, FLAG_SQL) + f"""SELECT t.id, t.product, t.module,
  {_NEW_FLAG} AS homolog FROM v_table t LEFT JOIN v_cat1 c ON c.product = t.product AND c.module = t.module"""
ORACLE["sync_apply"] = with_(*SYNC_CTES, VECTOR_TABLE, CATALOGUE, FLAG_SQL) + f""", v_after AS (
  SELECT * FROM v_table t WHERE NOT EXISTS (SELECT 1 FROM v_deleted d WHERE d.id = t.id)
    AND NOT EXISTS (SELECT 1 FROM v_removed r WHERE r.id = t.id AND r.sentence = t.sentence)),
v_ins AS (
  SELECT DISTINCT n.id, n.sentence AS sentence, n.product, n.module, n.homolog, n.updated_at,
         array_to_string({_TAGS}, '|') AS tags
  FROM v_new n WHERE NOT EXISTS (SELECT 1 FROM v_after a WHERE a.id = n.id AND a.sentence = n.sentence)),
v_all AS (SELECT i.*, x.v FROM v_ins i JOIN {hashed_vectors_sql('v_ins', 'id, sentence', 'sentence')} x
            ON x.id = i.id AND x.sentence = i.sentence
          UNION ALL SELECT id, sentence, product, module, homolog, updated_at, NULL, NULL FROM v_after)
SELECT t.id, md5(t.sentence) AS sentence_md5, t.product, t.module, {_NEW_FLAG} AS homolog, t.updated_at, t.tags, {DIGEST}
FROM v_all t LEFT JOIN v_cat1 c ON c.product = t.product AND c.module = t.module"""
ORACLE["sync_buckets"] = ORACLE["sync_apply"]

ORACLE["embed_hashed"] = f"""SELECT doc_id, CAST(i - 1 AS BIGINT) AS dim, round(v[i], 6) AS value FROM (
  SELECT doc_id, v, generate_subscripts(v, 1) AS i FROM {hashed_vectors_sql('documents', 'doc_id', 'text')})
WHERE v[i] > 0"""
ORACLE["embed_unique"] = f"""SELECT doc_id, CAST(len(list_filter(v, lambda x: x > 0)) AS BIGINT) AS n_dims,
  round(list_sum(v), 6) AS vsum FROM {hashed_vectors_sql('documents', 'doc_id', 'text')}"""

# ---- text jobs
def pieces_cte(name: str, src: str, key: str, text: str, sep: str, sep_len: int, size: int, overlap: int) -> str:
    """CTE ``name`` (key, piece, t): the packed pieces of every text, piece by piece in a recursive walk over the running
    lengths p of the parts s."""
    past = lambda first, after: (f"greatest({after} + 1, len(list_filter(p, lambda z: z <= p[{first} + 1] + {size + sep_len})) - 1)")
    room = f"least({overlap}, {size - sep_len} - length(s[e + 1]))"
    return f"""{name}_parts AS (
  SELECT {key}, s, list_transform(range(0, len(s) + 1), lambda i: CAST(coalesce(
           list_sum(list_transform(s[1:i], lambda z: length(z) + {sep_len})), 0) AS BIGINT)) AS p
  FROM (SELECT {key}, list_filter(string_split({text}, {sep}), lambda z: z <> '') AS s FROM {src}) WHERE len(s) > 0),
{name}_walk AS (
  SELECT {key}, s, p, 0 AS no, CAST(0 AS BIGINT) AS a, CAST({past('0', '0')} AS BIGINT) AS e FROM {name}_parts
  UNION ALL
  SELECT {key}, s, p, no + 1, a, CAST({past('a', 'e')} AS BIGINT) FROM (
    SELECT {key}, s, p, no, e,
           CAST(least(e, len(list_filter(p, lambda z: z < p[e + 1] - {sep_len} - {room}))) AS BIGINT) AS a
    FROM {name}_walk WHERE e < len(s))),
{name} AS (
  SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY no) - 1 AS piece, t FROM (
    SELECT {key}, no, {strip_ws(f"array_to_string(s[a + 1:e], {sep})")} AS t FROM {name}_walk) WHERE t <> '')"""


BLANK_LINE = "chr(10) || chr(10)"
# As PIECES and REDUCE of the queries.
SIZE, OVERLAP, BUDGET, ROUNDS = 600, 120, 400, 6

ORACLE["summary_pieces"] = with_(pieces_cte("v_pieces", "documents", "doc_id", "text", "chr(10)", 1, 500, 100)) + """SELECT doc_id,
  piece AS piece_no, md5(t) AS piece_md5, CAST(length(t) AS BIGINT) AS piece_len FROM v_pieces WHERE piece < 4"""

_WIN = """list_transform(CASE WHEN len(tk) > 0 THEN range(0, CAST(ceil(len(tk) / 512) AS BIGINT)) ELSE [] END,
           lambda i: array_to_string(tk[i * 512 + 1 : i * 512 + 512], ' '))"""
WINDOWS = f"""v_windows AS (
  SELECT ticket_id, {_WIN} AS w FROM (
    SELECT ticket_id, list_filter(regexp_split_to_array(coalesce(ticket_comment, ''), '\\s+'), lambda t: t <> '') AS tk
    FROM v_chunks))"""
ORACLE["chunk_windows"] = with_(CHUNKS, WINDOWS) + """SELECT ticket_id, CAST(i - 1 AS BIGINT) AS chunk_index,
  md5(w[i]) AS chunk_md5, CAST(len(string_split(w[i], ' ')) AS BIGINT) AS n_tokens FROM (
  SELECT ticket_id, w, generate_subscripts(w, 1) AS i FROM v_windows)"""
ORACLE["profile"] = with_(CHUNKS, WINDOWS) + """SELECT count(*) AS n_rows, CAST(sum(len(w)) AS BIGINT) AS n_chunks,
  CAST(2 AS BIGINT) AS n_columns FROM v_windows"""

BT = "v_bt AS (SELECT b.ticket_id, b.ticket_comment, b.subject FROM v_base b)"


PIECES_SQL = pieces_cte("v_pieces", "v_bt", "ticket_id", "ticket_comment", BLANK_LINE, 2, SIZE, OVERLAP)


def sentences_sql(pieces: bool) -> str:
    src = "SELECT ticket_id, piece, t FROM v_pieces" if pieces else "SELECT ticket_id, 0 AS piece, ticket_comment AS t FROM v_bt"
    return (PIECES_SQL + ",\n" if pieces else "") + f"""v_sent AS (
  SELECT ticket_id, piece, i AS pos, {strip_ws('a[i]')} AS sentence FROM (
    SELECT ticket_id, piece, a, generate_subscripts(a, 1) AS i FROM (
      SELECT ticket_id, piece, regexp_split_to_array(t, '[.\\n]+') AS a FROM ({src})))
  WHERE {strip_ws('a[i]')} <> ''),
v_tf AS (SELECT ticket_id, tok, count(*) AS tf FROM (
  SELECT ticket_id, unnest({tokens_sql('ticket_comment')}) AS tok FROM v_bt) GROUP BY ticket_id, tok),
v_sscore AS (
  SELECT s.ticket_id, s.piece, s.pos, coalesce(x.score, 0.0) AS score, s.sentence FROM v_sent s LEFT JOIN (
    SELECT t.ticket_id, t.piece, t.pos, round(sum(f.tf) / count(*), 6) AS score FROM (
      SELECT ticket_id, piece, pos, unnest(list_distinct({tokens_sql('sentence')})) AS tok FROM v_sent) t
    JOIN v_tf f ON f.ticket_id = t.ticket_id AND f.tok = t.tok GROUP BY t.ticket_id, t.piece, t.pos) x
  ON x.ticket_id = s.ticket_id AND x.piece = s.piece AND x.pos = s.pos)"""


def best_sql(src: str, n: int, by: str = "ticket_id") -> str:
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY score DESC, piece, pos) AS r
  FROM {src}) WHERE r <= {n})"""


TEXT_BASE = (TICKETS, BASE_SQL, BT)
ORACLE["summarize_stuff"] = with_(*TEXT_BASE, sentences_sql(False)) + f"""SELECT ticket_id,
  string_agg(sentence, '. ' ORDER BY piece, pos) AS summary FROM {best_sql('v_sscore', 3)} GROUP BY ticket_id"""


def reduce_sql() -> str:
    """CTEs up to v_sum (ticket_id, summary): best two sentences a piece, merged by twos while over the budget, best three."""
    out = [f"""v_m0 AS (
  SELECT ticket_id, piece, pos, score, sentence, piece AS grp FROM {best_sql('v_sscore', 2, 'ticket_id, piece')}
  QUALIFY row_number() OVER (PARTITION BY ticket_id, sentence ORDER BY piece, pos) = 1)"""]
    for i in range(ROUNDS):
        out.append(f"""v_m{i + 1} AS (
  SELECT ticket_id, piece, pos, score, sentence, grp FROM (
    SELECT *, row_number() OVER (PARTITION BY ticket_id, grp ORDER BY score DESC, piece, pos) AS place FROM (
      SELECT ticket_id, piece, pos, score, sentence, over, CASE WHEN over THEN grp // 2 ELSE grp END AS grp FROM (
        SELECT *, sum(length(sentence) + 2) OVER (PARTITION BY ticket_id) - 2 > {BUDGET} AS over FROM v_m{i})))
  WHERE NOT over OR place <= 2)""")
    out.append(f"""v_sum AS (
  SELECT ticket_id, string_agg(sentence, '. ' ORDER BY piece, pos) AS summary FROM {best_sql(f'v_m{ROUNDS}', 3)} GROUP BY ticket_id)""")
    return ",\n".join(out)


ORACLE["summarize_map_reduce"] = with_(*TEXT_BASE, sentences_sql(True), reduce_sql()) + "SELECT * FROM v_sum"
TOPIC_SQL = f"""v_topic AS (SELECT ticket_id,
  coalesce(nullif(regexp_extract(sentence, '\\*\\*(.*?)\\*\\*', 1), ''), sentence) AS topic
  FROM {best_sql('v_sscore', 1)})"""
ORACLE["ticket_topic"] = with_(*TEXT_BASE, sentences_sql(False), TOPIC_SQL) + "SELECT * FROM v_topic"
KEYWORDS_SQL = """v_kw AS (
  SELECT ticket_id,
         replace(regexp_replace(string_agg(tok, ' ' ORDER BY weight DESC, tok), '[0-9]+\\.\\s*', '', 'g'), chr(10), ' ')
           AS keywords
  FROM (SELECT *, row_number() OVER (PARTITION BY ticket_id ORDER BY weight DESC, tok) AS r FROM (
    SELECT f.ticket_id, f.tok,
           round(f.tf * ln(((SELECT count(DISTINCT ticket_id) FROM v_bt) + 1) / (d.df + 1)), 6) AS weight
    FROM v_tf f JOIN (SELECT tok, count(*) AS df FROM v_tf GROUP BY tok) d USING (tok)))
  WHERE r <= 8 GROUP BY ticket_id)"""
ORACLE["ticket_keywords"] = with_(*TEXT_BASE, sentences_sql(False), KEYWORDS_SQL) + "SELECT * FROM v_kw"
ORACLE["union_sources"] = with_(*TEXT_BASE, sentences_sql(False), TOPIC_SQL, KEYWORDS_SQL) + """SELECT ticket_id,
  sentence_source, sentence, md5(CAST(ticket_id AS VARCHAR) || sentence) AS ticket_sentence_hash FROM (
  SELECT ticket_id, 'summary' AS sentence_source, topic AS sentence FROM v_topic
  UNION ALL SELECT ticket_id, 'keywords', keywords FROM v_kw
  UNION ALL SELECT ticket_id, 'subject', subject FROM v_bt)"""
ORACLE["fan_out_sources"] = with_(*TEXT_BASE, sentences_sql(True), reduce_sql()) + f""", v_b AS (SELECT b.ticket_id, b.ticket_comment, b.subject, s.summary, f.first_comment
        FROM v_base b JOIN v_first f USING (ticket_id) LEFT JOIN v_sum s USING (ticket_id))
SELECT ticket_id, src AS sentence_source, md5(sentence) AS sentence_md5, h AS ticket_sentence_hash FROM (
  SELECT ticket_id, 'ticket_comment' AS src, ticket_comment AS sentence,
         md5(CAST(ticket_id AS VARCHAR) || ticket_comment) AS h FROM v_b
  UNION ALL SELECT ticket_id, 'subject', subject, md5(CAST(ticket_id AS VARCHAR) || subject) FROM v_b
  UNION ALL SELECT ticket_id, 'summary', summary, md5(CAST(ticket_id AS VARCHAR) || summary) FROM v_b
  UNION ALL SELECT ticket_id, 'first_comment', first_comment,
                   md5(CAST(ticket_id AS VARCHAR) || first_comment || summary) FROM v_b)"""

ORACLE["split_pieces"] = with_(
    f"v_text AS (SELECT doc_id, {paragraphs_sql('text')} AS t FROM documents)",
    pieces_cte("v_pieces", "v_text", "doc_id", "t", BLANK_LINE, 2, SIZE, OVERLAP),
) + """SELECT doc_id, piece AS piece_no, CAST(length(t) AS BIGINT) AS piece_len, md5(t) AS piece_md5 FROM v_pieces"""

REFINE_SQL = f"""v_cand AS (
  SELECT ticket_id, piece, pos, score, sentence, list_distinct({tokens_sql('sentence')}) AS tokens
  FROM {best_sql('v_sscore', 3, 'ticket_id, piece')}),
v_cands AS (
  SELECT ticket_id, row_number() OVER (PARTITION BY ticket_id ORDER BY piece) AS step, c FROM (
    SELECT ticket_id, piece, list({{'score': score, 'piece': piece, 'pos': pos, 'sentence': sentence, 'tokens': tokens}}) AS c
    FROM v_cand GROUP BY ticket_id, piece)),
v_fold AS (
  SELECT ticket_id, CAST(0 AS BIGINT) AS step,
         []::STRUCT(weight DOUBLE, piece BIGINT, pos BIGINT, sentence VARCHAR, tokens VARCHAR[])[] AS answer
  FROM (SELECT DISTINCT ticket_id FROM v_cands)
  UNION ALL
  SELECT ticket_id, step, CASE WHEN len(answer) < 3 THEN answer || [best]
                               WHEN best.weight > worst.weight THEN list_filter(answer, lambda x: x <> worst) || [best]
                               ELSE answer END
  FROM (
    SELECT ticket_id, step, answer, list_max(weighed) AS best, list_min(answer) AS worst FROM (
      SELECT v.ticket_id, v.step, f.answer, list_transform(v.c, lambda x: {{
          'weight': round(x.score / (len(list_intersect(x.tokens,
                      flatten(list_transform(f.answer, lambda y: y.tokens)))) + 1), 6),
          'piece': CAST(-x.piece AS BIGINT), 'pos': CAST(-x.pos AS BIGINT), 'sentence': x.sentence, 'tokens': x.tokens}}) AS weighed
      FROM v_fold f JOIN v_cands v ON v.ticket_id = f.ticket_id AND v.step = f.step + 1)))"""
ORACLE["summarize_refine"] = with_(*TEXT_BASE, sentences_sql(True), REFINE_SQL) + """SELECT ticket_id,
  string_agg(x.sentence, '. ' ORDER BY -x.piece, -x.pos) AS summary FROM (
  SELECT ticket_id, unnest(answer) AS x FROM v_fold
  QUALIFY dense_rank() OVER (PARTITION BY ticket_id ORDER BY step DESC) = 1)
GROUP BY ticket_id"""


FEED_SQL = """v_feed AS (
  SELECT ticket_id, 'summary' AS sentence_source, topic AS sentence FROM v_topic
  UNION ALL SELECT ticket_id, 'keywords', keywords FROM v_kw
  UNION ALL SELECT ticket_id, 'subject', subject FROM v_bt)"""
_SOURCE_HASH = "md5(CAST(ticket_id AS VARCHAR) || sentence)"
ORACLE["feed_summary"] = with_(*TEXT_BASE, sentences_sql(False), TOPIC_SQL, KEYWORDS_SQL, FEED_SQL) + f"""SELECT ticket_id,
  sentence_source, {_SOURCE_HASH} AS ticket_sentence_hash, {DIGEST}
FROM {hashed_vectors_sql('v_feed', 'ticket_id, sentence_source, sentence', 'sentence')}"""
FOUR_SQL = """v_b AS (SELECT b.ticket_id, b.ticket_comment, b.subject, s.summary, f.first_comment
        FROM v_base b JOIN v_first f USING (ticket_id) LEFT JOIN v_sum s USING (ticket_id)),
v_four AS (
  SELECT ticket_id, 'ticket_comment' AS sentence_source, ticket_comment AS sentence,
         md5(CAST(ticket_id AS VARCHAR) || ticket_comment) AS h FROM v_b
  UNION ALL SELECT ticket_id, 'subject', subject, md5(CAST(ticket_id AS VARCHAR) || subject) FROM v_b
  UNION ALL SELECT ticket_id, 'summary', summary, md5(CAST(ticket_id AS VARCHAR) || summary) FROM v_b
  UNION ALL SELECT ticket_id, 'first_comment', first_comment,
                   md5(CAST(ticket_id AS VARCHAR) || first_comment || summary) FROM v_b)"""
ORACLE["ingest_four_sources"] = with_(*TEXT_BASE, sentences_sql(True), reduce_sql(), FOUR_SQL) + f"""SELECT ticket_id,
  sentence_source, h AS ticket_sentence_hash, {DIGEST}
FROM {hashed_vectors_sql('v_four', 'ticket_id, sentence_source, h', 'sentence')}"""

ORACLE["search_text"] = f"""WITH q AS (
  SELECT a.doc_id, string_split(a.text, chr(10))[1] AS query, a.source, a.lang FROM documents a WHERE a.doc_id % 25 = 0),
qv AS (SELECT q.*, x.v FROM q JOIN {hashed_vectors_sql('q', 'doc_id', 'query')} x USING (doc_id) WHERE x.v IS NOT NULL),
cv AS (SELECT d.*, x.v FROM documents d JOIN {hashed_vectors_sql('documents', 'doc_id', 'text')} x USING (doc_id)
       WHERE x.v IS NOT NULL),
hits AS (
  SELECT q.doc_id AS target, q.query, c.doc_id AS ticket_id, list_cosine_similarity(q.v, c.v) AS raw, c.text, c.source, c.lang
  FROM qv q JOIN cv c ON c.doc_id <> q.doc_id AND (starts_with(c.source, q.source) OR contains(c.lang, q.lang)))
SELECT target, query, ticket_id, round(raw, 6) AS score, source AS hit_product, lang AS hit_module, md5(text) AS hit_md5,
       row_number() OVER (PARTITION BY target ORDER BY round(raw, 6) DESC, ticket_id) AS rank
FROM hits WHERE raw > 0.517 QUALIFY rank <= 20"""


def rejoin_sql(src: str) -> str:
    return f"""SELECT ticket_id, CAST(len(w) AS BIGINT) AS n_words, true AS within_budget, md5(array_to_string(w, ' ')) AS words_md5
FROM (SELECT ticket_id, list_filter(regexp_split_to_array(ticket_comment, '\\s+'), lambda t: t <> '') AS w FROM {src})
WHERE len(w) > 0"""


ORACLE["chunk_recursive_rejoin"] = with_(CHUNKS) + rejoin_sql("v_chunks")
ORACLE["feed_chunks_rejoin"] = with_(*TEXT_BASE) + rejoin_sql("v_bt")
