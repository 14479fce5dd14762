"""The refine loop: W1, D4, D3, U3, B10, H7, C1, W2, H5, B13 on documents standing in for posts.

Stand-in replies are derived from the same rows the prompts are built from, with the
reply layout of the reference and its failure modes chosen per batch number: a reply one
entry short, one entry long (runs into the next batch's first row), a blank piece that
shifts the rest of the batch, and failed calls (null reply).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from boardsmith.operators import batches as B
from boardsmith.operators import replies as R
from boardsmith.operators.enrich import echo, enrich_batches
from boardsmith.functions.util import ordered_concat
from boardsmith.plans import register
from boardsmith.plans.fixtures import BASE_TS, sql_strip
from boardsmith.session import materialize, table

TEXT_BATCH = 10
JSON_BATCH = 20


def refine_input(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    date_txt = F.expr(f"date_format(TIMESTAMP_NTZ'{BASE_TS}' + make_dt_interval(0, 0, CAST(n_chars AS INT), 0), 'yyyy-MM-dd HH:mm')")
    return d.select(
        F.col("doc_id").alias("post_id"), F.col("source").alias("title"), F.col("text").alias("contents"),
        F.concat(F.lit("['"), F.col("lang"), F.lit("']")).alias("comments"),
        F.col("n_chars").alias("views"), date_txt.alias("date_text"), "lang", "n_chars", "source", "text",
    )


def numbered_input(spark, sf_dir, size):
    return B.with_batches(refine_input(spark, sf_dir), "post_id", size)


RIN_SQL = f"""
rin AS (SELECT doc_id AS post_id, source AS title, text AS contents, '[''' || lang || ''']' AS comments, n_chars AS views,
               strftime(TIMESTAMP '{BASE_TS}' + to_minutes(CAST(n_chars AS BIGINT)), '%Y-%m-%d %H:%M') AS date_text,
               lang, n_chars, source, text, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx
        FROM documents)
"""


# ---- stand-in text replies ------------------------------------------------------------------
def entry_text(row_idx="row_idx"):
    lang, n, src = F.col("lang"), F.col("n_chars"), F.col("source")
    head = F.concat((F.col(row_idx) + 1).cast("string"), F.lit(". "), F.regexp_replace("text", "\n", " "))
    head = (
        F.when(lang == "fr", F.concat(head, F.lit("\n"), F.upper(src)))
        .when((lang == "en") & (n < 1000), F.concat(head, F.lit("\n- stray")))
        .otherwise(head)
    )
    cm = (
        F.when(lang == "de", F.lit("댓글: 없음\n- ignored"))
        .when(lang == "es", F.concat(F.lit("댓글:\n1. from "), src, F.lit("\n2. "), n.cast("string"), F.lit(" chars\n3 no dot")))
        .otherwise(F.concat(F.lit("댓글:\n- from "), src, F.lit("\n- "), lang))
    )
    kw = F.concat(
        F.when(lang == "es", F.lit("키워드:\n- stale\n키워드:\n")).otherwise(F.lit("키워드:\n")),
        F.lit("- "), src, F.lit("\n- "), lang,
        F.when(n >= 300, F.concat(F.lit("\n- size"), (n / 1000).cast("bigint").cast("string"))).otherwise(F.lit("")),
    )
    tend = (
        F.when((lang == "fr") & (n < 400), F.lit(""))
        .when(lang.isin("en", "de"), F.lit("\n성향: 경험성"))
        .when(n > 5000, F.lit("\n성향: 정보성: x"))
        .otherwise(F.lit("\n성향: 질문성"))
    )
    return F.concat(head, F.lit("\n"), cm, F.lit("\n"), kw, tend)


def written_input(spark, sf_dir, size):
    """The numbered input written once, for queries that read it more than once."""
    return materialize(numbered_input(spark, sf_dir, size), "numbered")


def text_replies(spark, sf_dir, numbered=None):
    numbered = written_input(spark, sf_dir, TEXT_BATCH) if numbered is None else numbered
    ent = numbered.select(
        "batch_id", (F.col("row_idx") % TEXT_BATCH).alias("pos"), entry_text().alias("entry")
    )
    b, pos = F.col("batch_id"), F.col("pos")
    own = ent.where(~((b % 4 == 1) & (pos == TEXT_BATCH - 1))).select("batch_id", (pos * 2).alias("ord"), F.col("entry").alias("piece"))
    extra = ent.where((pos == 0) & (b >= 1) & ((b - 1) % 4 == 2)).select((b - 1).alias("batch_id"), F.lit(2 * TEXT_BATCH).alias("ord"), F.col("entry").alias("piece"))
    blank = ent.where((pos == 2) & (b % 4 == 3)).select("batch_id", F.lit(5).alias("ord"), F.lit(" ").alias("piece"))
    pieces = own.unionByName(extra.withColumn("ord", F.col("ord").cast("bigint"))).unionByName(blank.withColumn("ord", F.col("ord").cast("bigint")))
    return pieces.groupBy("batch_id").agg(ordered_concat("piece", "ord", R.ENTRY_SEP).alias("_r")).select(
        "batch_id", F.when(F.col("batch_id") % 9 == 4, F.lit(None).cast("string")).otherwise(F.col("_r")).alias("response")
    )


ENTRY_SQL = """
(CAST(row_idx + 1 AS VARCHAR) || '. ' || replace(text, chr(10), ' ')
   || CASE WHEN lang = 'fr' THEN chr(10) || upper(source) WHEN lang = 'en' AND n_chars < 1000 THEN chr(10) || '- stray' ELSE '' END)
|| chr(10) ||
CASE WHEN lang = 'de' THEN '댓글: 없음' || chr(10) || '- ignored'
     WHEN lang = 'es' THEN '댓글:' || chr(10) || '1. from ' || source || chr(10) || '2. ' || CAST(n_chars AS VARCHAR) || ' chars' || chr(10) || '3 no dot'
     ELSE '댓글:' || chr(10) || '- from ' || source || chr(10) || '- ' || lang END
|| chr(10) ||
CASE WHEN lang = 'es' THEN '키워드:' || chr(10) || '- stale' || chr(10) || '키워드:' || chr(10) ELSE '키워드:' || chr(10) END
|| '- ' || source || chr(10) || '- ' || lang || CASE WHEN n_chars >= 300 THEN chr(10) || '- size' || CAST(n_chars // 1000 AS VARCHAR) ELSE '' END
|| CASE WHEN lang = 'fr' AND n_chars < 400 THEN ''
        WHEN lang IN ('en', 'de') THEN chr(10) || '성향: 경험성'
        WHEN n_chars > 5000 THEN chr(10) || '성향: 정보성: x'
        ELSE chr(10) || '성향: 질문성' END
"""

REPLIES_SQL = f"""
{RIN_SQL},
ent AS (SELECT row_idx // {TEXT_BATCH} AS batch_id, row_idx % {TEXT_BATCH} AS pos, {ENTRY_SQL} AS entry FROM rin),
pieces AS (
  SELECT batch_id, pos * 2 AS ord, entry AS piece FROM ent WHERE NOT (batch_id % 4 = 1 AND pos = {TEXT_BATCH - 1})
  UNION ALL SELECT batch_id - 1, {2 * TEXT_BATCH}, entry FROM ent WHERE pos = 0 AND batch_id >= 1 AND (batch_id - 1) % 4 = 2
  UNION ALL SELECT batch_id, 5, ' ' FROM ent WHERE pos = 2 AND batch_id % 4 = 3),
replies AS (SELECT batch_id, CASE WHEN batch_id % 9 = 4 THEN NULL ELSE string_agg(piece, chr(10) || chr(10) ORDER BY ord) END AS response
            FROM pieces GROUP BY batch_id)
"""

_S = sql_strip


def _parsed_sql(compact: bool) -> str:
    if not compact:
        return PARSED_SQL
    return PARSED_SQL.replace(PE_STRICT, PE_COMPACT).replace(CONTENT_STRICT_SQL, CONTENT_DEFAULT_SQL)


_DIGIT1 = "regexp_matches(substr(line, 1, 1), '^[0-9]$')"
_CUT_TO_DOT = sql_strip("regexp_replace(line, '^[^.]*[.]', '')")
CONTENT_STRICT_SQL = f"CASE WHEN {_DIGIT1} AND contains(line, '. ') THEN {_CUT_TO_DOT} ELSE line END"
CONTENT_DEFAULT_SQL = r"regexp_replace(line, '^[0-9]+[.]\s+', '')"
PE_STRICT = f"""pe AS (SELECT batch_id, unnest(string_split(response, chr(10) || chr(10))) AS entry,
              generate_subscripts(string_split(response, chr(10) || chr(10)), 1) - 1 AS entry_no
       FROM replies WHERE response IS NOT NULL AND response <> ''),"""
PE_COMPACT = f"""pe_all AS (SELECT batch_id, unnest(string_split(response, chr(10) || chr(10))) AS entry,
              generate_subscripts(string_split(response, chr(10) || chr(10)), 1) AS piece_no
       FROM replies WHERE response IS NOT NULL AND response <> ''),
pe AS (SELECT batch_id, entry, row_number() OVER (PARTITION BY batch_id ORDER BY piece_no) - 1 AS entry_no
       FROM pe_all WHERE {sql_strip('entry')} <> ''),"""
PARSED_SQL = f"""
{REPLIES_SQL},
{PE_STRICT}
pl AS (SELECT batch_id, entry_no, unnest(string_split(entry, chr(10))) AS raw, generate_subscripts(string_split(entry, chr(10)), 1) AS ln
       FROM pe WHERE {_S('entry')} <> ''),
cls AS (SELECT batch_id, entry_no, ln, line,
               CASE WHEN starts_with(line, '댓글:') THEN 'comments' WHEN starts_with(line, '키워드:') THEN 'keywords'
                    WHEN starts_with(line, '성향:') THEN 'tendency' END AS hdr
        FROM (SELECT *, {_S('raw')} AS line FROM pl) WHERE line <> ''),
sec AS (SELECT *, coalesce(last_value(hdr IGNORE NULLS) OVER (PARTITION BY batch_id, entry_no ORDER BY ln ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'content') AS sec,
               max(CASE WHEN hdr = 'comments' THEN ln END) OVER (PARTITION BY batch_id, entry_no) AS lc,
               max(CASE WHEN hdr = 'keywords' THEN ln END) OVER (PARTITION BY batch_id, entry_no) AS lk,
               max(CASE WHEN hdr = 'tendency' THEN ln END) OVER (PARTITION BY batch_id, entry_no) AS lt
        FROM cls),
items AS (SELECT *, hdr IS NULL AND (starts_with(line, '-') OR (sec = 'comments' AND {_DIGIT1})) AS is_item FROM sec),
agg AS (
  SELECT batch_id, entry_no,
         coalesce(arg_max({CONTENT_STRICT_SQL}, ln)
                  FILTER (WHERE hdr IS NULL AND NOT is_item AND sec = 'content'), '') AS content,
         coalesce(bool_or(hdr = 'comments' AND ln = lc AND line = '댓글: 없음'), false) AS none_hdr,
         list(CASE WHEN {_DIGIT1} THEN (CASE WHEN contains(line, '.') THEN {_S("regexp_replace(line, '^[^.]*[.]', '')")} ELSE line END)
                   ELSE {_S('substr(line, 2)')} END ORDER BY ln) FILTER (WHERE is_item AND sec = 'comments' AND ln > lc) AS citems,
         list({_S('substr(line, 2)')} ORDER BY ln) FILTER (WHERE is_item AND sec = 'keywords' AND ln > lk) AS kitems,
         coalesce(max(CASE WHEN ln = lt THEN {_S("split_part(line, ':', 2)")} END), '') AS tendency
  FROM items GROUP BY batch_id, entry_no),
parsed AS (
  SELECT batch_id, CAST(entry_no AS BIGINT) AS entry_no, CAST(batch_id * {TEXT_BATCH} + entry_no AS BIGINT) AS row_idx, content,
         CASE WHEN none_hdr OR citems[1] = '없음' THEN ['없음'] ELSE coalesce(citems, []::VARCHAR[]) END AS comments,
         coalesce(kitems, []::VARCHAR[]) AS keywords, tendency
  FROM agg)
"""


# ---- W1 / D4 / D3 / U3 / B10 ----------------------------------------------------------------
@register("with_batches", oracle=f"""
WITH {RIN_SQL} SELECT post_id, CAST(row_idx AS BIGINT) AS row_idx, CAST(row_idx // {TEXT_BATCH} AS BIGINT) AS batch_id FROM rin
""")
def with_batches_q(spark, sf_dir):
    """Global 0-based position by id and batch number, without a one-partition window."""
    return numbered_input(spark, sf_dir, TEXT_BATCH).select("post_id", "row_idx", "batch_id")


@register("batch_ranges", oracle=f"""
WITH {RIN_SQL}
SELECT CAST(row_idx // {TEXT_BATCH} AS BIGINT) AS batch_id, CAST(min(row_idx) + 1 AS BIGINT) AS first_row,
       CAST(max(row_idx) + 1 AS BIGINT) AS last_row, CAST(count(*) AS BIGINT) AS n_rows
FROM rin GROUP BY 1
""")
def batch_ranges_q(spark, sf_dir):
    """``Processing batch n: rows a to b`` as data."""
    return B.batch_ranges(numbered_input(spark, sf_dir, TEXT_BATCH))


_PROMPT_SQL = f"""
WITH {RIN_SQL}
SELECT CAST(row_idx // {{size}} AS BIGINT) AS batch_id,
       string_agg(CAST(row_idx + 1 AS VARCHAR) || '. Title: ' || coalesce(title, 'nan') || ', Contents: ' || coalesce(contents, 'nan')
                  || ', Comments: ' || coalesce(comments, 'nan') || chr(10), '' ORDER BY row_idx) AS prompt
FROM rin GROUP BY 1
"""


@register("build_prompts", oracle=_PROMPT_SQL.format(size=TEXT_BATCH))
def build_prompts_q(spark, sf_dir):
    """D3: 10-row prompts numbered by global position (text variant)."""
    return B.build_prompts(numbered_input(spark, sf_dir, TEXT_BATCH))


@register("build_prompts_json", oracle=_PROMPT_SQL.format(size=JSON_BATCH))
def build_prompts_json_q(spark, sf_dir):
    """D3: 20-row prompts (the JSON variant's batch size)."""
    return B.build_prompts(numbered_input(spark, sf_dir, JSON_BATCH))


@register("enrich_batches", oracle=f"""
WITH p AS ({_PROMPT_SQL.format(size=TEXT_BATCH).replace('WITH ', 'WITH ', 1)})
SELECT batch_id,
       CASE WHEN batch_id % 13 = 0 THEN NULL
            ELSE CAST(length(prompt) - length(replace(prompt, chr(10), '')) AS VARCHAR) || ' lines' || chr(10) || prompt END AS response,
       CASE WHEN batch_id % 13 = 0 THEN 'EchoFailure: batch ' || CAST(batch_id AS VARCHAR) || ' refused' END AS error
FROM p
""")
def enrich_batches_q(spark, sf_dir):
    """Prompts through the shipped echo hook; every 13th batch fails and is isolated."""
    return enrich_batches(B.build_prompts(numbered_input(spark, sf_dir, TEXT_BATCH)), echo)


@register("reply_filter", oracle=f"""
WITH {REPLIES_SQL} SELECT batch_id, CAST(length(response) AS BIGINT) AS n_chars FROM replies WHERE response IS NOT NULL AND response <> ''
""")
def reply_filter_q(spark, sf_dir):
    """Failed calls (null replies) are skipped."""
    return R.ok_replies(text_replies(spark, sf_dir)).select("batch_id", F.length("response").cast("bigint").alias("n_chars"))


# ---- H7 / W2 / C1 / B13 ---------------------------------------------------------------------
def parsed_text(spark, sf_dir, numbered=None):
    return R.parse_text_replies(text_replies(spark, sf_dir, numbered), TEXT_BATCH, strict_position=True)


@register("parse_text_reply", oracle=f"""
WITH {PARSED_SQL}
SELECT batch_id, entry_no, row_idx, content, array_to_string(comments, '; ') AS comments, array_to_string(keywords, '; ') AS keywords, tendency
FROM parsed
""")
def parse_text_reply_q(spark, sf_dir):
    """H7 (strict positions): every non-blank entry of every reply, parsed."""
    p = parsed_text(spark, sf_dir)
    return p.select("batch_id", "entry_no", "row_idx", "content", F.array_join("comments", "; ").alias("comments"),
                    F.array_join("keywords", "; ").alias("keywords"), "tendency")


@register("latest_per_row", oracle=f"""
WITH {PARSED_SQL}
SELECT row_idx, max(batch_id) AS batch_id, CAST(count(*) AS BIGINT) AS n_writes FROM parsed GROUP BY row_idx
""")
def latest_per_row_q(spark, sf_dir):
    """Which batch's entry each row keeps (the last writer), and how many wrote it."""
    p = parsed_text(spark, sf_dir)
    n = p.groupBy("row_idx").agg(F.count(F.lit(1)).cast("bigint").alias("n_writes"))
    return R.latest_per_row(p.select("row_idx", "batch_id")).join(n, "row_idx")


_ALIGNED_SQL = f"""
WITH {PARSED_SQL},
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_idx ORDER BY batch_id DESC) AS rn FROM parsed) WHERE rn = 1),
aligned AS (SELECT r.post_id AS id, l.content, array_to_string(l.comments, '; ') AS comments, array_to_string(l.keywords, '; ') AS keywords,
                   l.tendency, r.views, r.date_text AS date, len(l.keywords) AS n_kw
            FROM last l JOIN rin r ON r.row_idx = l.row_idx)
"""


def aligned_text(spark, sf_dir):
    numbered = written_input(spark, sf_dir, TEXT_BATCH)
    return R.align(parsed_text(spark, sf_dir, numbered), numbered)


@register("align_replies", oracle=f"""
{_ALIGNED_SQL} SELECT id, content, comments, keywords, tendency, views, date FROM aligned
""")
def align_replies_q(spark, sf_dir):
    """C1 + W2 + B12: the refined table (``output.csv`` of the text variant)."""
    return R.to_refined_rows(aligned_text(spark, sf_dir))


@register("validate_refined", oracle=f"""
{_ALIGNED_SQL}
SELECT id, CASE WHEN content IS NULL OR keywords IS NULL OR tendency IS NULL THEN 'missing_key'
                WHEN tendency NOT IN ('경험성', '질문성') THEN 'bad_tendency'
                WHEN n_kw < 3 OR n_kw > 5 THEN 'keyword_count' END AS reject_reason
FROM aligned
""")
def validate_refined_q(spark, sf_dir):
    """Every refined row with its contract violation (null = valid)."""
    a = aligned_text(spark, sf_dir)
    return a.select(F.col("post_id").alias("id"), R.validation_reason().alias("reject_reason"))


@register("refine_rejects", oracle=f"""
WITH {PARSED_SQL},
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_idx ORDER BY batch_id DESC) AS rn FROM parsed) WHERE rn = 1),
answered AS (SELECT DISTINCT batch_id FROM parsed),
every AS (SELECT r.post_id AS id, CAST(r.row_idx // {TEXT_BATCH} AS BIGINT) AS batch_id, l.row_idx IS NOT NULL AS landed,
                 CASE WHEN l.row_idx IS NULL AND coalesce(p.response, '') = '' THEN 'failed_call'
                      WHEN l.row_idx IS NULL AND a.batch_id IS NULL THEN 'undecodable'
                      WHEN l.row_idx IS NULL THEN 'short_reply'
                      WHEN l.content IS NULL OR l.keywords IS NULL OR l.tendency IS NULL THEN 'missing_key'
                      WHEN l.tendency NOT IN ('경험성', '질문성') THEN 'bad_tendency'
                      WHEN len(l.keywords) < 3 OR len(l.keywords) > 5 THEN 'keyword_count' END AS reject_reason
          FROM rin r LEFT JOIN last l ON l.row_idx = r.row_idx
          LEFT JOIN replies p ON p.batch_id = r.row_idx // {TEXT_BATCH}
          LEFT JOIN answered a ON a.batch_id = r.row_idx // {TEXT_BATCH})
SELECT id, batch_id, reject_reason, landed AND reject_reason <> 'missing_key' AS kept FROM every WHERE reject_reason IS NOT NULL
""")
def refine_rejects_q(spark, sf_dir):
    """B13 over the whole input: failed calls, replies without entries, short replies and contract violations."""
    numbered = written_input(spark, sf_dir, TEXT_BATCH)
    replies = materialize(text_replies(spark, sf_dir, numbered), "replies")
    parsed = R.parse_text_replies(replies, TEXT_BATCH, strict_position=True)
    return R.reject_table(parsed, numbered, replies)


# ---- H5: JSON replies (20-row batches) ------------------------------------------------------
def json_post():
    lang, n, src = F.col("lang"), F.col("n_chars"), F.col("source")
    comments = (
        F.when(lang == "de", F.array().cast("array<string>"))
        .when(lang == "es", F.array(F.lit("없음")))
        .otherwise(F.array(src, lang))
    )
    n_kw = F.when(n < 300, F.lit(2)).when(n > 8000, F.lit(6)).otherwise(F.lit(3))
    keywords = F.slice(F.array(src, lang, F.lit("k1"), F.lit("k2"), F.lit("k3"), F.lit("k4")), F.lit(1), n_kw)
    tendency = (
        F.when((lang == "fr") & (n < 300), F.lit(None).cast("string"))
        .when((lang == "fr") & (n > 5000), F.lit("정보성"))
        .when(lang.isin("en", "de"), F.lit("경험성"))
        .otherwise(F.lit("질문성"))
    )
    return F.struct(F.regexp_replace("text", "\n", " ").alias("content"), comments.alias("comments"), keywords.alias("keywords"), tendency.alias("tendency"))


def json_replies(num):
    g = num.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("row_idx", json_post().alias("p")))).alias("_ps"))
    b = F.col("batch_id")
    body = F.to_json(F.struct(F.transform("_ps", lambda x: x["p"]).alias("posts")))
    resp = (F.when(b % 5 == 3, F.concat(F.lit("not json: "), b.cast("string"))).when(b % 7 == 6, F.lit(None).cast("string"))
            .when(b % 11 == 4, F.concat(body, F.lit(' {"x": 1}'))).when(b % 11 == 7, F.concat(body, F.lit(" junk }"))).when(b % 11 == 9, F.concat(F.lit("\n "), body, F.lit(" \n"))).otherwise(body))
    return g.select("batch_id", resp.alias("response"))


JSON_REPLIES_SQL = f"""
{RIN_SQL},
jp AS (SELECT row_idx // {JSON_BATCH} AS batch_id, row_idx,
              {{'content': replace(text, chr(10), ' '),
                'comments': CASE WHEN lang = 'de' THEN []::VARCHAR[] WHEN lang = 'es' THEN ['없음'] ELSE [source, lang] END,
                'keywords': list_slice([source, lang, 'k1', 'k2', 'k3', 'k4'], 1, CASE WHEN n_chars < 300 THEN 2 WHEN n_chars > 8000 THEN 6 ELSE 3 END),
                'tendency': CASE WHEN lang = 'fr' AND n_chars < 300 THEN NULL WHEN lang = 'fr' AND n_chars > 5000 THEN '정보성'
                                 WHEN lang IN ('en', 'de') THEN '경험성' ELSE '질문성' END}} AS p
       FROM rin),
jreplies AS (SELECT batch_id,
                    CASE WHEN batch_id % 5 = 3 THEN 'not json: ' || CAST(batch_id AS VARCHAR) WHEN batch_id % 7 = 6 OR batch_id % 11 IN (4, 7) THEN NULL
                         ELSE CAST(to_json({{'posts': list(p ORDER BY row_idx)}}) AS VARCHAR) END AS response
             FROM jp GROUP BY batch_id),
jdec AS (SELECT batch_id, from_json(response, '{{"posts":[{{"content":"VARCHAR","comments":["VARCHAR"],"keywords":["VARCHAR"],"tendency":"VARCHAR"}}]}}') AS j
         FROM jreplies WHERE response IS NOT NULL AND response <> '' AND json_valid(response)),
jparsed AS (SELECT batch_id, unnest(j.posts) AS p, generate_subscripts(j.posts, 1) - 1 AS entry_no FROM jdec),
jlast AS (SELECT batch_id * {JSON_BATCH} + entry_no AS row_idx, arg_max(p, batch_id) AS p FROM jparsed GROUP BY 1)
"""


@register("parse_json_reply", oracle=f"""
WITH {JSON_REPLIES_SQL}
SELECT r.post_id AS id, l.p.content AS content, array_to_string(l.p.comments, '; ') AS comments,
       array_to_string(l.p.keywords, '; ') AS keywords, l.p.tendency AS tendency, r.views, r.date_text AS date
FROM jlast l JOIN rin r ON r.row_idx = l.row_idx
""")
def parse_json_reply_q(spark, sf_dir):
    """H5 + C1 + W2: JSON replies decoded (malformed -> no rows), aligned by position."""
    numbered = written_input(spark, sf_dir, JSON_BATCH)
    parsed = R.parse_json_replies(json_replies(numbered), JSON_BATCH)
    return R.to_refined_rows(R.align(parsed, numbered))


@register("parse_text_reply_compact", oracle=f"""
WITH {_parsed_sql(True)}
SELECT batch_id, entry_no, row_idx, content, array_to_string(comments, '; ') AS comments, array_to_string(keywords, '; ') AS keywords, tendency
FROM parsed
""")
def parse_text_reply_compact_q(spark, sf_dir):
    """H7 (default mode): blank pieces are dropped before entries are numbered, so a blank piece no longer shifts rows."""
    p = R.parse_text_replies(text_replies(spark, sf_dir), TEXT_BATCH, strict_position=False)
    return p.select("batch_id", "entry_no", "row_idx", "content", F.array_join("comments", "; ").alias("comments"),
                    F.array_join("keywords", "; ").alias("keywords"), "tendency")
