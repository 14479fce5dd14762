"""Re-aimed text rules on documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from boardsmith.functions.text import TOKEN_PATTERN, normalize_text
from boardsmith.operators import keywords as K
from boardsmith.operators import rules as RU
from boardsmith.operators.phrases import phrase_replace
from boardsmith.operators.vectorize import DIMS, text_vectors
from boardsmith.plans import register
from boardsmith.plans.fixtures import sql_normalize, sql_strip
from boardsmith.session import table

REPOST_OFFSET = 100


def _q(s: str) -> str:
    return s.replace("'", "''")


def repeated_token_lexicon(df, text_col="text"):
    """Lexicon built from the data: every token that occurs twice or more, put in brackets."""
    toks = K.tokens(df, text_col, text_col).groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c >= 2")
    return toks.select(F.col("token").alias("word"), F.concat(F.lit("<"), "token", F.lit(">")).alias("replacement"))


_AGREE = ", ".join(f"'{_q(p)}'" for p in RU.AGREE_PHRASES)
_BARE = ", ".join(f"'{_q(p)}'" for p in RU.BARE_ANSWERS)


@register("lexicon_replace", oracle=f"""
WITH lex AS (SELECT token, '<' || token || '>' AS rep FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}]{{2,}}')) AS token FROM conversations)
             GROUP BY 1, 2 HAVING count(*) >= 2),
words AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS pos FROM conversations),
rep AS (SELECT conv_id, turn, string_agg(coalesce(lex.rep, w), ' ' ORDER BY pos) AS t FROM words LEFT JOIN lex ON lex.token = lower(w) GROUP BY 1, 2),
ruled AS (SELECT conv_id, turn, CASE WHEN {sql_strip('t')} IN ({_AGREE}) THEN '{RU.AGREE_CANON}' ELSE t END AS text_out FROM rep
          WHERE NOT coalesce({sql_strip('t')} IN ({_BARE}), false))
SELECT conv_id, turn, text_out FROM ruled
""")
def lexicon_replace_q(spark, sf_dir):
    """Every token that occurs twice in all conversations put in brackets, then reply rules."""
    conv = table(spark, sf_dir, "conversations")
    lex = repeated_token_lexicon(conv)
    return RU.lexicon_replace(conv, "text", lex).select("conv_id", "turn", "text_out")


# Two-word phrases of the table: every pair of neighbouring words that occurs three times, and the same with a third word.
PHRASE_SQL = """
w AS (SELECT conv_id, turn, string_split(lower(text), ' ') AS w FROM conversations WHERE text IS NOT NULL),
p2 AS (SELECT w[i] AS a, w[i + 1] AS b FROM (SELECT w, unnest(range(1, len(w))) AS i FROM w)),
p3 AS (SELECT w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT w, unnest(range(1, len(w) - 1)) AS i FROM w)),
lex AS (
  SELECT a || ' ' || b AS phrase, 2 AS n FROM p2 WHERE regexp_full_match(a || b, '[a-z]+') AND a <> '' AND b <> '' GROUP BY a, b HAVING count(*) >= 3
  UNION ALL
  SELECT a || ' ' || b || ' ' || c, 3 FROM p3 WHERE regexp_full_match(a || b || c, '[a-z]+') AND a <> '' AND b <> '' AND c <> '' GROUP BY a, b, c HAVING count(*) >= 3)
"""


@register("phrase_replace", oracle=f"""
WITH RECURSIVE {PHRASE_SQL},
t AS (SELECT conv_id, turn, string_split(text, ' ') AS own, w FROM w JOIN conversations USING (conv_id, turn)),
hit AS (SELECT conv_id, turn, i, max(n) AS n FROM (
          SELECT t.conv_id, t.turn, i, lex.n FROM (SELECT conv_id, turn, w, unnest(range(1, len(w))) AS i FROM t) t JOIN lex ON lex.n = 2 AND lex.phrase = w[i] || ' ' || w[i + 1]
          UNION ALL
          SELECT t.conv_id, t.turn, i, lex.n FROM (SELECT conv_id, turn, w, unnest(range(1, len(w) - 1)) AS i FROM t) t JOIN lex ON lex.n = 3 AND lex.phrase = w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        GROUP BY ALL),
walk AS (
  SELECT conv_id, turn, 1::BIGINT AS i FROM t
  UNION ALL
  SELECT walk.conv_id, walk.turn, walk.i + coalesce(hit.n, 1) FROM walk JOIN t USING (conv_id, turn) LEFT JOIN hit ON hit.conv_id = walk.conv_id AND hit.turn = walk.turn AND hit.i = walk.i
  WHERE walk.i < len(t.w)),
put AS (
  SELECT walk.conv_id, walk.turn, walk.i, CASE hit.n WHEN 2 THEN '<' || w[walk.i] || '_' || w[walk.i + 1] || '>'
           WHEN 3 THEN '<' || w[walk.i] || '_' || w[walk.i + 1] || '_' || w[walk.i + 2] || '>' ELSE own[walk.i] END AS word
  FROM walk JOIN t USING (conv_id, turn) LEFT JOIN hit ON hit.conv_id = walk.conv_id AND hit.turn = walk.turn AND hit.i = walk.i
  WHERE walk.i <= len(w))
SELECT conv_id, turn, string_agg(word, ' ' ORDER BY i) AS text_out FROM put GROUP BY ALL
""")
def phrase_replace_q(spark, sf_dir):
    """H12 for phrases: two- and three-word phrases of the table itself, many overlapping, replaced leftmost-longest."""
    conv = table(spark, sf_dir, "conversations").where("text IS NOT NULL")
    w = conv.select(F.split(F.lower("text"), " ", -1).alias("w"))
    lex = None
    for n in (2, 3):
        grams = F.transform(F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: i + n <= F.size("w")), lambda i: F.slice("w", i + 1, n))
        own = w.select(F.explode(grams).alias("g")).where(F.forall("g", lambda x: x.rlike("^[a-z]+$"))).groupBy("g").agg(F.count(F.lit(1)).alias("c")).where("c >= 3")
        own = own.select(F.array_join("g", " ").alias("word"), F.concat(F.lit("<"), F.array_join("g", "_"), F.lit(">")).alias("replacement"))
        lex = own if lex is None else lex.unionByName(own)
    return phrase_replace(conv, "text", lex).select("conv_id", "turn", "text_out")


_INSIDE_SQL = " + ".join(f"({v}) * (length(text) - length(replace(text, '{k}', ''))) // {len(k)}" for k, v in RU.INSIDE_MARKERS)
_MARKERS_SQL = ", ".join(f"('{_q(k)}', {v})" for k, v in RU.QUESTION_MARKERS + RU.EXPERIENCE_MARKERS)


@register("tendency", oracle=f"""
WITH m(token, w) AS (VALUES {_MARKERS_SQL}),
t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}'''']+|[?]')) AS token FROM documents),
s AS (SELECT t.doc_id, sum(m.w) AS score FROM t JOIN m USING (token) GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(s.score, 0) + {_INSIDE_SQL} AS BIGINT) AS score,
       CASE WHEN coalesce(s.score, 0) + {_INSIDE_SQL} > 0 THEN '{RU.TENDENCY_QUESTION}' ELSE '{RU.TENDENCY_EXPERIENCE}' END AS tendency
FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id
""")
def tendency_q(spark, sf_dir):
    """Weighted question/experience markers over each whole document."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", RU.tendency_score("text").alias("score"), RU.tendency("text").alias("tendency"))


@register("merge_comments", oracle=f"""
WITH c AS (SELECT conv_id AS post_id, turn AS pos, text FROM conversations WHERE turn >= 1
           UNION ALL SELECT conv_id, turn + {REPOST_OFFSET}, text FROM conversations WHERE turn >= 1 AND role = 'user'),
k AS (SELECT *, {sql_strip("regexp_replace(lower(text), '\\s+', ' ', 'g')")} AS key FROM c)
SELECT post_id, min(pos) AS first_pos, arg_min(text, pos) AS comment, CAST(count(*) AS BIGINT) AS n_copies
FROM k WHERE key <> '' AND key <> '없음' GROUP BY post_id, key
""")
def merge_comments_q(spark, sf_dir):
    """Comments (turns >= 1) plus users' re-posts; repeats merged with their count."""
    conv = table(spark, sf_dir, "conversations").where(F.col("turn") >= 1)
    c = conv.select(F.col("conv_id").alias("post_id"), F.col("turn").alias("pos"), "text")
    repost = conv.where(F.col("role") == "user").select(F.col("conv_id").alias("post_id"), (F.col("turn") + REPOST_OFFSET).alias("pos"), "text")
    return RU.merge_comments(c.unionByName(repost))


@register("token_cap", oracle=f"""
SELECT doc_id, n_tokens FROM (
  SELECT doc_id, CAST(len(regexp_extract_all({sql_normalize('text')}, '{TOKEN_PATTERN}')) AS BIGINT) AS n_tokens FROM documents)
WHERE n_tokens < {RU.TOKEN_LIMIT}
""")
def token_cap_q(spark, sf_dir):
    """Normalised documents whose estimated token count is below 8192."""
    d = table(spark, sf_dir, "documents").select("doc_id", normalize_text("text").alias("content"))
    return RU.cap_tokens(d, "content").select("doc_id", "n_tokens")


@register("text_vectors", oracle=f"""
SELECT doc_id, CAST({DIMS} AS BIGINT) AS dims,
       CAST(CASE WHEN regexp_matches({sql_normalize('text')}, '[\\p{{L}}\\p{{N}}]') THEN 1.0 ELSE 0.0 END AS DOUBLE) AS norm
FROM documents
""")
def text_vectors_q(spark, sf_dir):
    """U4: hashed tf-idf unit vectors of normalised documents.  The values are not SQL-expressible (hashing);
    the twin checks what the definition fixes: width 256 and unit norm (0 when a text has no word)."""
    d = table(spark, sf_dir, "documents").select("doc_id", normalize_text("text").alias("content"))
    v = text_vectors(d, "content")
    sq = F.aggregate(F.transform("content_vector", lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return v.select("doc_id", F.size("content_vector").cast("bigint").alias("dims"), F.round(F.sqrt(sq), 4).alias("norm"))
