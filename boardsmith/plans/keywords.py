"""D9, D1, G2, D2, D7, C3, W3 on documents: tf-idf keywords stand in for the model's keywords."""

from __future__ import annotations

from pyspark.sql import functions as F

from boardsmith.operators import categories as C
from boardsmith.operators import keywords as K
from boardsmith.plans import register
from boardsmith.plans.fixtures import sql_strip
from boardsmith.session import materialize, table

TOPK = 5
N_CATEGORIES = 10
LIST_CHUNK = 300
TOKEN_SQL = r"[\p{L}\p{M}]{2,}"
_STOP_SQL = ", ".join(f"'{w}'" for w in K.STOP_WORDS)


def top_keywords(spark, sf_dir):
    return K.top_keywords(table(spark, sf_dir, "documents"), "doc_id", "text", k=TOPK)


def refined(spark, sf_dir):
    """Refined-post stand-in: (id, keywords) — top-5 tf-idf keywords joined ``'; '``; French rows end in ``;``."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    kw = K.keyword_strings(top_keywords(spark, sf_dir))
    r = d.join(kw, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("lang") == "fr", F.concat("keywords", F.lit(";"))).otherwise(F.col("keywords")).alias("keywords"),
    )
    return materialize(r, "refined_keywords")


TOP_SQL = f"""
tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{TOKEN_SQL}')) AS token FROM documents),
tf AS (SELECT doc_id, token, count(*) AS tf FROM tok WHERE token NOT IN ({_STOP_SQL}) GROUP BY 1, 2),
dfreq AS (SELECT token, count(*) AS df FROM tf GROUP BY 1),
sc AS (SELECT tf.doc_id, tf.token, round(tf.tf * ln((SELECT count(*) FROM documents) / dfreq.df), 6) AS score
       FROM tf JOIN dfreq USING (token)),
top AS (SELECT doc_id, token AS keyword, score, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, token) AS rank
        FROM sc QUALIFY rank <= {TOPK})
"""

_SPLIT = f"list_filter(list_transform(string_split(keywords, ';'), lambda x: {sql_strip('x')}), lambda x: x <> '')"

REFINED_SQL = f"""
{TOP_SQL},
kw AS (SELECT doc_id, string_agg(keyword, '; ' ORDER BY rank) AS keywords FROM top GROUP BY doc_id),
refined AS (SELECT d.doc_id AS id, CASE WHEN d.lang = 'fr' THEN kw.keywords || ';' ELSE kw.keywords END AS keywords
            FROM documents d LEFT JOIN kw ON kw.doc_id = d.doc_id),
pk AS (SELECT DISTINCT id AS post_id, keyword FROM (SELECT id, unnest({_SPLIT}) AS keyword FROM refined))
"""

HOPS = 12  # rounds written out in the twin; more than any table here needs


def _members_sql() -> str:
    out = f"""
freq AS MATERIALIZED (SELECT keyword, count(*) AS n_posts FROM pk GROUP BY 1),
anchors AS MATERIALIZED (SELECT keyword AS name, n_posts AS anchor_posts, CAST(row_number() OVER (ORDER BY n_posts DESC, keyword) AS INTEGER) AS ord
            FROM freq QUALIFY ord <= {N_CATEGORIES}),
o0 AS MATERIALIZED (SELECT name AS keyword, ord, 0 AS hop FROM anchors)"""
    for h in range(1, HOPS + 1):
        before = " UNION ALL ".join(f"SELECT keyword FROM o{k}" for k in range(h))
        out += f""",
o{h} AS MATERIALIZED (
  SELECT keyword, ord, {h} AS hop FROM (
    SELECT u.keyword, f.ord, count(*) AS w FROM o{h - 1} f JOIN pk v ON v.keyword = f.keyword JOIN pk u ON u.post_id = v.post_id
    WHERE u.keyword NOT IN ({before}) GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY w DESC, ord) = 1)"""
    every = " UNION ALL ".join(f"SELECT * FROM o{k}" for k in range(HOPS + 1))
    return out + f""",
own AS ({every}),
members AS MATERIALIZED (
  SELECT coalesce(own.ord, (SELECT CAST(count(*) + 1 AS INTEGER) FROM anchors)) AS ord, coalesce(a.name, 'other') AS name, freq.keyword, own.hop, freq.n_posts
  FROM freq LEFT JOIN own USING (keyword) LEFT JOIN anchors a ON a.ord = own.ord)"""


CATS_SQL = f"""
{REFINED_SQL},
{_members_sql()},
placed AS (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY hop NULLS LAST, n_posts DESC, keyword) - 1 AS place FROM members),
told AS (SELECT ord, coalesce(max(CASE WHEN hop = 0 THEN n_posts END), sum(n_posts)) AS posts FROM members GROUP BY ord),
cats AS (SELECT ord, CAST(place // {C.CHUNK} AS BIGINT) AS chunk_no, any_value(name) AS name,
                'Posts about ' || any_value(name) || ' and related topics (' || any_value(posts) || ' posts)' AS description,
                list(keyword ORDER BY place) AS related_keywords
         FROM placed JOIN told USING (ord) GROUP BY ALL),
hits AS (SELECT pk.post_id, pk.keyword, m.ord, m.name AS category FROM pk JOIN members m USING (keyword))
"""


@register("top_keywords", oracle=f"WITH {TOP_SQL} SELECT doc_id, CAST(rank AS BIGINT) AS rank, keyword, score FROM top")
def top_keywords_q(spark, sf_dir):
    """Top-5 tf-idf tokens per document, stop words excluded."""
    return top_keywords(spark, sf_dir)


@register("distinct_keywords", oracle=f"WITH {REFINED_SQL} SELECT DISTINCT unnest({_SPLIT}) AS keyword FROM refined")
def distinct_keywords_q(spark, sf_dir):
    """Distinct keywords of the refined table (null rows skipped, blanks from trailing ``;`` dropped)."""
    return K.distinct_keywords(refined(spark, sf_dir))


@register("keyword_union", oracle=f"""
WITH {REFINED_SQL}
SELECT unnest({_SPLIT}) AS keyword FROM refined
UNION
SELECT unnest(regexp_extract_all(lower(text), '{TOKEN_SQL}')) AS keyword FROM benchmark
""")
def keyword_union_q(spark, sf_dir):
    """Refined keywords united with the benchmark items' tokens, as a set."""
    b = K.tokens(table(spark, sf_dir, "benchmark"), "item_id", "text").select(F.col("token").alias("keyword"))
    return K.keyword_union(K.distinct_keywords(refined(spark, sf_dir)), b)


@register("keyword_rank", oracle=f"""
WITH {REFINED_SQL},
kf AS (SELECT keyword, count(*) AS n_posts FROM pk GROUP BY 1)
SELECT row_number() OVER (ORDER BY n_posts DESC, keyword) AS rank, keyword, n_posts FROM kf
""")
def keyword_rank_q(spark, sf_dir):
    """Every keyword with its global rank by (frequency, keyword)."""
    return K.keyword_rank(refined(spark, sf_dir))


@register("keyword_list", oracle=f"""
WITH {REFINED_SQL},
kf AS (SELECT keyword, count(*) AS n_posts FROM pk GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (ORDER BY n_posts DESC, keyword) - 1 AS r FROM kf)
SELECT CAST(r // {LIST_CHUNK} AS BIGINT) AS chunk_no, CAST(count(*) AS BIGINT) AS n_keywords, string_agg(keyword, '; ' ORDER BY r) AS keywords
FROM ranked GROUP BY 1
""")
def keyword_list_q(spark, sf_dir):
    """The whole vocabulary, 300 keywords to a prompt value."""
    return K.keyword_list(refined(spark, sf_dir), LIST_CHUNK)


@register("category_members", oracle=f"WITH {CATS_SQL} SELECT ord, name, keyword, hop, n_posts FROM members")
def category_members_q(spark, sf_dir):
    """Every distinct keyword once, with the category that owns it and the round that found it."""
    return C.category_members(refined(spark, sf_dir), N_CATEGORIES)


@register("build_categories", oracle=f"""
WITH {CATS_SQL}
SELECT ord, chunk_no, name, description, array_to_string(related_keywords, '; ') AS related_keywords, CAST(len(related_keywords) AS BIGINT) AS n_keywords
FROM cats
""")
def build_categories_q(spark, sf_dir):
    """10 categories anchored on the most frequent keywords and the remainder, all keywords in rows of 1,000."""
    c = C.build_categories(refined(spark, sf_dir), N_CATEGORIES)
    return c.withColumn("related_keywords", F.array_join("related_keywords", "; "))


@register("keyword_category_join", oracle=f"WITH {CATS_SQL} SELECT post_id, keyword, ord, category FROM hits")
def keyword_category_join_q(spark, sf_dir):
    """Post keywords matched to category keywords."""
    r = refined(spark, sf_dir)
    return C.keyword_categories(r, materialize(C.category_members(r, N_CATEGORIES), "members"))


@register("assign_categories", oracle=f"""
WITH {CATS_SQL},
score AS (SELECT post_id, ord, category, count(DISTINCT keyword) AS score FROM hits GROUP BY 1, 2, 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY score DESC, ord) AS r FROM score QUALIFY r <= 2),
picks AS (SELECT post_id, max(CASE WHEN r = 1 THEN category END) AS p1, max(CASE WHEN r = 2 THEN category END) AS p2 FROM ranked GROUP BY 1)
SELECT r.id, r.keywords, coalesce(p.p1, '') AS primary_category, coalesce(p.p2, '') AS secondary_category
FROM refined r LEFT JOIN picks p ON p.post_id = r.id
""")
def assign_categories_q(spark, sf_dir):
    """Every refined post once, with its primary and secondary category (``''`` only without keywords or a second category)."""
    r = refined(spark, sf_dir)
    members = materialize(C.category_members(r, N_CATEGORIES), "members")
    return C.assign_categories(r, members).select("id", "keywords", "primary_category", "secondary_category")


# Names that compounds must not hold: the first word of every benchmark item.
_NAMES_SQL = f"SELECT DISTINCT regexp_extract(lower(text), '{TOKEN_SQL}') AS name FROM benchmark"


@register("compound_keywords", oracle=f"""
WITH t AS (SELECT regexp_extract_all(lower(text), '{TOKEN_SQL}') AS w FROM documents),
pairs AS MATERIALIZED (SELECT w[i] AS a, w[i + 1] AS b, count(*) AS n FROM (SELECT w, unnest(range(1, len(w))) AS i FROM t) GROUP BY ALL),
tot AS (SELECT sum(n)::DOUBLE AS total FROM pairs),
fa AS (SELECT a, sum(n)::DOUBLE AS n_a FROM pairs GROUP BY 1), fb AS (SELECT b, sum(n)::DOUBLE AS n_b FROM pairs GROUP BY 1),
k AS (SELECT a, b, n, n::DOUBLE AS k11, n_a - n AS k12, n_b - n AS k21, total - n_a - n_b + n AS k22, n_a, n_b, total
      FROM pairs JOIN fa USING (a) JOIN fb USING (b), tot WHERE n >= 3),
names AS ({_NAMES_SQL}),
s AS (SELECT a, b, n, round(2 * (k11 * ln(k11 * total / (n_a * n_b)) + CASE WHEN k12 > 0 THEN k12 * ln(k12 * total / (n_a * (total - n_b))) ELSE 0 END
             + CASE WHEN k21 > 0 THEN k21 * ln(k21 * total / ((total - n_a) * n_b)) ELSE 0 END
             + CASE WHEN k22 > 0 THEN k22 * ln(k22 * total / ((total - n_a) * (total - n_b))) ELSE 0 END), 3) AS score
      FROM k WHERE k11 * total > n_a * n_b)
SELECT a || ' ' || b AS term, n AS n_times, score FROM s
WHERE score >= 10.83 AND a NOT IN ({_STOP_SQL}) AND b NOT IN ({_STOP_SQL}) AND a NOT IN (SELECT name FROM names) AND b NOT IN (SELECT name FROM names)
""")
def compound_keywords_q(spark, sf_dir):
    """Two-word keywords by association, without those that hold a name of a table (the benchmark items' first words)."""
    b = table(spark, sf_dir, "benchmark")
    names = b.select(F.regexp_substr(F.lower("text"), F.lit(K.KEYWORD_TOKEN)).alias("name")).where("name IS NOT NULL")
    return K.compound_keywords(table(spark, sf_dir, "documents"), names=names)
