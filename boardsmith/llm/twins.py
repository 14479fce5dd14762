"""DuckDB texts of the queries that SQL can express, over the same tables and with every rule restated in SQL."""

from __future__ import annotations

from boardsmith.llm.quality import STOP_WORDS

# Distinct three-word shingles, links confirmed by exact counts, components by reachability.
NEAR_DEDUP = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
  FROM d),
c AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
t AS MATERIALIZED (SELECT s.r, s.g, c.n FROM s JOIN c USING (r)),
p AS MATERIALIZED (
  SELECT a.r AS x, b.r AS y, a.n AS nx, b.n AS ny, count(*) AS both_in
  FROM t a JOIN t b ON a.g = b.g AND a.r < b.r AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY ALL),
link AS MATERIALIZED (
  SELECT x, y FROM p WHERE 100 * both_in >= 85 * (nx + ny - both_in)
  UNION ALL SELECT y, x FROM p WHERE 100 * both_in >= 85 * (nx + ny - both_in)),
reach AS (SELECT r, r AS o FROM d UNION SELECT reach.r, link.y FROM reach JOIN link ON reach.o = link.x)
SELECT d.doc_id, coalesce(any_value(c.n), 0)::BIGINT AS n_shingles, min(e.doc_id) AS component_id, d.doc_id = min(e.doc_id) AS kept
FROM d JOIN reach ON reach.r = d.r JOIN d e ON e.r = reach.o LEFT JOIN c ON c.r = d.r
GROUP BY d.r, d.doc_id
"""

# The length of an escaped string: each control character grows by the length of its entity less one.
_ESCAPED = """(length({0}) + 4 * (length({0}) - length(replace({0}, '&', ''))) + 3 * (length({0}) - length(replace({0}, '<', '')))
   + 4 * (length({0}) - length(replace({0}, '[', ''))) + 5 * (length({0}) - length(replace({0}, '|', ''))))"""

CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS txt FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (
  SELECT conv_id, role, txt, row_number() OVER own AS k, lag(role) OVER own AS before
  FROM t WINDOW own AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, txt))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || txt || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(txt)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(txt, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({_ESCAPED.format("txt")} + CASE WHEN before IS NULL OR before <> role THEN 8 + {_ESCAPED.format("role")} ELSE 6 END)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

QUALITY = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce("text", '') AS txt,
         regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce("text", ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (SELECT r, unnest(range(1, len(w) - 3)) AS i,
        unnest(list_transform(range(1, len(w) - 3), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4])) AS words5
      FROM d WHERE len(w) >= 5),
f AS (SELECT r, i, count(*) OVER (PARTITION BY r, words5) AS times FROM g),
o AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS after FROM f WHERE times > 1),
rep AS (SELECT r, sum(least(5, coalesce(after - i, 5))) AS n FROM o GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(txt) - length(regexp_replace(txt, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop, len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter
  FROM d LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 2 * n_words AND 20 * n_words AND 10 * n_symbols <= word_chars AND 10 * n_dup_lines <= 3 * n_lines
    AND 50 * n_stop >= n_words AND 10 * n_letter >= 6 * n_words AS kept
FROM b
"""

_TERMS = r"""regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

LEXICAL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
tf AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
a AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
f AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, a GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 75 + (25 * len(w) * n_docs) // n_terms AS m FROM d, a),
q AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT row_number() OVER () AS i, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT i, item_id, r, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""

HARD_NEGATIVES = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id AND len(a.q) = len(b.q)),
pos AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM p WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN p USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

SQL = {"op2_near_dedup": NEAR_DEDUP, "op6_chat": CHAT, "op9_quality": QUALITY, "op11_lexical": LEXICAL, "op12_hard_negatives": HARD_NEGATIVES}
