"""Stand-in inputs derived from the driver tables, written once in Spark and once in SQL.

The reference's inputs (crawled posts, model replies) are not in the driver tables; these
derivations give them the reference's *shape* (see FIXTURES.md) from whole tables, with
edge cases chosen by data values (``source``, ``lang``), never by dropping rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardsmith.session import table

# Which document sources stand in for the crawler's edge cases.
NULL_TITLE_SOURCE = "src3"     # title node missing
BLANK_TITLE_SOURCE = "src7"    # title node present, only spaces
NA_CONTENTS_SOURCE = "src11"   # contents node missing -> "N/A" (kept)
EMPTY_CONTENTS_SOURCE = "src13"  # contents node empty (dropped)
NA_VIEWS_SOURCE = "src5"       # view node missing
EMPTY_DATE_SOURCE = "src17"    # date node empty (dropped)
RELATIVE_DATE_SOURCE = "src19"  # relative date text

BASE_TS = "2025-01-01 00:00:00"


def raw_posts(spark, sf_dir: str) -> DataFrame:
    """Crawled-post shape: post_id, title, contents, date_text, views_text (nulls = missing nodes)."""
    d = table(spark, sf_dir, "documents")
    src = F.col("source")
    date_txt = F.expr(f"date_format(TIMESTAMP_NTZ'{BASE_TS}' + make_dt_interval(0, 0, CAST(n_chars AS INT), 0), 'yyyy-MM-dd HH:mm')")
    return d.select(
        F.col("doc_id").alias("post_id"),
        F.when(src == NULL_TITLE_SOURCE, F.lit(None).cast("string"))
        .when(src == BLANK_TITLE_SOURCE, F.lit("   "))
        .otherwise(src)
        .alias("title"),
        F.when(src == NA_CONTENTS_SOURCE, F.lit(None).cast("string"))
        .when(src == EMPTY_CONTENTS_SOURCE, F.lit(""))
        .otherwise(F.col("text"))
        .alias("contents"),
        F.when(src == EMPTY_DATE_SOURCE, F.lit(""))
        .when(src == RELATIVE_DATE_SOURCE, F.concat((F.col("n_chars") % 60).cast("string"), F.lit("분전")))
        .otherwise(date_txt)
        .alias("date_text"),
        F.when(src == NA_VIEWS_SOURCE, F.lit("N/A")).otherwise(F.format_number("n_chars", 0)).alias("views_text"),
    )


RAW_POSTS_SQL = f"""
raw_posts AS (
  SELECT doc_id AS post_id,
         CASE WHEN source = '{NULL_TITLE_SOURCE}' THEN NULL WHEN source = '{BLANK_TITLE_SOURCE}' THEN '   ' ELSE source END AS title,
         CASE WHEN source = '{NA_CONTENTS_SOURCE}' THEN NULL WHEN source = '{EMPTY_CONTENTS_SOURCE}' THEN '' ELSE text END AS contents,
         CASE WHEN source = '{EMPTY_DATE_SOURCE}' THEN ''
              WHEN source = '{RELATIVE_DATE_SOURCE}' THEN CAST(n_chars % 60 AS VARCHAR) || '분전'
              ELSE strftime(TIMESTAMP '{BASE_TS}' + to_minutes(CAST(n_chars AS BIGINT)), '%Y-%m-%d %H:%M') END AS date_text,
         CASE WHEN source = '{NA_VIEWS_SOURCE}' THEN 'N/A' ELSE format('{{:,}}', n_chars) END AS views_text
  FROM documents)
"""

# SQL spelling of the Python whitespace strip used by the Spark side (ASCII set suffices for the tables).
def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def sql_normalize(x: str) -> str:
    """SQL spelling of H1 (normalize_text)."""
    s = sql_strip(f"regexp_replace({x}, '\\s+', ' ', 'g')")
    s = f"replace(replace(replace(regexp_replace({s}, '. ,', '', 'g'), '..', '.'), '. .', '.'), chr(10), '')"
    return sql_strip(s)
