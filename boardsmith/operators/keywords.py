"""Keyword sets and extraction: D1, G2, D2, D9.

D9 is re-aimed: the reference asks a model for 3-5 keywords per post; here keywords are
the top-k tokens by tf-idf, a deterministic stand-in (not the model's choice).

Scale notes: a document's tokens are counted inside its row (by sorted codes, in Arrow-fed NumPy), so the corpus is not shuffled to count them.  Document
frequencies are one aggregate with map-side combining: a token found in every document costs one partial row per task.
They are written.  The most frequent ``COMMON`` tokens are known in every task, so a document's tokens that cannot be among its k best,
whatever the frequency of the others, are left out before the join; the join needs the rest only (one row in fifteen
on a vocabulary of a million words), by its measured size: a small one is broadcast, in a large one AQE splits hot tokens.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardsmith.functions.text import split_list
from boardsmith.functions.util import pieces
from boardsmith.operators.ranking import with_rank
from boardsmith.session import materialize

# Token pattern for keyword candidates (whole runs of letters of any script and their combining marks, 2 or more).
KEYWORD_TOKEN = r"[\p{L}\p{M}]{2,}"
# Default stop list (function words that never make a useful keyword).
STOP_WORDS = ("the", "and", "for", "that", "with", "this", "are", "was", "from", "have", "not", "but", "you", "all", "its")


COMMON = 100_000  # tokens whose document frequency every task knows; as many stop words at most


def tokens(df: DataFrame, id_col: str, text_col: str, pattern: str = KEYWORD_TOKEN) -> DataFrame:
    """(id, token) for every match in the lower-cased whole text."""
    return df.select(F.col(id_col).alias("doc_id"), F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(pattern), 0)).alias("token"))


def counted_tokens(text: Column, pattern: str = KEYWORD_TOKEN) -> Column:
    """(token, tf) of every distinct token of the lower-cased text: the sorted tokens, cut where the token changes."""
    found = F.sort_array(F.regexp_extract_all(F.lower(text), F.lit(pattern), 0))

    def runs(t):
        at = F.sequence(F.lit(0), F.size(t) - 1)
        ends = F.filter(at, lambda i: (i == F.size(t) - 1) | (F.get(t, i) != F.get(t, i + 1)))
        return F.get(F.transform(F.array(ends), lambda e: F.transform(
            e, lambda last, k: F.struct(F.get(t, last).alias("token"), (last - F.when(k > 0, F.get(e, k - 1)).otherwise(-1)).cast("bigint").alias("tf")))), F.lit(0))

    empty = F.array().cast("array<struct<token:string,tf:bigint>>")
    return F.get(F.transform(F.array(found), lambda t: F.when(F.size(t) > 0, runs(t)).otherwise(empty)), F.lit(0))


def _common(dfreq: DataFrame, most: int) -> tuple[list, int]:
    """The (token, df) of the most frequent tokens, ``most`` at most, and a bound of the frequency of all others (0: there are none)."""
    counts = dfreq.groupBy("df").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("df")).limit(most + 1).collect()  # one row for each frequency
    taken, least, rest = 0, None, 0
    for r in counts:
        if taken + r["n"] > most:
            rest = r["df"]
            break
        taken, least = taken + r["n"], r["df"]
    return ([tuple(r) for r in dfreq.where(F.col("df") >= least).select("token", "df").collect()] if least is not None else []), rest


def _candidates(shared, n_docs: int, rest: int, k: int, slack: float):
    """(doc_id, tokens) -> (doc_id, token, tf) of each token that may be one of the k best: k others with a surely higher score rule it out."""
    highest, least = math.log(n_docs), math.log(n_docs / max(rest, 1))  # the bounds of ln(N / df) of a token that is not common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, df, stop = shared.value
        names, stop = pa.array(names, pa.string()), pa.array(stop, pa.string())
        idf = np.append(np.log(n_docs / np.asarray(df, np.float64)), 0.0)
        for b in batches:
            for p in pieces(b, 8_000_000):
                found, n = p.column(1).flatten().dictionary_encode(), pc.fill_null(pc.list_value_length(p.column(1)), 0).to_numpy()
                words, width = found.dictionary, max(1, len(found.dictionary))
                pairs, times = np.unique(np.repeat(np.arange(len(n)), n) * width + found.indices.to_numpy(), return_counts=True)
                row, word, tf = pairs // width, pairs % width, times.astype(np.float64)
                at = pc.fill_null(pc.index_in(words, value_set=names), -1).to_numpy()[word]
                low, high = tf * np.where(at < 0, least, idf[at]), tf * np.where(at < 0, highest, idf[at])
                own = np.flatnonzero(~pc.is_in(words, value_set=stop).to_numpy(zero_copy_only=False)[word])
                order = own[np.lexsort((-low[own], row[own]))]  # each document's tokens, the surest first
                first = np.searchsorted(row[order], np.arange(len(n)))
                size = np.bincount(row[order], minlength=len(n))
                need = np.full(len(n), -np.inf)
                need[size >= k] = low[order[first[size >= k] + k - 1]]
                kept = own[high[own] >= need[row[own]] * (1 - 1e-12) - slack]
                yield pa.RecordBatch.from_arrays([p.column(0).take(pa.array(row[kept])), words.take(pa.array(word[kept])), pa.array(times[kept], pa.int64())], names=["doc_id", "token", "tf"])

    return run


def top_keywords(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, stop: DataFrame | None = None,
                 digits: int = 6, common: int = COMMON) -> DataFrame:
    """(doc_id, rank, keyword, score); score = tf * ln(N / df), ties by keyword."""
    spark = docs.sparkSession
    if stop is None:
        stop = spark.createDataFrame([(w,) for w in STOP_WORDS], "token string")
    found = docs.select(F.col(id_col).alias("doc_id"), F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(KEYWORD_TOKEN), 0).alias("_t"))
    dfreq = materialize(found.select(F.explode(F.array_distinct("_t")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df")).join(stop.select("token"), "token", "left_anti"), "document-frequency")
    n_docs = docs.select(F.col(id_col)).count()
    left_out = [r[0] for r in stop.select("token").distinct().limit(common + 1).collect()]
    if n_docs and k > 0 and len(left_out) <= common:  # a longer stop list than any language has: all rows are joined
        known, rest = _common(dfreq, common)
        shared = spark.sparkContext.broadcast(([t for t, _ in known], [n for _, n in known], left_out))
        kind = found.schema["doc_id"].dataType.simpleString()
        tf = found.mapInArrow(_candidates(shared, n_docs, rest, k, 2 * 10.0 ** -digits), f"doc_id {kind}, token string, tf bigint")
    else:
        tf = docs.select(F.col(id_col).alias("doc_id"), F.inline(counted_tokens(F.col(text_col))))
    score = F.round(F.col("tf").cast("double") * F.log(F.lit(float(n_docs)) / F.col("df").cast("double")), digits)
    scored = tf.join(dfreq, "token").select("doc_id", "token", score.alias("score"))
    w = Window.partitionBy("doc_id").orderBy(F.col("score").desc(), F.col("token").asc())
    return (
        scored.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("doc_id", F.col("rank").cast("bigint").alias("rank"), F.col("token").alias("keyword"), "score")
    )


def keyword_strings(top: DataFrame, sep: str = "; ") -> DataFrame:
    """(doc_id, keywords) with the keywords joined in rank order (the refined column form)."""
    return top.groupBy("doc_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "keyword"))), lambda x: x["keyword"]), sep).alias("keywords")
    )


def distinct_keywords(refined: DataFrame, col: str = "keywords", sep: str = ";") -> DataFrame:
    """Distinct trimmed keywords over all rows; null rows skipped, blanks dropped."""
    return refined.select(F.explode(split_list(F.col(col), sep)).alias("keyword")).distinct()


def keyword_union(*sets: DataFrame) -> DataFrame:
    """Set union of keyword columns (``union`` + ``distinct``)."""
    out = sets[0].select("keyword")
    for s in sets[1:]:
        out = out.union(s.select("keyword"))
    return out.distinct()


def keyword_frequency(refined: DataFrame, id_col: str = "id", col: str = "keywords", sep: str = ";") -> DataFrame:
    """(keyword, n_posts): in how many posts each keyword occurs."""
    pk = refined.select(F.col(id_col).alias("post_id"), F.explode(F.array_distinct(split_list(F.col(col), sep))).alias("keyword"))
    return pk.groupBy("keyword").agg(F.count(F.lit(1)).cast("bigint").alias("n_posts"))


def keyword_rank(refined: DataFrame, id_col: str = "id", col: str = "keywords") -> DataFrame:
    """(rank, keyword, n_posts) of every keyword, most frequent first, ties by keyword.

    Most of a vocabulary occurs in one post, so the ranking cuts (n_posts, keyword), not n_posts alone.
    """
    kf = materialize(keyword_frequency(refined, id_col, col), "keyword-frequency")
    return with_rank(kf, [("n_posts", True), "keyword"], start=1).select("rank", "keyword", "n_posts")


def keyword_list(refined: DataFrame, chunk: int = 300, id_col: str = "id", col: str = "keywords") -> DataFrame:
    """The whole keyword vocabulary as prompt values of ``chunk`` keywords, most frequent first.

    (chunk_no, n_keywords, keywords).
    """
    ranked = keyword_rank(refined, id_col, col)
    return ranked.groupBy(F.floor((F.col("rank") - 1) / chunk).cast("bigint").alias("chunk_no")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_keywords"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "keyword"))), lambda x: x["keyword"]), "; ").alias("keywords"),
    )


def compound_keywords(docs: DataFrame, text_col: str = "text", least: int = 3, score: float = 10.83, names: DataFrame | None = None,
                      stop: DataFrame | None = None, digits: int = 3) -> DataFrame:
    """(term, n_times, score) of neighbouring words that belong together, by the log-likelihood ratio of their counts.

    Words are keyword tokens, neighbours whatever stands between them.  A pair counts from ``least`` occurrences, a higher
    count than by chance, and a ratio of ``score`` (10.83: one chance in a thousand).  Pairs with a stop word, pairs that are a term of ``stop`` and
    pairs that hold or are part of a name of ``names`` (column ``name``, e.g. companies, one or two words) are left out.

    Pairs are counted with map-side combining; every later step is as large as the vocabulary of pairs.
    """
    spark = docs.sparkSession
    found = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(KEYWORD_TOKEN), 0)
    pairs = F.transform(F.sequence(F.lit(1), F.size("_t") - 1), lambda i: F.struct(F.get("_t", i - 1).alias("a"), F.get("_t", i).alias("b")))
    rows = docs.select(found.alias("_t")).where(F.size("_t") > 1).select(F.inline(pairs))
    counts = materialize(rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "pairs")
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent = counts.where(F.col("n") >= least)
    first = counts.groupBy("a").agg(F.sum("n").alias("n_a"))
    second = counts.groupBy("b").agg(F.sum("n").alias("n_b"))
    both = frequent.join(first, "a").join(second, "b")
    cell = lambda k, row, col: F.when(k > 0, k * F.log(k * F.lit(float(total)) / (row * col))).otherwise(0.0)
    n, n_a, n_b = (F.col(c).cast("double") for c in ("n", "n_a", "n_b"))
    rest = F.lit(float(total))
    ratio = 2 * (cell(n, n_a, n_b) + cell(n_a - n, n_a, rest - n_b) + cell(n_b - n, rest - n_a, n_b) + cell(rest - n_a - n_b + n, rest - n_a, rest - n_b))
    out = both.where(n * total > n_a * n_b).withColumn("score", F.round(ratio, digits)).where(F.col("score") >= score)
    out = out.withColumn("term", F.concat_ws(" ", "a", "b"))
    singles = spark.createDataFrame([(w,) for w in STOP_WORDS], "w string")
    if names is not None:
        name = F.split(F.trim(F.lower("name")), r"\s+")
        words = names.select(name.alias("_n"))
        singles = singles.unionByName(words.where(F.size("_n") == 1).select(F.get("_n", F.lit(0)).alias("w")))
        out = out.join(words.where(F.size("_n") == 2).select(F.array_join("_n", " ").alias("term")).distinct(), "term", "left_anti")
    if stop is not None:
        out = out.join(stop.select(F.lower("term").alias("term")).distinct(), "term", "left_anti")
    singles = materialize(singles.distinct(), "left-out-words")
    for side in ("a", "b"):
        out = out.join(singles.select(F.col("w").alias(side)), side, "left_anti")
    return out.select("term", F.col("n").alias("n_times"), "score")
