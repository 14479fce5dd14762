"""Categories: members and store (D7), keyword lookup (C3), primary/secondary assignment.

Re-aimed: the reference asks a model to invent 10 categories and to classify each post.  Here a category is an *anchor*
keyword (one of the n most frequent) and every keyword that reaches it over shared posts; a post's categories are those
whose keywords it shares most.  These are deterministic stand-ins with the same output shape, not the model's results.

Every keyword has one owner, found by weighted label propagation in rounds: a keyword without an owner that shares posts with
keywords owned in the round before goes to the category with the most such (post, keyword) pairs, ties to the earlier
anchor.  Rounds end when one owns nothing new; what no anchor reaches is the ``REMAINDER``, a category after all others.

Scale: a round counts the owned keywords of each post by category before posts meet the keywords without an owner, so no
pairs of keywords are formed; a round's owners and the posts that hold them are written, and the next round reads only them and
what is still free.  Rounds halve towards the end: a late round's written tables are small enough for Spark to broadcast, so it
scans the free rows and shuffles none.  Anchors are n rows.
Ranks inside categories cut (category, round, frequency, keyword), so one category may hold most keywords.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boardsmith.functions.text import split_list
from boardsmith.operators.ranking import with_rank
from boardsmith.session import materialize

# How a built category describes itself, and the name of the category of all that no anchor reaches.
DESCRIPTION = "Posts about %s and related topics (%d posts)"
REMAINDER = "other"
HELD = 100_000  # owners of a round above which the rows still free are written again
LATE = 8  # rounds of fewer owners before they are
CHUNK = 1000  # keywords of a category in one row of the store


def post_keywords(refined: DataFrame, id_col: str = "id", col: str = "keywords", sep: str = ";") -> DataFrame:
    """(post_id, keyword) distinct per post."""
    return refined.select(F.col(id_col).alias("post_id"), F.explode(F.array_distinct(split_list(F.col(col), sep))).alias("keyword"))


def category_members(refined: DataFrame, n: int = 10, id_col: str = "id", col: str = "keywords") -> DataFrame:
    """(ord, name, keyword, hop, n_posts): every distinct keyword once, with its owner.

    ``hop`` is 0 for an anchor, else the round that gave the owner (null in the remainder, whose ``ord`` is n + 1 or one above the last anchor).
    """
    pk = materialize(post_keywords(refined, id_col, col), "post-keywords")
    freq = materialize(pk.groupBy("keyword").agg(F.count(F.lit(1)).alias("n_posts")), "keyword-frequency")
    top = freq.orderBy(F.desc("n_posts"), "keyword").limit(n).collect()  # n rows
    spark = refined.sparkSession
    anchors = spark.createDataFrame([(i, r["keyword"]) for i, r in enumerate(top, 1)], "ord int, name string")
    owned, free, gained, late = [], pk, F.broadcast(anchors.select(F.col("name").alias("keyword"), "ord", F.lit(0).alias("hop"))), 0
    n_gained = len(top)
    while n_gained:
        owned.append(gained)
        late += 1
        if n_gained > HELD or late > LATE:  # the rows still free are written, so that no later round shuffles the others
            rows = materialize(free.join(gained.select("keyword", "ord"), "keyword", "left"), "free-keywords")
            won, free, late = rows.where("ord IS NOT NULL"), rows.where("ord IS NULL").select("post_id", "keyword"), 0
        else:
            won, free = free.join(gained.select("keyword", "ord"), "keyword"), free.join(gained.select("keyword"), "keyword", "left_anti")
        near = materialize(won.groupBy("post_id", "ord").agg(F.count(F.lit(1)).alias("pairs")), "near-posts")
        weight = free.join(near, "post_id").groupBy("keyword", "ord").agg(F.sum("pairs").alias("weight"))
        best = weight.groupBy("keyword").agg(F.max(F.struct("weight", (-F.col("ord")).alias("first"))).alias("b"))
        gained = materialize(best.select("keyword", (-F.col("b.first")).alias("ord"), F.lit(len(owned)).alias("hop")), "owners")
        n_gained = gained.count()
    owned = owned or [gained]
    own = reduce(DataFrame.unionByName, owned)
    named = F.broadcast(anchors.unionByName(spark.createDataFrame([(len(top) + 1, REMAINDER)], anchors.schema)))
    every = freq.join(own, "keyword", "left").withColumn("ord", F.coalesce("ord", F.lit(len(top) + 1)))
    return every.join(named, "ord").select("ord", "name", "keyword", "hop", "n_posts")


def category_store(members: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(ord, chunk_no, name, description, related_keywords array, n_keywords): a category's keywords, anchor first, then by round,
    frequency and keyword, in rows of ``chunk`` keywords."""
    members = materialize(members.withColumn("_far", F.coalesce("hop", F.lit((1 << 31) - 1))), "category-members")
    ranked = materialize(with_rank(members, ["ord", "_far", ("n_posts", True), "keyword"], "_place"), "ranked-members")
    # The first keyword of a category says where its places begin and how it is described.
    heads = ranked.groupBy("ord").agg(F.min("_place").alias("_start"), F.max(F.when(F.col("hop") == 0, F.col("n_posts"))).alias("_posts"), F.sum("n_posts").alias("_all"))
    placed = ranked.join(F.broadcast(heads), "ord").withColumn("_place", F.col("_place") - F.col("_start"))
    grouped = placed.groupBy("ord", F.floor(F.col("_place") / chunk).cast("bigint").alias("chunk_no")).agg(
        F.first("name").alias("name"), F.first(F.coalesce("_posts", "_all")).alias("_posts"), F.array_sort(F.collect_list(F.struct("_place", "keyword"))).alias("_m"))
    return grouped.select("ord", "chunk_no", "name", F.format_string(DESCRIPTION, F.col("name"), F.col("_posts")).alias("description"),
                          F.transform("_m", lambda x: x["keyword"]).alias("related_keywords"), F.size("_m").cast("bigint").alias("n_keywords"))


def build_categories(refined: DataFrame, n: int = 10, id_col: str = "id", col: str = "keywords", chunk: int = CHUNK) -> DataFrame:
    """The category store of ``category_members``."""
    return category_store(category_members(refined, n, id_col, col), chunk)


def _by_keyword(categories: DataFrame) -> DataFrame:
    """(ord, category, keyword) of a store (arrays) or of members (a row for each keyword)."""
    keyword = F.col("keyword") if "keyword" in categories.columns else F.explode("related_keywords").alias("keyword")
    return categories.select("ord", F.col("name").alias("category"), keyword).distinct()


def keyword_categories(refined: DataFrame, categories: DataFrame, id_col: str = "id", col: str = "keywords") -> DataFrame:
    """(post_id, keyword, ord, category) for every keyword found in a category (many-to-many).

    Spark joins by the measured size of the category table: a small one is broadcast, a large one shuffled with skewed keywords split.
    """
    return post_keywords(refined, id_col, col).join(_by_keyword(categories), "keyword").select("post_id", "keyword", "ord", "category")


def assign_categories(refined: DataFrame, categories: DataFrame, id_col: str = "id", col: str = "keywords") -> DataFrame:
    """Refined rows + primary_category, secondary_category (``''`` when none).

    Score = number of distinct shared keywords; ties go to the lower category ``ord``.
    Every input row comes out exactly once (left join back).
    """
    hits = keyword_categories(refined, categories, id_col, col)
    score = hits.groupBy("post_id", "ord", "category").agg(F.count(F.lit(1)).alias("score"))
    w = Window.partitionBy("post_id").orderBy(F.col("score").desc(), F.col("ord").asc())
    ranked = score.withColumn("r", F.row_number().over(w)).where(F.col("r") <= 2)
    picks = ranked.groupBy("post_id").agg(
        F.max(F.when(F.col("r") == 1, F.col("category"))).alias("primary_category"),
        F.max(F.when(F.col("r") == 2, F.col("category"))).alias("secondary_category"),
    )
    out = refined.join(picks.withColumnRenamed("post_id", id_col), id_col, "left")
    return out.withColumn("primary_category", F.coalesce("primary_category", F.lit(""))).withColumn(
        "secondary_category", F.coalesce("secondary_category", F.lit(""))
    )
