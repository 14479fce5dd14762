"""URL filter: list rules first, then the ratio of two character language models.

Rules are a small parameter table; the longest rule that fits a URL decides.  The URLs that a rule accepts or
rejects train two variable-order Markov models of characters, all with DataFrame functions: counts of every gram
of up to ``ORDER + 1`` folded characters, each order's probability smoothed by the next shorter one's.  A
character is predicted by the longest context in which it has been seen, and a URL is judged by the mean
log-likelihood difference of its characters against a threshold calibrated on labelled URLs kept out of training.

Folding leaves 32 symbols, so a model holds at most 32 + 32**2 + 32**3 + 32**4 grams (about 1.1 million) whatever the
input; that bound is why it may be broadcast.

Defined cases: a null URL or one without ``://`` has empty host and path and fits no rule; an empty URL
scores 0; when one class has no labelled URL there is no model, and every other URL is allowed; null or repeated ids
give one row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardsmith.llm.common import prepare
from boardsmith.session import materialize

ALLOW, BLOCK = "allow", "block"
ORDER, SYMBOLS, SMOOTHING = 3, 32, 4.0
START = "^"
HELD_OUT = 5  # one of so many labelled URLs calibrates the threshold
KEEP_SHARE = 0.95  # of the held-out accepted URLs that the threshold keeps


@dataclass(frozen=True)
class Rule:
    """``host/path-prefix`` with its verdict; fits the host and all its subdomains."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


# The rules of the query.
RULES = (Rule(ALLOW, "org/"), Rule(BLOCK, "example.org/es/"), Rule(BLOCK, "example.org/en/1"), Rule(ALLOW, "com/fr/"), Rule(BLOCK, "com/de/"))

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*).*$"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def best_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (size, rule, verdict) of the longest rule that fits; null without one."""
    kind = "struct<size:int,rule:string,verdict:string>"
    best = [F.lit(None).cast(kind)] * 2
    for r in rules:
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        best.append(F.when(fits, F.struct(F.lit(len(r.pattern)).alias("size"), F.lit(r.pattern).alias("rule"), F.lit(r.verdict).alias("verdict"))).cast(kind))
    return F.greatest(*best)


def folded(url: Column) -> Column:
    """Lower case; digits, other characters and the start each become one symbol."""
    low = F.lower(F.coalesce(url, F.lit("")))
    return F.regexp_replace(F.regexp_replace(low, "[0-9]", "0"), r"[^a-z0/.\-]", "~")


def _places(rows: DataFrame) -> DataFrame:
    """One row per character of ``text``, with the grams that end there as ``g0`` to ``g<ORDER>``."""
    at = rows.withColumn("i", F.explode(F.when(F.length("text") > 0, F.sequence(F.lit(1), F.length("text")))))
    whole = F.concat(F.lit(START * ORDER), F.col("text"))
    kept = [c for c in rows.columns if c != "text"]
    return at.select(*kept, *[F.substring(whole, F.col("i") + (ORDER - k), F.lit(k + 1)).alias(f"g{k}") for k in range(ORDER + 1)])


def train(labelled: DataFrame) -> DataFrame:
    """(gram, ratio): log-likelihood difference of a gram's last character after the others, from (text, good)."""
    places = _places(labelled.select("text", "good"))
    grams = places.select("good", F.explode(F.array(*[f"g{k}" for k in range(ORDER + 1)])).alias("gram"))
    counts = grams.groupBy("gram").agg(
        F.count(F.when(F.col("good"), 1)).cast("double").alias("a"), F.count(F.when(~F.col("good"), 1)).cast("double").alias("b"))
    counts = materialize(counts, "url-grams")
    after = counts.groupBy(F.expr("substring(gram, 1, length(gram) - 1)").alias("context")).agg(F.sum("a").alias("ca"), F.sum("b").alias("cb"))
    model, lower = None, None
    for k in range(ORDER + 1):
        level = counts.where(F.length("gram") == k + 1).withColumn("context", F.substring("gram", 1, k)).join(after, "context")
        if lower is None:
            level = level.withColumns({"la": F.lit(1.0 / SYMBOLS), "lb": F.lit(1.0 / SYMBOLS)})
        else:
            level = level.join(lower.select(F.col("gram").alias("short"), F.col("pa").alias("la"), F.col("pb").alias("lb")),
                               F.expr("substring(gram, 2)") == F.col("short"))
        smooth = lambda n, total, below: (F.col(n) + SMOOTHING * F.col(below)) / (F.col(total) + SMOOTHING)
        lower = level.select("gram", smooth("a", "ca", "la").alias("pa"), smooth("b", "cb", "lb").alias("pb"))
        lower = materialize(lower, f"url-order{k}")
        model = lower if model is None else model.unionByName(lower)
    return model.select("gram", F.log(F.col("pa") / F.col("pb")).alias("ratio"))


def score(rows: DataFrame, model: DataFrame) -> DataFrame:
    """``rows`` (any columns, with ``text``) plus ``score``, the mean ratio per character; ``row`` tells equal rows apart."""
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    keys = rows.columns
    places = _places(rows.withColumn("kept", F.col("text"))).withColumnRenamed("kept", "text")
    for k in range(ORDER, -1, -1):
        side = F.broadcast(model.select(F.col("gram").alias(f"g{k}"), F.col("ratio").alias(f"r{k}")))
        places = places.join(side, f"g{k}", "left")
    ratio = F.coalesce(*[f"r{k}" for k in range(ORDER, -1, -1)], F.lit(0.0))
    scored = places.groupBy(*keys).agg((F.sum(ratio) / F.count(F.lit(1))).alias("score"))
    silent = rows.where(F.length("text") == 0).withColumn("score", F.lit(0.0))
    return scored.unionByName(silent)


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id", url_col: str = "url",
               keep_share: float = KEEP_SHARE) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): the rule's verdict, else the models'."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "text": folded(F.col("url"))})
    rows = rows.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    labelled = rows.where(F.col("best").isNotNull()).select("text", (F.col("best.verdict") == ALLOW).alias("good"),
                                                            (F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0).alias("held"))
    out = ["page_id", "host", "path", F.col("best.rule").alias("rule"),
           F.coalesce(F.col("best.verdict"), F.when(F.col("score") < F.col("least"), BLOCK).otherwise(ALLOW)).alias("verdict"), "score"]
    training = labelled.where(~F.col("held"))
    seen = training.agg(F.max("good").alias("any"), F.min("good").alias("all")).first()
    if seen["any"] is None or seen["any"] == seen["all"]:  # a class without a URL
        return rows.withColumns({"score": F.lit(0.0), "least": F.lit(0.0)}).select(*out)
    model = materialize(train(training), "url-model")
    least = score(labelled.where("held AND good"), model).agg(F.percentile_approx("score", 1.0 - keep_share, 10_000).alias("least")).first()["least"]
    return score(rows.drop("url"), model).withColumn("least", F.lit(0.0 if least is None else float(least))).select(*out)
