"""Global numbering (W1), batch ranges (D4), prompt building (D3).

W1 at scale: ``row_number() over (order by key)`` moves every row into one task, and
range repartitioning is not reproducible (Spark re-samples imbalanced inputs with a seed
taken from the RDD id, so two evaluations of one plan can cut at different bounds).
Instead: quantile bounds of the key are computed once (n-1 values; n grows with the row
count so a bucket holds about 2M rows) and a row's bucket is found by binary search over
them, a pure function of its key.  Per-bucket counts (one row per bucket) give running offsets that
are broadcast back; inside a bucket ``row_number`` orders by the key.  Any recomputation,
e.g. after an executor is lost, yields the same numbers, if the key is unique; else write the numbered rows once
before using them twice.  Numbers, dates and timestamps are cut by quantiles; any other orderable key (texts) by the
splitters of ``ranking``.  Null keys come first (last in descending order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardsmith.functions.util import ordered_concat
from boardsmith.operators.ranking import with_rank

TARGET_ROWS_PER_BUCKET = 2_000_000
QUANTILE_ACCURACY = 10_000


TREE_MAX_BOUNDS = 512  # a compiled comparison tree is fastest, but stops compiling near 2,000 leaves


def _bucket_tree(key: Column, bounds: list, lo: int, hi: int) -> Column:
    """Bucket index in [lo, hi] = number of bounds strictly below ``key`` (balanced comparison tree)."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(key <= F.lit(bounds[mid]), _bucket_tree(key, bounds, lo, mid)).otherwise(_bucket_tree(key, bounds, mid + 1, hi))


def _bucket_search(key: Column, bounds: list) -> Column:
    """Number of ``bounds`` (sorted) strictly below ``key``, by binary search: an ``aggregate``
    fold of ceil(log2(m+1)) halving steps over one array literal, so the expression size does
    not grow with the number of buckets (a comparison tree stops compiling near 2,000 leaves)."""
    m = len(bounds)
    arr = F.lit(bounds)
    steps = max(1, m.bit_length())

    def step(acc, _):
        lo, hi = acc["lo"], acc["hi"]
        mid = F.floor((lo + hi + 1) / 2).cast("int")
        below = F.element_at(arr, F.greatest(mid, F.lit(1))) < key
        return F.when(lo < hi, F.struct(
            F.when(below, mid).otherwise(lo).alias("lo"),
            F.when(below, hi).otherwise(mid - 1).alias("hi"),
        )).otherwise(acc)

    init = F.struct(F.lit(0).alias("lo"), F.lit(m).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step)["lo"]


def _quantile_bounds(df: DataFrame, key: Column, n: int, with_count: bool = False):
    qs = [i / n for i in range(1, n)]
    aggs = [F.percentile_approx(key, qs, max(QUANTILE_ACCURACY, 4 * n)).alias("q")]
    if with_count:
        aggs.append(F.count(F.lit(1)).alias("rows"))
    row = df.select(*aggs).first()
    bounds = sorted({b for b in (row["q"] or []) if b is not None})
    return bounds, (row["rows"] if with_count else None)


def _bucket_expr(key: Column, bounds: list) -> Column:
    """Bucket of ``key``; null keys have bucket -1 of their own, before all others, as they sort first."""
    if not bounds:
        bucket = F.lit(0)
    elif len(bounds) <= TREE_MAX_BOUNDS:
        bucket = _bucket_tree(key, bounds, 0, len(bounds))
    else:
        bucket = _bucket_search(key, bounds)
    return F.when(key.isNull(), F.lit(-1)).otherwise(bucket)


def _as_number(df: DataFrame, key: str) -> Column:
    """A number in the order of ``key``: quantiles need numbers, and one bucket for all rows would be one task."""
    kind = df.schema[key].dataType
    if isinstance(kind, T.NumericType):
        return F.col(key)
    if isinstance(kind, T.DateType):
        return F.unix_date(key)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key)
    raise TypeError(f"quantiles need a numeric, date or timestamp key; {key} is {kind.simpleString()}")


def key_buckets(df: DataFrame, key: str, n: int | None = None) -> Column:
    """Order-preserving bucket of ``key`` from approximate quantiles, computed once.

    With ``n`` unset: one aggregation returns the row count and the bounds for the shuffle
    partition count; only when buckets would then exceed ``TARGET_ROWS_PER_BUCKET`` rows is a
    second pass run with more bounds (n = rows / target).
    """
    number = _as_number(df, key)
    if n is not None:
        return F.lit(0) if n <= 1 else _bucket_expr(number, _quantile_bounds(df, number, n)[0])
    base = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds, rows = _quantile_bounds(df, number, max(base, 2), with_count=True)
    wanted = -(-(rows or 0) // TARGET_ROWS_PER_BUCKET)
    if wanted > base:
        bounds, _ = _quantile_bounds(df, number, wanted)
    return _bucket_expr(number, bounds)


def with_row_index(df: DataFrame, order_col: str, out: str = "row_idx", num_buckets: int | None = None, descending: bool = False) -> DataFrame:
    """Add a dense 0-based position in ``order_col`` order, without a one-partition window.

    Ascending order starts with null keys; ``descending`` (newest first) is its reverse and ends with them.
    """
    if not isinstance(df.schema[order_col].dataType, (T.NumericType, T.DateType, T.TimestampType)):
        return with_rank(df, [(order_col, descending)], out, buckets=num_buckets)
    b = df.withColumn("_bucket", key_buckets(df, order_col, num_buckets))
    counts = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy(F.desc("_bucket") if descending else F.asc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_bucket").orderBy(F.desc(order_col) if descending else F.asc(order_col))
    return (
        b.join(F.broadcast(offsets), "_bucket")
        .withColumn(out, (F.col("_off") + F.row_number().over(inside) - 1).cast("bigint"))
        .drop("_bucket", "_off")
    )


def with_batches(df: DataFrame, order_col: str, size: int, row_col: str = "row_idx", batch_col: str = "batch_id", descending: bool = False) -> DataFrame:
    """Global position plus ``batch_id = position div size``."""
    numbered = with_row_index(df, order_col, row_col, descending=descending)
    return numbered.withColumn(batch_col, F.floor(F.col(row_col) / F.lit(size)).cast("bigint"))


def batch_ranges(numbered: DataFrame, row_col: str = "row_idx", batch_col: str = "batch_id") -> DataFrame:
    """Per batch the 1-based first/last row and the row count (``rows a to b``)."""
    return numbered.groupBy(batch_col).agg(
        (F.min(row_col) + 1).cast("bigint").alias("first_row"),
        (F.max(row_col) + 1).cast("bigint").alias("last_row"),
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
    )


# The prompt line layout and how a missing value prints in it.
PROMPT_LINE = "%d. Title: %s, Contents: %s, Comments: %s\n"
PROMPT_LINE_NO_COMMENTS = "%d. Title: %s, Contents: %s\n"
MISSING_TEXT = "nan"


def _shown(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(MISSING_TEXT))


def prompt_line(row_col: str = "row_idx", title: str = "title", contents: str = "contents", comments: str | None = "comments") -> Column:
    """One prompt line, numbered by the 1-based global position."""
    if comments is None:
        return F.format_string(PROMPT_LINE_NO_COMMENTS, F.col(row_col) + 1, _shown(title), _shown(contents))
    return F.format_string(PROMPT_LINE, F.col(row_col) + 1, _shown(title), _shown(contents), _shown(comments))


def build_prompts(numbered: DataFrame, row_col: str = "row_idx", batch_col: str = "batch_id", **line_cols) -> DataFrame:
    """D3: one prompt per batch, lines concatenated in row order (groups are ``size`` rows)."""
    return (
        numbered.withColumn("_line", prompt_line(row_col, **line_cols))
        .groupBy(batch_col)
        .agg(ordered_concat("_line", row_col).alias("prompt"))
    )
