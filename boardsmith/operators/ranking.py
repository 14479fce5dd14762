"""Global ranks over any orderable tuple of columns (texts, numbers, dates; each ascending or descending).

A window without a partition moves every row into one task, and one task for each distinct value of the first column
is no better where most rows share it (half of a vocabulary occurs once).  Here the whole tuple is cut: splitters are
taken from a sample of the tuples, collected once (``buckets - 1`` tuples) and put into the plan as values, so the
bucket of a row is a pure function of the row and a recomputed task numbers its rows as before.  A value with more
rows than a bucket's share is cut by the columns after it.  Counts for each bucket (one row each) give offsets that are
broadcast; ``row_number`` runs inside the buckets.

Nulls come first in ascending order and last in descending order.  Rows that agree in the whole tuple stay in one
bucket and get consecutive ranks in an order that is not fixed: end the tuple with a tie-break.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TARGET_ROWS = 2_000_000  # rows of a bucket, at most as many as one task sorts in memory
PER_BUCKET = 64  # sampled tuples for each bucket: a bucket's share is then within a factor of two of the mean
TREE_LEAVES = 64  # more splitters than this are searched by a fold, whose expression doesn't grow with them

Order = Sequence["str | tuple[str, bool]"]


def _pairs(order: Order) -> list[tuple[str, bool]]:
    """(column, descending) for each entry; a bare name is ascending."""
    return [(o, False) if isinstance(o, str) else (o[0], bool(o[1])) for o in order]


def sort_keys(order: Order) -> list[Column]:
    """The order as sort expressions."""
    return [F.desc_nulls_last(F.col(f"`{c}`")) if down else F.asc_nulls_first(F.col(f"`{c}`")) for c, down in _pairs(order)]


def _below(order: list[tuple[str, bool]], splitter: list[tuple[Column, Column]]) -> Column:
    """Whether the splitter, (value, is null) for each column, comes strictly before the row."""
    out = F.lit(False)
    for (name, down), (value, missing) in reversed(list(zip(order, splitter, strict=True))):
        own = F.col(f"`{name}`")
        first, second = (own, value) if down else (value, own)
        no_first, no_second = (own.isNull(), missing) if down else (missing, own.isNull())
        before = F.when(no_first | no_second, no_first & ~no_second).otherwise(first < second)
        same = F.when(no_first | no_second, no_first & no_second).otherwise(first == second)
        out = before | (same & out)
    return out


def _tree(order, kinds, splitters: list, lo: int, hi: int) -> Column:
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    at = [(F.lit(v).cast(k), F.lit(v is None)) for v, k in zip(splitters[mid], kinds, strict=True)]
    return F.when(_below(order, at), _tree(order, kinds, splitters, mid + 1, hi)).otherwise(_tree(order, kinds, splitters, lo, mid))


def _fold(order, kinds, splitters: list) -> Column:
    """Binary search by a fold over as many halving steps as the splitters need."""
    columns = list(zip(*splitters, strict=True))
    values = [F.array(*[F.lit(v).cast(k) for v in c]) for c, k in zip(columns, kinds, strict=True)]
    missing = [F.array(*[F.lit(v is None) for v in c]) for c in columns]

    def step(acc, _):
        lo, hi = acc["lo"], acc["hi"]
        mid = F.shiftright(lo + hi, 1)
        at = [(F.get(v, mid), F.get(m, mid)) for v, m in zip(values, missing, strict=True)]
        below = _below(order, at)
        return F.when(lo < hi, F.struct(F.when(below, mid + 1).otherwise(lo).alias("lo"), F.when(below, hi).otherwise(mid).alias("hi"))).otherwise(acc)

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(splitters)).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, len(splitters).bit_length()))), start, step)["lo"]


def splitters(df: DataFrame, order: Order, buckets: int, rows: int, seed: int = 17) -> list[tuple]:
    """At most ``buckets - 1`` distinct tuples that cut the rows into about equal parts, in order."""
    wanted = buckets * PER_BUCKET
    names = [c for c, _ in _pairs(order)]
    some = df.select(*[F.col(f"`{c}`") for c in names])
    if rows > wanted:
        some = some.sample(min(1.0, 1.2 * wanted / rows), seed)
    sampled = [tuple(r) for r in some.orderBy(*sort_keys(order)).collect()]  # about ``wanted`` tuples, by the parameters alone
    cuts = [sampled[len(sampled) * i // buckets] for i in range(1, buckets)] if sampled else []
    return list(dict.fromkeys(cuts))


def bucket_of(df: DataFrame, order: Order, cuts: list[tuple]) -> Column:
    """How many of ``cuts`` come strictly before the row."""
    pairs = _pairs(order)
    kinds = [df.schema[c].dataType for c, _ in pairs]
    if len(cuts) <= TREE_LEAVES:
        return _tree(pairs, kinds, cuts, 0, len(cuts))
    return _fold(pairs, kinds, cuts)


def with_rank(df: DataFrame, order: Order, out: str = "rank", start: int = 0, buckets: int | None = None, rows: int | None = None) -> DataFrame:
    """``df`` and a dense position ``out`` (bigint, from ``start``) in the given order.

    ``df`` is read three times (count and sample, counts for each bucket, ranks): hand over a written table.
    """
    if rows is None:
        rows = df.count()
    if buckets is None:
        buckets = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TARGET_ROWS))
    cuts = splitters(df, order, buckets, rows) if buckets > 1 and rows else []
    bucketed = df.withColumn("_bucket", bucket_of(df, order, cuts))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # over one row for each bucket
    offsets = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows")).select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_bucket").orderBy(*sort_keys(order))
    ranked = bucketed.join(F.broadcast(offsets), "_bucket")
    return ranked.withColumn(out, (F.col("_off") + F.row_number().over(inside) - 1 + start).cast("bigint")).drop("_bucket", "_off")
