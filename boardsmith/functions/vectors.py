"""Vector expressions on ``array<float|double>`` columns (higher-order functions, which Spark interprets: for many pairs use ``operators.search``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boardsmith.functions.util import as_col


def dot(a, b) -> Column:
    """Sum of element products, in double precision; arrays of unequal length pair up to the shorter."""
    prods = F.zip_with(as_col(a), as_col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(F.filter(prods, lambda p: p.isNotNull()), F.lit(0.0).cast("double"), lambda acc, p: acc + p)


def norm(a) -> Column:
    """Euclidean norm in double precision."""
    sq = F.transform(as_col(a), lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(sq, F.lit(0.0).cast("double"), lambda acc, p: acc + p))


def cosine(a, b) -> Column:
    """H9: dot / (|a| |b|); a zero or null vector gives null (never NaN), so ranking stays total."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))
