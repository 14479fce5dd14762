from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_str(s: str) -> str:
    """A Spark SQL string literal for ``s``."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r").replace("\t", "\\t") + "'"


def ordered_concat(value: str, order_by: str, sep: str = "") -> Column:
    """``listagg(value, sep) WITHIN GROUP (ORDER BY order_by)`` over named columns."""
    return F.expr(f"listagg(`{value}`, {sql_str(sep)}) WITHIN GROUP (ORDER BY {order_by})")


def with_columns_where(df, exprs: dict, predicate):
    """Add computed columns and keep rows where ``predicate(struct)`` holds, computing each
    expression once.  (``withColumn(...).where(...)`` lets the optimizer copy the expression
    into the filter and evaluate it twice; a one-element array through ``inline`` does not.)"""
    s = F.struct(*[e.alias(k) for k, e in exprs.items()])
    return df.select(*[F.col(c) for c in df.columns], F.inline(F.filter(F.array(s), predicate)))


def pieces(batch: pa.RecordBatch, n_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The rows of an Arrow batch in views of about ``n_bytes``, one row at least.  Spark bounds a batch by 64 MB; as Python
    objects its texts and what is made of them take many times that, in each worker."""
    rows = max(1, batch.num_rows * n_bytes // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
