"""Registered queries: each reads the driver tables at ``sf_dir`` and returns a DataFrame.

Every query has a DuckDB twin (``ORACLES``) unless its result is not expressible in SQL.
Output columns are aliased identically on both sides; arrays are emitted as ``'; '``-joined
strings, similarities rounded to 6 digits, counts cast to BIGINT.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_MODULES = ("search", "scalars", "refine", "keywords", "pages", "rules", "edges", "streams", "hooks")


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(f"boardsmith.plans.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
