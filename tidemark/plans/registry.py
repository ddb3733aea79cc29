"""Registry of named queries (one per operator / job) and their SQL oracles.

Each query is a function ``(spark, sf_dir) -> DataFrame`` over the driver's
tables; the oracle is an independent ANSI-SQL formulation of the same result
for DuckDB over the same parquet files.  Queries without an oracle are the
non-SQL ones (streaming runs, per-partition operators).
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

_QUERIES: dict[str, Callable] = {}
_ORACLES: dict[str, str] = {}

MODULES = (
    "tidemark.plans.basics",
    "tidemark.plans.traffic",
    "tidemark.plans.marketing",
    "tidemark.plans.detection",
    "tidemark.plans.reconcile",
    "tidemark.plans.sensors",
    "tidemark.plans.udf_queries",
    "tidemark.plans.stream_queries",
    "tidemark.plans.io_queries",
    "tidemark.plans.table_queries",
    "tidemark.plans.null_queries",
)


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql.strip()
        return fn
    return deco


def _load() -> None:
    for m in MODULES:
        importlib.import_module(m)


def queries() -> dict[str, Callable]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
