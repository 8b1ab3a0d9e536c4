"""Registered queries: one Spark callable and (where SQL can say it) one
DuckDB SQL text per key.

Each Spark callable takes ``(spark, sf_dir)``, derives the model tables from
the test data (``sources.bindings``) and runs one operator of the library over
the whole tables.  The SQL twin computes the same result independently, in
the plain filter / group / join style of the modelled scripts, on the same
parquet tables.  Column names match on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _load_all() -> None:
    # importing the modules registers their queries
    from servelens.plans import report_queries, constraint_queries, scenario_queries, operator_queries, storage_queries, model_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
