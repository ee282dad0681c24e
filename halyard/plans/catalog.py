"""All driver queries of the library, gathered from the plan modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from halyard.plans import documents, environment, landing

#: Plan modules; each has QUERIES and ORACLE_SQL.
MODULES: tuple = (environment, landing, documents)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
