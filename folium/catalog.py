"""All registered queries on the given tables, with DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folium.plans import checks, contents_search, readside, structure

_MODULES = (structure, readside, contents_search, checks)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for m in _MODULES for f in m.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
