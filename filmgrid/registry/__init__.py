"""Named queries over the test tables, each with the SQL that must give the same rows.

The test tables are a sales star schema, an event log and texts. ``views`` dresses them up as film tables, once as
DataFrames and once as SQL, so that the operators run over whole tables and can be checked against another engine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def all_queries() -> dict[str, Query]:
    from filmgrid.registry import cleaning, columns, dashboard, files, loads, lookups, prediction

    found: dict[str, Query] = {}
    for module in (dashboard, lookups, columns, cleaning, loads, files, prediction):
        for name, query in module.QUERIES.items():
            if name in found:
                raise ValueError(f"two queries named {name}")
            found[name] = query
    return found
