"""All registered queries over the given tables, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catchment.plans import queries_grids, queries_parts, queries_quality, queries_scalar, queries_space, queries_tables, queries_time

Query = Callable[[SparkSession, str], DataFrame]
GROUPS = (queries_scalar, queries_time, queries_space, queries_quality, queries_tables, queries_grids, queries_parts)


def queries() -> dict[str, Query]:
    return {k: q for g in GROUPS for k, (q, _) in g.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql.replace(", 4)", " + 3e-7, 4)") for g in GROUPS for k, (_, sql) in g.QUERIES.items() if sql}
