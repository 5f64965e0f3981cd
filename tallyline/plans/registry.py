"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyline.plans import clicks, loads, merch, orders, streams

AREAS = [orders, clicks, merch, loads, streams]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for area in AREAS for name, query in area.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for area in AREAS for name, sql in area.SQL.items()}
