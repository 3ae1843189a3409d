"""Query registration. The SQL twin of a query runs on the same tables in another engine."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from duskwatch.plans.views import VIEWS
from duskwatch.session import prepare
from duskwatch.sources.telemetry import Telemetry

QUERIES: dict[str, Callable[[Telemetry], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[Telemetry], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def with_views(sql: str) -> str:
    """Put the views a statement needs in front of it."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in VIEWS:
            if name in words and name not in needed:
                needed.add(name)
                todo.append(VIEWS[name])
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in needed) + "\n" + sql


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepare(spark)
        return QUERIES[name](Telemetry(spark, folder))

    run.__name__ = name
    return run
