"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import isolated
from ..sources.entities import Entities
from .views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}
# Complete lists that belong to columns of the queries above; the number of those is fixed by a test.
LISTS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LIST_CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None, queries: dict = QUERIES, checks: dict = CHECKS):
    """Register `fn(entities) -> DataFrame` under a name, with its checking SQL."""

    def register(fn: Callable[[Entities], DataFrame]) -> Callable[[Entities], DataFrame]:
        if name in QUERIES or name in LISTS:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Entities(isolated(spark), folder, sized=True))

        run.__doc__ = fn.__doc__
        queries[name] = run
        if sql is not None:
            checks[name] = with_views(sql)
        return fn

    return register
