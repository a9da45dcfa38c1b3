"""Registered queries: a Spark callable per operator and, where SQL can say it, the SQL too."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import views
from ..session import compiled

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Newest order date, the clock of all registered queries.
NOW_SQL = "(select max(o_orderdate) from orders)"


class Tables:
    """The given tables and the views on them for one scale folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        compiled(spark)

    def __call__(self, name: str) -> DataFrame:
        return views.table(self.spark, self.sf_dir, name)

    def now(self):
        """One timestamp from the scan's column statistics."""
        return self("orders").agg(F.max("o_orderdate")).first()[0]


def query(name: str, sql: str | None = None, **parts: str):
    """Register a query function taking ``Tables``; ``parts`` are extra named SQL parts."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = views.with_views(sql, **parts)
        return fn

    return wrap
