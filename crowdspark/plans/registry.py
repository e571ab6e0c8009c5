"""The registered queries: name -> Spark callable, and name -> SQL for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crowdspark.plans.sql_views import with_views
from crowdspark.plans.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(views: str = "", sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables``; ``sql`` may use the named views (``views``, space-separated)."""
    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[key] = with_views(views.split(), sql)
        return build
    return register
