"""Registry of named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import Data, sql_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = (), once: bool = False):
    """Register a function of `Data`; `sql` is its counterpart over the named views, each worked out `once` if so asked."""

    def register(fn: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Data(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        if sql is not None:
            ORACLES[name] = sql_text(sql, *views, once=once)
        return fn

    return register
