"""Registered queries, each with its reference SQL where SQL can say it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the equivalent DuckDB statement."""
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return register


from . import cleaning, describing, testing, modelling, pricing, segmenting, purchasing  # noqa: E402,F401
