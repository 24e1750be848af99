"""Named queries over the driver's tables, each with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the library operator on a
fresh bundle over the folder as it is at that moment; ``ORACLE[name]`` is the
same question as plain SQL over the raw tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierwise.sources.model import Tables, from_tpch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(from_tpch(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        QUERIES[name].__name__ = name
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# importing the definition modules fills the registry
from tierwise.plans import queries_core, queries_extra  # noqa: E402,F401
