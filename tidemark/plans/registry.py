"""Name -> query and SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under its own name."""
    def wrap(fn):
        key = name or fn.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Query(key, fn, sql)
        return fn

    return wrap
