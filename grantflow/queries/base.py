"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function under its own name together with its check."""
    def add(fn):
        REGISTRY[fn.__name__] = Query(fn, sql)
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def joined(arr: Column) -> Column:
    """Array of text as one sorted text."""
    return F.array_join(F.array_sort(arr), ",")
