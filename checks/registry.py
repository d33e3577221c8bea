"""Query registry: a Spark query and, where practical, SQL for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the decorated function under its name."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages")


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings")


def r6(c: Column | str, alias: str | None = None) -> Column:
    name = alias or (c if isinstance(c, str) else None)
    out = F.round(F.col(c) if isinstance(c, str) else c, 6)
    return out.alias(name) if name else out


def as_long(*names: str) -> list[Column]:
    return [F.col(n).cast("long").alias(n) for n in names]
