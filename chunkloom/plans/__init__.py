"""Registered queries, each with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRIES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def widened(df: DataFrame) -> DataFrame:
    """Integers as bigint and floats as double, as the SQL side has them."""
    kinds = {"int": "bigint", "smallint": "bigint", "tinyint": "bigint", "float": "double"}
    return df.select(*(F.col(c).cast(kinds[t]).alias(c) if t in kinds else F.col(c) for c, t in df.dtypes))


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) under its name, with its SQL."""

    def register(f):
        ENTRIES[f.__name__] = (lambda spark, sf_dir: widened(f(spark, sf_dir)), sql)
        return f

    return register


def load() -> dict:
    from . import chunking, indexing, layouts, relations, retrievals, stores, streams, texts  # noqa: F401

    return ENTRIES
