"""SQL surface: named views and parameterised queries."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def register_frame(df: DataFrame, name: str) -> None:
    """Make a frame queryable under a name."""
    df.createOrReplaceTempView(name)


def register_parquet(spark: SparkSession, pattern: str, name: str) -> None:
    """Make all Parquet files matching a glob queryable under a name."""
    spark.read.parquet(pattern).createOrReplaceTempView(name)


def query(spark: SparkSession, sql: str, params: Sequence[Any] | None = None) -> DataFrame:
    """Run SQL; ``?`` markers take their values from ``params`` in order."""
    return spark.sql(sql, args=list(params)) if params else spark.sql(sql)
