"""SQL over named tables and streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def name_views(views: Mapping[str, DataFrame]) -> None:
    """Make tables and streams known to SQL by name, for the session they belong to; a name that is taken is given anew."""
    for name, rows in views.items():
        rows.createOrReplaceTempView(name)


def query(spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The result of a SQL text over views, which are named first. Over a stream it is a stream."""
    name_views(views or {})
    return spark.sql(sql)


def drop_views(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.catalog.dropTempView(name)
