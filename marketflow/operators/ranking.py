"""Top rows, per group and overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, n: int, group: Sequence[str], order: Sequence[Column], rank: str = "row_num") -> DataFrame:
    """The first ``n`` rows of each group, numbered.

    The bound on the rank lets Spark keep at most ``n`` rows per group and task
    before the shuffle, so a group with most of the rows costs no more than others.
    """
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return numbered.where(F.col(rank) <= n)


def top_rows(df: DataFrame, n: int, order: Sequence[Column], start: int = 0) -> DataFrame:
    """Rows ``start`` to ``start + n`` of the ordered table."""
    ordered = df.orderBy(*order)
    return (ordered.offset(start) if start else ordered).limit(n)
