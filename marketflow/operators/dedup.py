"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The keys of a refined shop row.
SHOP_KEYS = ("wm_poi_id", "dp_shop_id")


def one_per_key(df: DataFrame, keys: Sequence[str] = SHOP_KEYS, pick: str = "min") -> DataFrame:
    """One row per key, every other column reduced on its own.

    ``min`` takes the first element of the sorted set of values without building
    the set; ``any`` takes some value that is not NULL.
    """
    chosen = {"min": F.min, "any": lambda c: F.any_value(c, F.lit(True))}[pick]
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*(chosen(F.col(c)).alias(c) for c in others)).select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str] = SHOP_KEYS, order: str = "create_time") -> DataFrame:
    """The whole row with the greatest ``order`` per key; equal ones by their other columns."""
    others = [c for c in df.columns if c not in keys and c != order]
    top = F.max(F.struct(order, *others)).alias("top")
    return df.groupBy(*keys).agg(top).select(*keys, "top.*").select(*df.columns)
