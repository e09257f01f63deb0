"""Wide rows to sorted key-value cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column family and stored columns of a shop.
FAMILY = "info"
SHOP_CELLS = ("wm_poi_id", "shop_name", "shop_status", "shop_pic")
SHOP_LINE_POSITIONS = {"wm_poi_id": 0, "shop_name": 2, "shop_status": 3, "shop_pic": 4}


def to_cells(df: DataFrame, rowkey: str = "wm_poi_id", columns: Sequence[str] = SHOP_CELLS, family: str = FAMILY) -> DataFrame:
    """``(rowkey, family, qualifier, value)`` for every column; no cell for a NULL key or value."""
    texts = df.where(F.col(rowkey).isNotNull()).select(
        F.col(rowkey).cast("string").alias("rowkey"), *(F.col(c).cast("string").alias(c) for c in columns)
    )
    cells = texts.unpivot(["rowkey"], list(columns), "qualifier", "value")
    return cells.where(F.col("value").isNotNull()).select("rowkey", F.lit(family).alias("family"), "qualifier", "value")


def sort_cells(cells: DataFrame, partitions: int | None = None) -> DataFrame:
    """Cells in store order over the partitions.

    The ranges are cut on the whole cell, so one row key with most of the cells
    is spread over many partitions.
    """
    order = ["rowkey", "family", "qualifier", "value"]
    spread = cells.repartitionByRange(partitions, *order) if partitions else cells.repartitionByRange(*order)
    return spread.sortWithinPartitions(*order)


def as_bytes(cells: DataFrame) -> DataFrame:
    """All four parts as UTF-8 bytes."""
    return cells.select(*(F.encode(F.col(c), "UTF-8").alias(c) for c in ("rowkey", "family", "qualifier", "value")))


def split_fields(lines: DataFrame, positions: dict[str, int], separator: str = "\t") -> tuple[DataFrame, DataFrame]:
    """Named fields of delimited lines, and the lines that are too short.

    Empty fields at the end of a line do not count.
    """
    fields = F.split(F.rtrim(F.col("value"), F.lit(separator)), separator)
    needed = max(positions.values()) + 1
    long_enough = F.coalesce(F.size(fields) >= needed, F.lit(False))
    good = lines.where(long_enough).select(
        *(F.get(fields, F.lit(at)).alias(name) for name, at in positions.items())
    )
    return good, lines.where(~long_enough)
