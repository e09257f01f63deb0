"""Sorted cells in files, and a manifest of the range that each file holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import require_text
from ..operators.cells import SHOP_LINE_POSITIONS, sort_cells, split_fields, to_cells
from ..sources.files import read_lines

CELLS = "rowkey string, family string, qualifier string, value string"
PLACE = ("rowkey", "family", "qualifier")
_PLACE_TYPE = "struct<rowkey:string,family:string,qualifier:string>"
RANGES = f"file string, first {_PLACE_TYPE}, last {_PLACE_TYPE}, cells long, load long"


class CellStore:
    """Cells below ``path``, kept by loads: each load's files cover disjoint ranges of cells in store order.

    A load writes its cells once, ranged over files and sorted in each, and then a row per file with its first and last cell and their
    number. A scan of row keys asks the manifest and opens the files whose range meets its own; within a file the sorted row keys
    let row groups be skipped. A repeated load replaces itself. A row key with most of the cells lies in many files.
    Only names of files pass through the driver, as Spark needs them to open any.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def load(self, cells: DataFrame, load: int = 0, files: int | None = None) -> None:
        """Write cells (rowkey, family, qualifier, value) as one load, into about so many files."""
        data = f"{self.path}/data/load={load}"
        sort_cells(cells.select("rowkey", "family", "qualifier", "value"), files).write.mode("overwrite").parquet(data)
        place = F.struct(*PLACE)
        found = self.spark.read.schema(CELLS).parquet(data).select(F.col("_metadata.file_path").alias("file"), place.alias("place"))
        ranges = found.groupBy("file").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.count(F.lit(1)).alias("cells"))
        ranges.coalesce(1).sortWithinPartitions("first").write.mode("overwrite").parquet(f"{self.path}/ranges/load={load}")

    def ranges(self) -> DataFrame:
        """A row per file of every load: its first and last cell, and its number of cells."""
        return self.spark.read.schema(RANGES).parquet(f"{self.path}/ranges")

    def files(self, start: str | None = None, stop: str | None = None) -> list[str]:
        """Files with a row key from ``start`` on and before ``stop``."""
        return self._named(self._within(F.col("last.rowkey"), start, None) & self._within(F.col("first.rowkey"), None, stop))

    def cells(self) -> DataFrame:
        """All cells, with the load that brought each."""
        return self._open(self.files())

    def scan(self, start: str | None = None, stop: str | None = None) -> DataFrame:
        """Cells whose row key is ``start`` or after it, and before ``stop``."""
        return self._open(self.files(start, stop)).where(self._within(F.col("rowkey"), start, stop))

    def get(self, rowkeys: Sequence[str]) -> DataFrame:
        """Cells of the given row keys."""
        keys = F.array(*map(F.lit, rowkeys)) if rowkeys else F.array().cast("array<string>")
        meets = F.exists(keys, lambda k: (k >= F.col("first.rowkey")) & (k <= F.col("last.rowkey")))
        return self._open(self._named(meets)).where(F.col("rowkey").isin(list(rowkeys)))

    def _named(self, wanted: Column) -> list[str]:
        return [row.file for row in self.ranges().where(wanted).select("file").toLocalIterator()]

    def _open(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], f"{CELLS}, load long")
        return self.spark.read.schema(f"{CELLS}, load long").option("basePath", f"{self.path}/data").parquet(*files)

    @staticmethod
    def _within(rowkey: Column, start: str | None, stop: str | None) -> Column:
        return (F.lit(True) if start is None else rowkey >= start) & (F.lit(True) if stop is None else rowkey < stop)


def newest(cells: DataFrame) -> DataFrame:
    """One value per cell: of the latest load, there the greatest."""
    last = F.max(F.struct("load", "value"))["value"].alias("value")
    return cells.groupBy(*PLACE).agg(last)


def bulk_load(spark: SparkSession, source: str, target: str, table: str, positions: dict[str, int] | None = None, load: int = 0,
              files: int | None = None) -> tuple[CellStore, DataFrame]:
    """Load delimited lines below ``source`` into the store of a table below ``target``.

    Gives the store and the lines that are too short. None of the names may be blank. The first of the positions is the row key's.
    """
    require_text(source=source, target=target, table=table)
    positions = SHOP_LINE_POSITIONS if positions is None else positions
    good, short = split_fields(read_lines(spark, source), positions)
    store = CellStore(spark, f"{target}/{table}")
    store.load(to_cells(good, rowkey=next(iter(positions)), columns=list(positions)), load, files)
    return store, short
