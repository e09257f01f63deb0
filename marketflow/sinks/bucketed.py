"""Documents stored in buckets of their key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mutate
from .tables import drop_table


class DocumentTable:
    """A catalog table whose rows lie in ``buckets`` files by a hash of the key, sorted in each.

    Gets, puts and deletes by key that are too large to broadcast bring their own rows to the buckets; the stored rows are joined where
    they lie, without a shuffle or a sort. Single keys open the one bucket that can hold them. Choose the buckets for the table's final
    size, about a few hundred megabytes each; both sides of a join have as many tasks.
    """

    def __init__(self, spark: SparkSession, name: str, key: str, buckets: int = 16):
        self.spark, self.name, self.key, self.buckets = spark, name, key, buckets

    def write(self, rows: DataFrame, path: str) -> DocumentTable:
        """Store rows with unique keys below a folder of their own; the name then means them."""
        drop_table(self.spark, self.name)
        dealt = rows.repartition(self.buckets, self.key)  # a task for each bucket, so a file for each
        dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self.name)
        return self

    @property
    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def get(self, keys: DataFrame | Sequence) -> DataFrame:
        """Key and document of the listed keys; keys not stored give no row."""
        return mutate.get_many(self.rows, keys, self.key)

    def lookup(self, key) -> DataFrame:
        """The row of one key, out of one bucket."""
        return self.rows.where(F.col(self.key) == F.lit(key))

    def put(self, rows: DataFrame, order: str | None = None) -> DataFrame:
        """Stored rows with whole rows replaced or added by key."""
        return mutate.put(self.rows, rows, self.key, order)

    def delete(self, keys: DataFrame) -> DataFrame:
        """Stored rows whose key is not listed."""
        return mutate.delete(self.rows, keys, self.key)

    def upsert(self, changes: DataFrame, order: str | None = None) -> DataFrame:
        """Stored rows with the fields of their change, and a new row for every other key."""
        return mutate.upsert(self.rows, changes, self.key, order)
