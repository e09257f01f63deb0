"""A stored table that takes the keyed changes of a stream."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.mutate import last_change
from ..session import delete_folder, path_exists, read_text, write_text
from .tables import gathered

BUCKET, BASE, DELTA = "bucket", "base", "delta"


class BatchFolders:
    """A table kept as one folder per batch, the last two of them.

    A batch reads the folder of the batch before it, which a repeated batch finds
    unchanged. Asking for any other batch is an error, not another batch's rows.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def folder(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id}"

    def read(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder(batch_id))

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(self.folder(batch_id))
        if batch_id > 1:
            delete_folder(self.spark, self.folder(batch_id - 2))


class KeyedTable:
    """A ``foreachBatch`` sink: rows are merged by ``key``, the last by ``order`` within a batch, and new keys are added.

    Keys are dealt to buckets by a hash. A bucket is a base and the deltas of later batches: a batch writes its own changes, once, into the
    buckets they fall into, and reading merges a bucket's folders, field by field, the last one that is not NULL. A bucket whose deltas
    have outgrown its base, or are more than ``max_deltas``, is merged into a new base by the batch that finds it so; no other bucket is read
    or written. Which folders make up the table after a batch stands in the manifest of that batch, a small file that is written last: a
    repeated batch starts from the manifest before it, which it finds unchanged, and replaces its own folders. Folders that neither of
    the last two manifests names are removed.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, order: str | None = None, buckets: int = 16, max_deltas: int = 8):
        self.spark, self.path, self.key, self.order, self.buckets, self.max_deltas = spark, path, key, order, buckets, max_deltas
        self.fields = spark.createDataFrame([], schema).schema
        self.columns = self.fields.names

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        table = self._manifest(batch_id - 1) if batch_id > 0 else {}
        latest = last_change(batch, self.key, self.order)
        kinds = {f.name: f.dataType for f in self.fields}
        known = (F.col(c) if c in latest.columns else F.lit(None) for c in self.columns)
        rows = latest.select(*(c.cast(kinds[n]).alias(n) for c, n in zip(known, self.columns)))
        for bucket, count in self._write(rows, batch_id, DELTA).items():
            table.setdefault(bucket, []).append([batch_id, DELTA, count])
        full = {b: folders for b, folders in table.items() if self._is_full(folders)}
        if full:
            for bucket, count in self._write(self._merged(full), batch_id, BASE).items():
                table[bucket] = [[batch_id, BASE, count]]
        write_text(self.spark, self._manifest_path(batch_id), json.dumps(table))
        for bucket in full:
            delete_folder(self.spark, self._folder(batch_id, DELTA, bucket))
        if batch_id > 1:
            self._clear(batch_id)

    def _is_full(self, folders: list) -> bool:
        (_, _, base), deltas = folders[0], folders[1:]
        return len(deltas) > self.max_deltas or sum(rows for _, _, rows in deltas) > base

    def _write(self, rows: DataFrame, batch_id: int, kind: str) -> dict[str, int]:
        """Write rows by bucket, replacing an earlier attempt; gives the rows of each bucket written."""
        path = f"{self.path}/data/batch={batch_id}/kind={kind}"
        gathered(rows.withColumn(BUCKET, self._bucket()), [BUCKET]).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        written = self.spark.read.schema(f"`{self.key}` {self.fields[self.key].dataType.simpleString()}, {BUCKET} int").parquet(path)
        return {str(row[BUCKET]): row["count"] for row in written.groupBy(BUCKET).count().collect()}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast(self.fields[self.key].dataType)), F.lit(self.buckets)).cast("int")

    def _folder(self, batch_id: int, kind: str, bucket: str) -> str:
        return f"{self.path}/data/batch={batch_id}/kind={kind}/{BUCKET}={bucket}"

    def _merged(self, table: dict[str, list]) -> DataFrame:
        """The rows of some buckets. One with a single folder is read as it is, its keys are unique."""
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in self.fields), "batch long"])

        def read(chosen: dict[str, list]) -> DataFrame:
            paths = [self._folder(b, kind, bucket) for bucket, folders in chosen.items() for b, kind, _ in folders]
            if not paths:
                return self.spark.createDataFrame([], schema)
            return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths)

        plain = {b: folders for b, folders in table.items() if len(folders) == 1}
        mixed = {b: folders for b, folders in table.items() if len(folders) > 1}
        last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("batch"))).alias(c) for c in self.columns if c != self.key]
        merged = read(mixed).groupBy(self.key).agg(*last).select(*self.columns) if mixed else None
        rows = read(plain).select(*self.columns)
        return rows if merged is None else merged if not plain else rows.unionAll(merged)

    def _manifest_path(self, batch_id: int) -> str:
        return f"{self.path}/manifest/{batch_id}.json"

    def _manifest(self, batch_id: int) -> dict[str, list]:
        return json.loads(read_text(self.spark, self._manifest_path(batch_id)))

    def _clear(self, batch_id: int) -> None:
        if not path_exists(self.spark, self._manifest_path(batch_id - 2)):
            return
        named = lambda at: {self._folder(b, kind, bucket) for bucket, folders in self._manifest(at).items() for b, kind, _ in folders}
        for path in named(batch_id - 2) - named(batch_id - 1) - named(batch_id):
            delete_folder(self.spark, path)
        delete_folder(self.spark, self._manifest_path(batch_id - 2))

    def result(self, batch_id: int) -> DataFrame:
        """The stored rows after a batch."""
        return self._merged(self._manifest(batch_id))

    def get(self, batch_id: int, keys: Sequence) -> DataFrame:
        """The stored rows of the given keys; no other bucket than theirs is opened."""
        wanted = self.spark.createDataFrame([(k,) for k in keys], f"`{self.key}` {self.fields[self.key].dataType.simpleString()}")
        buckets = {str(row[0]) for row in wanted.select(self._bucket()).distinct().collect()}
        own = {b: folders for b, folders in self._manifest(batch_id).items() if b in buckets}
        return self._merged(own).where(F.col(self.key).isin(list(keys)))
