"""Partitions that become visible once event time has passed them."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import HOUR_PATTERN, partition_time
from ..session import file_system
from .tables import BATCH, create_table, gathered, write_batch

CALL_SIZE = 200
MARK_THREADS = 16
ARRIVAL = "arrival"


class PartitionCommit:
    """A ``foreachBatch`` sink for a table whose partitions are committed by time.

    Rows wait in a folder per batch and partition, where no reader sees them, and are written
    there once. Once the watermark (greatest event time seen, minus the delay of the
    stream) has reached the partition's time plus ``commit_delay``, the files that wait for
    the partition are renamed into its folder in the table, and one partition is added to the
    catalog. The id of the closing batch is the last partition column, so rows that come after
    the commit are a further partition of the batch that brings them.

    The journal of a batch names each (partition, batch) that waits after it. A repeated batch starts
    from the journal before it: files of earlier batches that it has moved already are no longer
    there to move, and files of its own that it has moved are removed from the table before it moves the new ones.
    Where several batches have brought rows, a moved file bears the number of the batch that wrote it.

    Rows whose partition values are no time can never be due: they are written
    to ``rejected``. Only the values of closing partitions pass through the
    driver, as the catalog needs them. What is kept between batches is the journal
    and the greatest event time, not the history.
    """

    def __init__(self, spark: SparkSession, table: str, schema: str, path: str, partitions: Sequence[str] = ("dt", "hr"),
                 pattern: str = HOUR_PATTERN, shift: int = 0, watermark: str = "20 seconds", commit_delay: str = "0 seconds",
                 success_file: bool = True):
        self.spark, self.table, self.path = spark, table, path
        self.partitions, self.pattern, self.shift = list(partitions), pattern, shift
        self.watermark, self.commit_delay, self.success_file = watermark, commit_delay, success_file
        self.names = [*self.partitions, BATCH]
        create_table(spark, table, schema, ", ".join([*(f"{p} string" for p in partitions), f"{BATCH} long"]), path=path)
        self.fields = [f for f in spark.table(table).schema if f.name not in self.names]
        jvm = spark.sparkContext._jvm  # looked up once: every step of a dotted name is a call
        self._escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files, _ = file_system(spark, path)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        columns = [f.name for f in self.fields]
        timely = F.col("_time").isNotNull()
        rows = batch.withColumn("_time", self._time()).select(*columns, *self.partitions, "event_time", "_time").persist()
        before = self._state(batch_id - 1) if batch_id > 0 else None
        try:
            if before is not None:
                emptied = before.where(F.col(ARRIVAL).isNotNull()).groupBy(ARRIVAL).agg(F.bool_and("closed").alias("closed")).where("closed")
                self._each(self._delete, [(self._staging(row[ARRIVAL]),) for row in emptied.toLocalIterator()])
            waiting = rows.where(timely).select(*columns, *self.partitions)
            gathered(waiting, self.partitions).write.mode("overwrite").partitionBy(*self.partitions).parquet(self._staging(batch_id))
            write_batch(rows.where(~timely).select(*columns, *self.partitions), f"{self.path}/_rejected", batch_id)
            known = rows.where(timely).groupBy(*self.partitions).agg(F.max("event_time").alias("seen")).withColumn(ARRIVAL, F.lit(batch_id).cast("long"))
            if before is not None:
                known = known.unionByName(before.where("NOT closed").drop("closed"))
            known = known.persist()
            try:
                self._close(known, batch_id)
            finally:
                known.unpersist()
        finally:
            rows.unpersist()

    def _close(self, known: DataFrame, batch_id: int) -> None:
        named = F.col(self.partitions[0]).isNotNull()
        reached = known.agg((F.max("seen") - F.expr(f"INTERVAL {self.watermark}")).alias("at")).scalar()
        due = named & F.coalesce(self._time() + F.expr(f"INTERVAL {self.commit_delay}") <= reached, F.lit(False))
        ready = [row.asDict() for row in known.where(due).select(*self.partitions, ARRIVAL).toLocalIterator()]
        closing: dict[tuple, list[int]] = {}
        for row in ready:
            closing.setdefault(tuple(row[p] for p in self.partitions), []).append(row[ARRIVAL])
        named_rows = [dict(zip(self.partitions, values)) for values in closing]
        self._each(self._move, [(row, arrivals, batch_id) for row, arrivals in zip(named_rows, closing.values())])
        self._add([{**row, BATCH: batch_id} for row in named_rows])
        newest = known.agg(F.max("seen").alias("seen")).select(*(F.lit(None).cast("string").alias(p) for p in self.partitions), F.lit(None).cast("long").alias(ARRIVAL), "seen")
        state = known.where(named).withColumn("closed", due).select(*self.partitions, ARRIVAL, "seen", "closed").unionAll(newest.withColumn("closed", F.lit(False)))
        state.write.mode("overwrite").parquet(self._slot(batch_id))

    def _move(self, row: dict, arrivals: list[int], batch_id: int) -> None:
        """Rename what waits for a partition into the table: its folder if one batch has brought all, else file by file."""
        files, within = self._files, self._folder(row, self.partitions)
        target = f"{self.path}/{within}/{BATCH}={batch_id}"
        to = self._path(target)
        sources = {k: self._path(f"{self._staging(k)}/{within}") for k in sorted(arrivals)}
        if len(sources) == 1:
            (arrival, source), = sources.items()
            if arrival == batch_id:  # written anew: what an earlier attempt has moved goes
                files.delete(to, True)
            if files.exists(source):
                files.mkdirs(to.getParent())
                self._rename(source, to)
            return
        files.mkdirs(to)
        for arrival, source in sources.items():
            prefix = f"{arrival}-"
            if arrival == batch_id:
                for status in files.listStatus(to):
                    if status.getPath().getName().startswith(prefix):
                        files.delete(status.getPath(), False)
            for status in files.listStatus(source) if files.exists(source) else ():
                name = status.getPath().getName()
                if not name.startswith(("_", ".")):
                    self._rename(status.getPath(), self._path(f"{target}/{prefix}{name}"))

    def _delete(self, path: str) -> None:
        self._files.delete(self._path(path), True)

    def _rename(self, source, target) -> None:
        if not self._files.rename(source, target):
            raise OSError(f"cannot move {source} to {target}")

    def _staging(self, batch_id: int) -> str:
        return f"{self.path}/_staging/{ARRIVAL}={batch_id}"

    def _slot(self, batch_id: int) -> str:
        """Two folders take turns, so a repeated batch finds the journal before it unchanged."""
        return f"{self.path}/_pending/slot={batch_id % 2}"

    def _state(self, batch_id: int) -> DataFrame:
        schema = ", ".join([*(f"{p} string" for p in self.partitions), f"{ARRIVAL} long", "seen timestamp", "closed boolean"])
        return self.spark.read.schema(schema).parquet(self._slot(batch_id))

    def pending(self, batch_id: int) -> DataFrame:
        """Partitions written but not yet visible after a batch."""
        return self._state(batch_id).where(~F.col("closed") & F.col(self.partitions[0]).isNotNull()).select(*self.partitions).distinct()

    def _time(self) -> Column:
        return partition_time({p: F.col(p) for p in self.partitions}, self.pattern, self.shift)

    def _folder(self, row, names: Sequence[str]) -> str:
        """``name=value/...`` with the values escaped as Spark's writer does."""
        return "/".join(self._escape(n, str(row[n])) for n in names)

    def _add(self, ready: list[dict]) -> None:
        for at in range(0, len(ready), CALL_SIZE):
            specs = [", ".join(f"`{n}`={_literal(row[n])}" for n in self.names) for row in ready[at : at + CALL_SIZE]]
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({s})" for s in specs))
        if self.success_file:
            self._each(self._mark, [(f"{self.path}/{self._folder(row, self.names)}/_SUCCESS",) for row in ready])

    def _mark(self, path: str) -> None:
        """An empty file that tells readers of the folder that the partition is complete."""
        self._files.create(self._path(path), True).close()

    @staticmethod
    def _each(act, calls: list[tuple]) -> None:
        with ThreadPoolExecutor(MARK_THREADS) as pool:
            list(pool.map(lambda call: act(*call), calls))


def _literal(value) -> str:
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"
