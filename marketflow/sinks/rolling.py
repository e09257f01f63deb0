"""Lines of a stream in day folders, in files of a bounded number of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_folder, file_system
from .tables import gathered

# Fixed value: bytes of a file of the job, beyond which it is closed.
PART_BYTES = 1024 * 1024
DAY = "batch_date"


class RollingLines:
    """A ``foreachBatch`` sink for lines (``value``) with a day.

    The lines of a day are gathered, so that a batch (by a trigger of a minute, the job's interval) makes few files, each of
    ``max_records`` lines at most. A batch is written beside the table and its files are renamed into the day folders, where they bear the number
    of the batch: a repeated batch first removes those of its earlier attempt. ``compact`` later joins the small files of a day.
    """

    def __init__(self, spark: SparkSession, path: str, max_records: int = 100_000):
        self.spark, self.path, self.max_records = spark, path, max_records
        self.files, _ = file_system(spark, path)
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        staged = f"{self.path}/_batches/{batch_id}"
        rows = gathered(batch.select("value", DAY), [DAY])
        rows.write.mode("overwrite").option("maxRecordsPerFile", self.max_records).partitionBy(DAY).text(staged)
        for folder in self._children(staged):
            if folder.startswith(f"{DAY}="):
                day = f"{self.path}/{folder}"
                self.files.mkdirs(self._path(day))
                for name in self._children(day):
                    if name.startswith(f"{batch_id}-"):
                        self.files.delete(self._path(f"{day}/{name}"), False)
                for name in self._children(f"{staged}/{folder}"):
                    if not name.startswith(("_", ".")):
                        self._rename(f"{staged}/{folder}/{name}", f"{day}/{batch_id}-{name}")
        delete_folder(self.spark, staged)

    def read(self) -> DataFrame:
        """All lines with their day."""
        return self.spark.read.schema(f"value string, {DAY} string").text(self.path)

    def compact(self, day: str, part_bytes: int = PART_BYTES) -> bool:
        """Write a day anew in files of about ``part_bytes``, if that makes them fewer; true if it was done.

        Meant for a day to which no batch adds any more. The new folder is written whole beside the table, then takes the old one's place by
        two renames: who reads in between finds no folder, but no line twice. A compaction that broke off is finished or
        undone by the next one.
        """
        folder, new, old = f"{self.path}/{DAY}={day}", f"{self.path}/_compact/{DAY}={day}", f"{self.path}/_replaced/{DAY}={day}"
        if self._exists(old):  # broke off between or after the renames: the new folder is whole
            if not self._exists(folder):
                self._rename(new, folder)
            delete_folder(self.spark, old)
        sizes = [s.getLen() for s in self.files.listStatus(self._path(folder)) if not s.getPath().getName().startswith(("_", "."))] if self._exists(folder) else []
        wanted = max(1, -(-sum(sizes) // part_bytes))
        if len(sizes) <= wanted:
            return False
        lines = self.spark.read.text(folder)
        lines.select("value").repartition(wanted).write.mode("overwrite").text(new)
        delete_folder(self.spark, f"{new}/_SUCCESS")
        self.files.mkdirs(self._path(old).getParent())
        self._rename(folder, old)
        self._rename(new, folder)
        delete_folder(self.spark, old)
        return True

    def days(self) -> list[str]:
        return sorted(name.split("=", 1)[1] for name in self._children(self.path) if name.startswith(f"{DAY}="))

    def _exists(self, path: str) -> bool:
        return self.files.exists(self._path(path))

    def _children(self, path: str) -> list[str]:
        at = self._path(path)
        return [s.getPath().getName() for s in self.files.listStatus(at)] if self.files.exists(at) else []

    def _rename(self, source: str, target: str) -> None:
        if not self.files.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")
