"""CSV and line files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, max_files: int | None = None) -> None:
    """Append CSV with a header.

    ``max_files`` bounds the files per write. It gathers the rows in that many
    tasks after the work upstream is done in full width; leave it out for large tables.
    """
    rows = df.repartition(max_files) if max_files else df
    rows.write.option("header", "true").mode("append").csv(path)


def write_lines(df: DataFrame, path: str, bucket: str = "batch_date", max_records: int | None = None) -> None:
    """Append lines (``value``) into bucket folders."""
    writer = df.select("value", bucket).write.mode("append").partitionBy(bucket)
    (writer.option("maxRecordsPerFile", max_records) if max_records else writer).text(path)
