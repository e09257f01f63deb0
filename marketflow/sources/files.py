"""Delimited text, parquet tables and their partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_delimited(spark: SparkSession, path: str, schema: str, separator: str = "\t", header: bool = False,
                   null_text: str = "") -> DataFrame:
    """Delimited files with a declared schema."""
    return spark.read.schema(schema).csv(path, sep=separator, header=header, nullValue=null_text)


def read_partition(spark: SparkSession, table: str, partition: dict[str, str], columns: list[str] | None = None) -> DataFrame:
    """One partition of a catalog table; other partitions are not listed or read."""
    df = spark.table(table)
    for name, value in partition.items():
        df = df.where(F.col(name) == value)
    return df.select(*columns) if columns else df


def table_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """A parquet file or folder as a stream; files added later arrive later."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{path}*")
