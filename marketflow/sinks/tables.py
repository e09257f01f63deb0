"""Partitioned warehouse tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_folder, scratch

BATCH = "batch_id"

# Rows that a table by time shuffles at once.
ROUND_ROWS = 20_000_000
SHUFFLE_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def use_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.catalog.setCurrentDatabase(database)


def create_table(spark: SparkSession, table: str, schema: str, partitions: str, path: str | None = None,
                 fmt: str = "parquet", replace: bool = False, **options: str) -> None:
    """A partitioned table; ``fmt`` ``csv`` with ``sep`` gives delimited storage."""
    if replace:
        drop_table(spark, table)
    listed = ", ".join(f"'{k}' '{v}'" for k, v in options.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({schema}, {partitions}) USING {fmt} "
        + (f"OPTIONS ({listed}) " if listed else "")
        + f"PARTITIONED BY ({', '.join(p.split()[0] for p in partitions.split(','))}) "
        + (f"LOCATION '{path}'" if path else "")
    )


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def insert_dynamic(df: DataFrame, table: str) -> None:
    """Append; the last columns name the partition of each row."""
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table)


def insert_static(df: DataFrame, table: str, partition: dict[str, str]) -> None:
    """Append all rows into one named partition."""
    spark = df.sparkSession
    named = ", ".join(f"{k}='{v}'" for k, v in partition.items())
    names = [c for c in spark.table(table).columns if c not in partition]
    spark.sql(f"INSERT INTO {table} PARTITION ({named}) SELECT {', '.join(names)} FROM {{rows}}", rows=df)


def gathered(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of one table partition brought together, few files each.

    A rebalance: a partition with most of the rows is split over many tasks, small ones share one.
    """
    return df.hint("rebalance", *(F.col(p) for p in partitions))


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str], fmt: str = "parquet", mode: str = "append") -> None:
    gathered(df, partitions).write.mode(mode).format(fmt).partitionBy(*partitions).save(path)


def write_ordered(df: DataFrame, path: str, column: str, mode: str = "overwrite", group_bytes: int | None = None, round_rows: int = ROUND_ROWS) -> None:
    """Rows ranged over files and sorted by a column, so that a filter on it skips files and row groups by their bounds.

    ``group_bytes`` sets the size of a row group. More than ``round_rows`` rows are written range by range, each with a shuffle of its own that is
    removed before the next: wide rows on their way take more disk than in the table. ``df`` must give the same rows whenever it is read.
    """
    spark = df.sparkSession
    options = {"compression": "zstd", **({"parquet.block.size": str(group_bytes)} if group_bytes else {})}
    kept = spark.conf.get(SHUFFLE_REMOVED, None)
    spark.conf.set(SHUFFLE_REMOVED, "true")
    try:
        for rows in _ranges(df, column, round_rows):
            rows.repartitionByRange(column).sortWithinPartitions(column).write.mode(mode).options(**options).parquet(path)
            mode = "append"
    finally:
        spark.conf.unset(SHUFFLE_REMOVED) if kept is None else spark.conf.set(SHUFFLE_REMOVED, kept)


def _ranges(df: DataFrame, column: str, size: int) -> list[DataFrame]:
    """The rows in ranges of a column of about ``size`` rows each, NULLs first; bounds come from a sample, in Spark's order."""
    values = df.select(column)
    rows = values.count()
    wanted = -(-rows // size)
    if wanted <= 1:
        return [df]
    found = [r[0] for r in values.where(F.col(column).isNotNull()).sample(min(1.0, 2000 * wanted / rows), seed=1).orderBy(column).collect()]
    cuts = list(dict.fromkeys(found[len(found) * i // wanted] for i in range(1, wanted))) if found else []
    at = F.col(column)
    bounds = [F.lit(cut).cast(df.schema[column].dataType) for cut in cuts]
    if not bounds:
        return [df]
    between = [df.where((at >= low) & (at < high)) for low, high in zip(bounds, bounds[1:])]
    return [df.where(at.isNull() | (at < bounds[0])), *between, df.where(at >= bounds[-1])]


def write_dated(df: DataFrame, path: str, day: str, column: str = "batch_date") -> None:
    """Append rows that all belong to one day; nothing is shuffled."""
    df.withColumn(column, F.lit(day)).write.mode("append").partitionBy(column).parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int, partitions: Sequence[str] = (), fmt: str = "parquet") -> None:
    """One micro-batch below its id, replacing an earlier attempt of the same batch."""
    rows = gathered(df, partitions) if partitions else df
    writer = rows.write.mode("overwrite").format(fmt)
    (writer.partitionBy(*partitions) if partitions else writer).save(f"{path}/{BATCH}={batch_id}")


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """A written table; the schema includes its partition columns."""
    return spark.read.schema(schema).format(fmt).load(path)


@contextmanager
def stored_once(df: DataFrame) -> Iterator[DataFrame]:
    """Rows that several sinks read, made once and kept in a scratch folder of compressed columns until the block ends.

    Spark's cache holds them in the heap, and what does not fit there on disk without compression: several times the bytes.
    """
    spark = df.sparkSession
    path = scratch(spark, "held")
    try:
        df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(spark, path)
