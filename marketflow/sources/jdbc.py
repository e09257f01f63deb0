"""Tables of a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, driver: str, user: str = "", password: str = "",
                 partition_column: str | None = None, bounds: tuple[str, str] | None = None,
                 partitions: int | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options. With ``partition_column`` the scan runs as ``partitions`` range queries."""
    options = {"url": url, "dbtable": table, "driver": driver, "user": user, "password": password,
               "fetchsize": str(fetch_size)}
    if partition_column:
        if not bounds or not partitions:
            raise ValueError("a partitioned scan needs bounds and a number of partitions")
        options |= {"partitionColumn": partition_column, "lowerBound": bounds[0], "upperBound": bounds[1],
                    "numPartitions": str(partitions)}
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, driver: str, **options) -> DataFrame:
    """A lazy scan; filters and the columns in use go into the database query."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, driver, **options)).load()


def catalog_settings(name: str, url: str, driver: str, user: str = "", password: str = "") -> dict[str, str]:
    """Settings that make the tables of a database visible as ``name.schema.table``."""
    root = f"spark.sql.catalog.{name}"
    return {root: "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog", f"{root}.url": url,
            f"{root}.driver": driver, f"{root}.user": user, f"{root}.password": password}


def register_catalog(spark: SparkSession, name: str, url: str, driver: str, user: str = "", password: str = "") -> None:
    for key, value in catalog_settings(name, url, driver, user, password).items():
        spark.conf.set(key, value)


def records_since(records: DataFrame, since: str) -> DataFrame:
    """Response, request and time of the records created after a time text.

    A plain comparison on the column, so that it reaches the scan.
    """
    return records.where(records["create_time"] > since).select("response", "request", "create_time")
