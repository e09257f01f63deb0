"""Rows into a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.mutate import last_change


def write_jdbc(df: DataFrame, url: str, table: str, driver: str, user: str = "", password: str = "",
               key: str | None = None, order: str | None = None, connections: int = 8, batch_size: int = 5_000) -> None:
    """Append rows. With ``key`` a batch holds one row per key, the last by ``order``: what a staging table for an upsert needs.

    ``connections`` bounds the sessions opened on the database, not the rows.
    """
    if key and not order:
        raise ValueError("a key needs the order that tells its last row")
    rows = last_change(df, key, order) if key else df
    options = {"url": url, "dbtable": table, "driver": driver, "user": user, "password": password,
               "batchsize": str(batch_size), "numPartitions": str(connections)}
    rows.write.format("jdbc").mode("append").options(**options).save()
