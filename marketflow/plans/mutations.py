"""Keyed changes of a stored table.

Stored documents are the customers, changes come from the parts: parts beyond the
last customer are new keys, the others hit a stored one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mutate as M
from ..session import configure, scratch
from ..sinks.bucketed import DocumentTable
from . import fixtures as X


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.load(configure(spark), sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("shop_name"), F.col("c_acctbal").alias("min_fee"),
        F.col("c_mktsegment").alias("shop_pic"),
    )


def _documents(spark: SparkSession, sf_dir: str) -> DocumentTable:
    """The stored customers in buckets of their key."""
    path = scratch(spark, "documents")
    return DocumentTable(configure(spark), f"mf_documents_{path[-12:]}", "id", 8).write(_stored(spark, sf_dir), path)


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small parts change the name only, the others name and fee."""
    return X.load(configure(spark), sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("shop_name"),
        F.when(F.expr("p_size > 10"), F.col("p_retailprice")).alias("min_fee"),
    )


def upsert_by_key(spark, sf_dir):
    return M.upsert(_stored(spark, sf_dir), _changes(spark, sf_dir), "id")


def upsert_order_stored(spark, sf_dir):
    """Customers take the total and the time of their last order; the time is a stored column. Customers
    of one segment are not stored yet: their orders give new rows."""
    stored = _stored(spark, sf_dir).withColumn("at", F.lit("1990-01-01 00:00:00"))
    changes = X.load(configure(spark), sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("min_fee"),
        F.concat_ws("-", F.date_format("o_orderdate", "yyyy-MM-dd"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("at"),
    )
    return M.upsert(stored.where("shop_pic <> 'MACHINERY'"), changes, "id", "at")


def partial_update(spark, sf_dir):
    """Existing keys only, with a field the stored table does not have."""
    changes = _changes(spark, sf_dir).withColumn("source", F.lit("part"))
    return M.partial_update(_stored(spark, sf_dir), changes, "id")


def put_by_id(spark, sf_dir):
    return _documents(spark, sf_dir).put(_changes(spark, sf_dir))


def delete_by_id(spark, sf_dir):
    """Customers whose number no supplier has."""
    keys = X.load(configure(spark), sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return _documents(spark, sf_dir).delete(keys)


def multi_get(spark, sf_dir):
    """The documents of all part keys; keys without a document give no row."""
    found = _documents(spark, sf_dir).get(_changes(spark, sf_dir))
    fields = "shop_name string, min_fee double, shop_pic string"
    return found.select("id", F.inline(F.array(F.from_json("document", fields))))


def change_order(spark, sf_dir):
    """Customers take the total of their last order as fee; a customer may have many orders."""
    changes = X.load(configure(spark), sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("min_fee"),
        F.struct("o_orderdate", "o_orderkey").alias("at"),
    )
    return M.partial_update(_stored(spark, sf_dir), changes, "id", order="at")


_OLD = "(SELECT c_custkey AS id, c_name AS shop_name, c_acctbal AS min_fee, c_mktsegment AS shop_pic FROM customer)"
_NEW = "(SELECT p_partkey AS id, p_name AS shop_name, CASE WHEN p_size > 10 THEN p_retailprice END AS min_fee FROM part)"

QUERIES = {
    "upsert_by_key": upsert_by_key,
    "upsert_order_stored": upsert_order_stored,
    "partial_update": partial_update,
    "put_by_id": put_by_id,
    "delete_by_id": delete_by_id,
    "multi_get": multi_get,
    "change_order": change_order,
}
ORACLES = {
    "upsert_by_key": f"""SELECT coalesce(o.id, n.id) AS id, coalesce(n.shop_name, o.shop_name) AS shop_name,
      coalesce(n.min_fee, o.min_fee) AS min_fee, o.shop_pic FROM {_OLD} o FULL JOIN {_NEW} n ON o.id = n.id""",
    "upsert_order_stored": f"""SELECT coalesce(o.id, n.id) AS id, o.shop_name, coalesce(n.total, o.min_fee) AS min_fee, o.shop_pic,
      coalesce(n.at, '1990-01-01 00:00:00') AS at FROM (SELECT * FROM {_OLD} WHERE shop_pic <> 'MACHINERY') o FULL JOIN
      (SELECT o_custkey AS id, last(o_totalprice ORDER BY o_orderdate, o_orderkey) AS total,
        max(strftime(o_orderdate, '%Y-%m-%d') || '-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS at FROM orders GROUP BY 1) n
      ON o.id = n.id""",
    "partial_update": f"""SELECT o.id, coalesce(n.shop_name, o.shop_name) AS shop_name, coalesce(n.min_fee, o.min_fee) AS min_fee,
      o.shop_pic, CASE WHEN n.id IS NOT NULL THEN 'part' END AS source FROM {_OLD} o LEFT JOIN {_NEW} n ON o.id = n.id""",
    "put_by_id": f"""SELECT o.* FROM {_OLD} o WHERE o.id NOT IN (SELECT p_partkey FROM part)
      UNION ALL SELECT id, shop_name, min_fee, CAST(NULL AS VARCHAR) FROM {_NEW}""",
    "delete_by_id": f"SELECT * FROM {_OLD} WHERE id NOT IN (SELECT s_suppkey FROM supplier)",
    "multi_get": f"SELECT * FROM {_OLD} WHERE id IN (SELECT p_partkey FROM part)",
    "change_order": f"""SELECT o.id, o.shop_name, coalesce(n.total, o.min_fee) AS min_fee, o.shop_pic FROM {_OLD} o LEFT JOIN
      (SELECT o_custkey, last(o_totalprice ORDER BY o_orderdate, o_orderkey) AS total FROM orders GROUP BY 1) n ON o.id = n.o_custkey""",
}
