"""Extracts to CSV, refined shops, cells, and delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import cells as C
from ..operators import dedup as D
from ..operators import records as R
from ..operators import views as V
from ..operators.extract import shop_catalog
from ..session import configure, scratch
from ..sinks.cells import CellStore, bulk_load, newest
from ..sinks.files import write_csv, write_lines
from ..sinks.tables import create_table, insert_dynamic, read_table, write_ordered
from ..sources.files import read_delimited, read_lines, read_partition
from ..sources.jdbc import records_since
from . import fixtures as X
from . import ingest as G

SINCE = "1995-06-13 22:00:30"
RECORD = "response string, request string, create_time string"
FROM_KEY, TO_KEY, KEYS = "11", "15", ("7", "104", "13", "none")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.records(X.spread(X.load(configure(spark), sf_dir, "lineitem")))


def record_scan_filter(spark, sf_dir):
    """Records created after a time, from a table stored by time: the filter is the scan's own, as it is a database's."""
    path = scratch(spark, "records")
    write_ordered(_records(spark, sf_dir), path, "create_time")
    return records_since(read_table(spark, path, RECORD), SINCE).select("request", "create_time")


def _csv_query(name: str):
    def query(spark, sf_dir):
        rows = shop_catalog(records_since(_records(spark, sf_dir), SINCE), X.NOW)[name]
        path = scratch(spark, f"csv_{name}")
        write_csv(rows, path)
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        return read_delimited(spark, path, schema, separator=",", header=True)

    return query


# -- refined shops -----------------------------------------------------------------------------------


def _shop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.records_of(X.shop_messages(X.spread(X.load(configure(spark), sf_dir, "lineitem"))), S.SHOP)


def dwd_shop_dedup(spark, sf_dir):
    """Shops by key, stored in the refined table and read from its partition."""
    refined = D.one_per_key(_shop_rows(spark, sf_dir)).withColumn("batch_date", F.lit(X.DAY))
    path = scratch(spark, "dwd_shop")
    table = f"mf_dwd_shop_{path[-12:]}"
    create_table(spark, table, S.ddl(S.SHOP), "batch_date string", path=path)
    insert_dynamic(refined, table)
    return read_partition(spark, table, {"batch_date": X.DAY})


def dwd_shop_latest(spark, sf_dir):
    """The latest whole row of every shop."""
    return D.latest_per_key(_shop_rows(spark, sf_dir))


def collect_set_first(spark, sf_dir):
    """The first of the sorted values of one column; NULL for a group without values."""
    rows = _shop_rows(spark, sf_dir).select("wm_poi_id", "bulletin", "shop_pic")
    return D.one_per_key(rows, ["wm_poi_id"])


def dwd_count(spark, sf_dir):
    return D.one_per_key(_shop_rows(spark, sf_dir)).agg(F.count(F.lit(1)).alias("rows"))


# -- cells and lines ---------------------------------------------------------------------------------


def _shop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.shop_table(X.load(configure(spark), sf_dir, "customer"))


def cells_unpivot(spark, sf_dir):
    return C.to_cells(_shop_table(spark, sf_dir))


def cells_sorted(spark, sf_dir):
    """Cells in store order as bytes, shown in hexadecimal."""
    stored = C.as_bytes(C.sort_cells(C.to_cells(_shop_table(spark, sf_dir))))
    return stored.select(*(F.hex(c).alias(c) for c in stored.columns))


def _stored_shops(spark: SparkSession, sf_dir: str) -> CellStore:
    """Cells of all shops in a store of four files, and in a second load those that lie in nation 2, moved to nation 99."""
    shops = _shop_table(spark, sf_dir)
    store = CellStore(spark, scratch(spark, "cells"))
    store.load(C.to_cells(shops), 0, files=4)
    moved = shops.where("shop_status = 2").withColumn("shop_status", F.lit("99"))
    store.load(C.to_cells(moved, columns=["shop_status"]), 1, files=2)
    return store


def cells_stored(spark, sf_dir):
    """All stored cells with the load that brought them."""
    return _stored_shops(spark, sf_dir).cells()


def cells_range(spark, sf_dir):
    """The newest cells of a range of row keys."""
    return newest(_stored_shops(spark, sf_dir).scan(FROM_KEY, TO_KEY))


def cells_get(spark, sf_dir):
    """The newest cells of single row keys, one of which is not stored."""
    return newest(_stored_shops(spark, sf_dir).get(KEYS))


def _line_folder(spark: SparkSession, sf_dir: str) -> str:
    """Shop lines in a day folder; lines of nation 1 stop after three fields."""
    customers = X.load(configure(spark), sf_dir, "customer").withColumn("dp_shop_id", F.lit("0"))
    columns = ["c_custkey", "dp_shop_id", "c_name", "c_nationkey", "c_mktsegment"]
    long = R.delimited_line(customers.where("c_nationkey <> 1"), columns)
    short = R.delimited_line(customers.where("c_nationkey = 1"), columns[:3])
    path = scratch(spark, "lines")
    write_lines(long.unionAll(short).withColumn("batch_date", F.lit(X.DAY)), path)
    return f"{path}/batch_date={X.DAY}"


def _written_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lines(spark, _line_folder(spark, sf_dir))


def cells_bulk_load(spark, sf_dir):
    """Cells of a store that was loaded from lines."""
    store, _ = bulk_load(spark, _line_folder(spark, sf_dir), scratch(spark, "stores"), "shops", files=3)
    return store.cells().drop("load")


def view_distinct(spark, sf_dir):
    """Shops and items of records as named views, joined and made distinct in SQL."""
    found = shop_catalog(records_since(_records(spark, sf_dir), SINCE), X.NOW)
    sql = """SELECT r.wm_poi_id, count(DISTINCT i.spu_id) AS items, min(i.spu_name) AS first_item
             FROM relation r JOIN item i ON i.spu_id = r.spu_id GROUP BY r.wm_poi_id"""
    return V.query(spark, sql, {"relation": found["relation"], "item": found["item"]})


def tsv_scan_cells(spark, sf_dir):
    good, _ = C.split_fields(_written_lines(spark, sf_dir), C.SHOP_LINE_POSITIONS)
    return C.to_cells(good)


def tsv_short_lines(spark, sf_dir):
    """The lines the cell scan sets aside."""
    _, short = C.split_fields(_written_lines(spark, sf_dir), C.SHOP_LINE_POSITIONS)
    return short.select(F.col("value").alias("line"))


# -- SQL ---------------------------------------------------------------------------------------------

_RECORD = f"l_shipdate > TIMESTAMP '{SINCE}'"
_SHOP_COLUMNS = {"wm_poi_id": G._SHOP_ID, "shop_name": "'shop_' || l_suppkey"}
_NOW = {"create_time": f"'{X.NOW}'"}
_RELATION = [{**_SHOP_COLUMNS, **G._pick(i, "spu_id", "spu_name")} for i in G._ITEMS]
_SHOPS = G._select(G._SHOP, G._SHOP_ROWS)
_OTHERS = [c for c in S.columns(S.SHOP) if c not in D.SHOP_KEYS]
_MINS = ", ".join(f"min({c}) AS {c}" for c in _OTHERS)
_LATEST = ", ".join(f"{c} DESC NULLS LAST" for c in ["create_time", *(c for c in _OTHERS if c != "create_time")])
_WIDE = """SELECT CASE WHEN c_nationkey <> 0 THEN CAST(c_custkey AS VARCHAR) END AS wm_poi_id, c_name AS shop_name,
  CAST(c_nationkey AS VARCHAR) AS shop_status, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS shop_pic FROM customer"""


def _cells_sql(wide: str, wrap: str = "{}") -> str:
    parts = [
        f"SELECT {wrap.format('wm_poi_id')} AS rowkey, {wrap.format(repr(C.FAMILY))} AS family, "
        f"{wrap.format(repr(c))} AS qualifier, {wrap.format(c)} AS value FROM ({wide}) WHERE wm_poi_id IS NOT NULL AND {c} IS NOT NULL"
        for c in C.SHOP_CELLS
    ]
    return " UNION ALL ".join(parts)


_STORED_CELLS = f"""SELECT *, CAST(0 AS BIGINT) AS load FROM ({_cells_sql(_WIDE)})
      UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'info', 'shop_status', '99', 1 FROM customer WHERE c_nationkey = 2"""
_NEWEST_CELLS = f"SELECT rowkey, family, qualifier, arg_max(value, load) AS value FROM ({_STORED_CELLS})"

_LINES_WIDE = """SELECT CAST(c_custkey AS VARCHAR) AS wm_poi_id, c_name AS shop_name,
  CAST(c_nationkey AS VARCHAR) AS shop_status, c_mktsegment AS shop_pic FROM customer WHERE c_nationkey <> 1"""

QUERIES = {
    "record_scan_filter": record_scan_filter,
    "csv_shop": _csv_query("shop"),
    "csv_item": _csv_query("item"),
    "csv_relation": _csv_query("relation"),
    "dwd_shop_dedup": dwd_shop_dedup,
    "dwd_shop_latest": dwd_shop_latest,
    "collect_set_first": collect_set_first,
    "dwd_count": dwd_count,
    "cells_unpivot": cells_unpivot,
    "cells_sorted": cells_sorted,
    "cells_stored": cells_stored,
    "cells_range": cells_range,
    "cells_get": cells_get,
    "cells_bulk_load": cells_bulk_load,
    "view_distinct": view_distinct,
    "tsv_scan_cells": tsv_scan_cells,
    "tsv_short_lines": tsv_short_lines,
}

ORACLES = {
    "record_scan_filter": f"""SELECT 'q=' || {G._KEY} AS request, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time
      FROM lineitem WHERE {_RECORD}""",
    "csv_shop": f"SELECT DISTINCT {G._select({**_SHOP_COLUMNS, **_NOW}, f'FROM lineitem WHERE NOT {X.BROKEN} AND {_RECORD}')[7:]}",
    "csv_item": "SELECT DISTINCT * FROM ("
    + G._union([{**G._pick(i, "spu_id", "spu_name"), **_NOW} for i in G._ITEMS], f"{G._ITEM_ROWS} AND {_RECORD}") + ")",
    "csv_relation": "SELECT DISTINCT * FROM (" + G._union([{**r, **_NOW} for r in _RELATION], f"{G._ITEM_ROWS} AND {_RECORD}") + ")",
    "dwd_shop_dedup": f"SELECT wm_poi_id, dp_shop_id, {_MINS}, '{X.DAY}' AS batch_date FROM ({_SHOPS}) GROUP BY wm_poi_id, dp_shop_id",
    "dwd_shop_latest": f"""SELECT {', '.join(S.columns(S.SHOP))} FROM ({_SHOPS})
      QUALIFY row_number() OVER (PARTITION BY wm_poi_id, dp_shop_id ORDER BY {_LATEST}) = 1""",
    "collect_set_first": f"""SELECT wm_poi_id, list_sort(list(DISTINCT bulletin) FILTER (bulletin IS NOT NULL))[1] AS bulletin,
      list_sort(list(DISTINCT shop_pic))[1] AS shop_pic FROM ({_SHOPS}) GROUP BY wm_poi_id""",
    "dwd_count": f"SELECT count(*) AS rows FROM (SELECT DISTINCT wm_poi_id, dp_shop_id FROM ({_SHOPS}))",
    "cells_unpivot": _cells_sql(_WIDE),
    "cells_sorted": _cells_sql(_WIDE, "hex({})"),
    "cells_stored": _STORED_CELLS,
    "cells_range": f"{_NEWEST_CELLS} WHERE rowkey >= '{FROM_KEY}' AND rowkey < '{TO_KEY}' GROUP BY rowkey, family, qualifier",
    "cells_get": f"{_NEWEST_CELLS} WHERE rowkey IN {KEYS} GROUP BY rowkey, family, qualifier",
    "cells_bulk_load": _cells_sql(_LINES_WIDE),
    "view_distinct": f"""WITH relation AS (SELECT DISTINCT * FROM ({G._union([{**r, **_NOW} for r in _RELATION], f"{G._ITEM_ROWS} AND {_RECORD}")})),
      item AS (SELECT DISTINCT * FROM ({G._union([{**G._pick(i, "spu_id", "spu_name"), **_NOW} for i in G._ITEMS], f"{G._ITEM_ROWS} AND {_RECORD}")}))
      SELECT r.wm_poi_id, count(DISTINCT i.spu_id) AS items, min(i.spu_name) AS first_item
      FROM relation r JOIN item i ON i.spu_id = r.spu_id GROUP BY r.wm_poi_id""",
    "tsv_scan_cells": _cells_sql(_LINES_WIDE),
    "tsv_short_lines": "SELECT c_custkey || chr(9) || '0' || chr(9) || c_name AS line FROM customer WHERE c_nationkey = 1",
}
