"""Shop, comment and shop-list messages: filters, flattening, tables and documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import json_fields as J
from ..functions import times
from ..operators import records as R
from ..session import configure, scratch
from ..sinks.documents import read_documents, write_documents, write_json_texts
from ..sinks.rolling import RollingLines
from ..sinks.tables import read_table, write_batch, write_dated
from ..streaming import ingest as I
from ..streaming import runs
from ..streaming.shops import judged_shops, partitioned_shops, shop_documents, shop_events, shop_lines, write_partitioned_shops
from . import fixtures as X

ZONE = "Asia/Shanghai"


def _shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.shop_messages(X.spread(X.load(configure(spark), sf_dir, "lineitem")))


def _shop_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.shop_messages(X.load_stream(configure(spark), sf_dir, "lineitem"))


def _comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.comment_messages(X.spread(X.load(configure(spark), sf_dir, "lineitem")))


def _shop_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.shop_list_messages(X.spread(X.load(configure(spark), sf_dir, "customer")))


# -- reading JSON ------------------------------------------------------------------------------------


def json_scalars(spark, sf_dir):
    events = X.load(configure(spark), sf_dir, "events")
    parsed = J.parse_objects(events, ["k", "absent"], "props", keep=["event_id"])
    k, absent = F.col("k"), F.col("absent")
    return parsed.select(
        "event_id",
        k.alias("k_text"), J.unboxed(k, "int").alias("k_int"), J.unboxed(k, "long").alias("k_long"),
        J.unboxed(k, "double").alias("k_double"), J.unboxed(absent, "int").alias("absent_int"),
        J.unboxed(absent, "double").alias("absent_double"), J.boxed(absent, "int").alias("absent_boxed"),
        J.boxed(k, "double").alias("k_boxed"),
    )


def json_ignore_errors(spark, sf_dir):
    """The shop topic read as a table."""
    fields = (S.Field("wm_poi_id", "mtWmPoiId"), S.Field("shop_name", "shopName"), S.Field("online_pay", "onlinePay"))
    return R.ignore_parse_errors(_shops(spark, sf_dir), fields)


def filter_has_key(spark, sf_dir):
    return R.with_key(_shops(spark, sf_dir), S.SHOP_KEY).select("key", "offset")


def filter_value_not_null(spark, sf_dir):
    return R.with_value(_shops(spark, sf_dir), "itemList").select("key", "offset")


def reject_invalid(spark, sf_dir):
    """Messages that gave no shop, with the reason."""
    rejects = R.rejected(R.typed_records(_shops(spark, sf_dir), S.SHOP, keep=["key"]))
    return rejects.select("key", R.REASON)


def event_time_default(spark, sf_dir):
    shops = shop_events(_shops(spark, sf_dir), F.lit(X.NOW).cast("timestamp"), delay=None)
    return shops.select("wm_poi_id", "create_time", F.date_format("event_time", times.TIME_FORMAT).alias("event_time"))


# -- flattening --------------------------------------------------------------------------------------


def explode_items(spark, sf_dir):
    elements = R.explode_property(_shops(spark, sf_dir), "itemList")
    return R.element_records(elements, S.RECORD_ITEM)


def explode_coupons(spark, sf_dir):
    elements = R.explode_property(_shops(spark, sf_dir), "couponList")
    return R.element_records(elements, S.COUPON).select("coupon_id", "coupon_pool_id", "activity_id", "coupon_value")


def explode_comments(spark, sf_dir):
    elements = R.explode_property(_comments(spark, sf_dir), "list")
    return R.element_records(elements, S.USER_COMMENT).select("user_id", "user_name", "score", "content", "pictures")


def explode_top_array(spark, sf_dir):
    return R.element_records(R.explode_message(_shop_list(spark, sf_dir)), S.SHOP_BASIC).select("wm_poi_id", "shop_name", "wm_poi_score", "status")


# -- tables and documents ----------------------------------------------------------------------------


def _stored(kind: I.RecordType, messages: DataFrame) -> DataFrame:
    """The rows after a trip through their dated table."""
    spark = messages.sparkSession
    path = scratch(spark, kind.table)
    write_dated(kind.rows(messages, X.NOW), path, X.DAY)
    names = [f.name for f in kind.row]
    return read_table(spark, path, S.ddl(kind.row, "batch_date string")).select(*names, "batch_date")


def _documents(kind: I.RecordType, messages: DataFrame) -> DataFrame:
    """The documents after a trip through their index."""
    spark = messages.sparkSession
    path = scratch(spark, f"doc_{kind.name}")
    write_documents(kind.documents(messages, X.NOW), path, kind.name, X.DAY)
    return read_documents(spark, path, kind.document)


def _table_query(kind: I.RecordType, messages):
    return lambda spark, sf_dir: _stored(kind, messages(spark, sf_dir))


def _document_query(kind: I.RecordType, messages):
    return lambda spark, sf_dir: _documents(kind, messages(spark, sf_dir))


SOURCES = {I.SHOP: _shops, I.ITEM: _shops, I.COUPON: _shops, I.SHOP_BASIC: _shop_list, I.SHOP_COMMENT: _comments,
           I.USER_COMMENT: _comments}


def doc_shop_stream(spark, sf_dir):
    """Shops streamed as documents without null fields."""
    root = scratch(spark, "doc_stream")
    stream = shop_documents(judged_shops(_shop_stream(spark, sf_dir)))

    def write(batch: DataFrame, batch_id: int) -> None:
        write_json_texts(batch, f"{root}/documents", "shop", X.DAY, batch_id, f"{root}/quarantine")

    runs.drain(runs.into_batches(stream, write, f"{root}/checkpoint"))
    return read_documents(spark, f"{root}/documents", S.SHOP)


def tsv_line(spark, sf_dir):
    shops = R.records_of(_shops(spark, sf_dir), S.SHOP)
    return R.delimited_line(shops, S.SHOP_LINE_COLUMNS).withColumnRenamed("value", "line")


def tsv_bucketed(spark, sf_dir):
    """Shop lines streamed into rolling files in a folder per day of a zone, each day then compacted."""
    root = scratch(spark, "lines")
    shops = shop_events(_shop_stream(spark, sf_dir), F.lit(X.NOW).cast("timestamp"))
    sink = RollingLines(spark, f"{root}/out")
    runs.drain(runs.into_batches(shop_lines(shops, ZONE), sink, f"{root}/checkpoint"))
    for day in sink.days():
        sink.compact(day)
    lines = sink.read()
    return lines.select(F.col("value").alias("line"), "batch_date")


def _partitioned_shops(spark: SparkSession, sf_dir: str) -> str:
    """The folder with the table and the rejects of the shop stream."""
    root = scratch(spark, "shop_parts")

    def write(batch: DataFrame, batch_id: int) -> None:
        write_partitioned_shops(batch, f"{root}/table", f"{root}/rejected", batch_id)

    runs.drain(runs.into_batches(partitioned_shops(_shop_stream(spark, sf_dir)), write, f"{root}/checkpoint"))
    return root


def shop_stream_partitioned(spark, sf_dir):
    """Shops streamed into a table partitioned by day, hour and minute."""
    schema = S.ddl(S.SHOP, "batch_id long, dt string, hr string, mm string")
    return read_table(spark, f"{_partitioned_shops(spark, sf_dir)}/table", schema).drop("batch_id")


def reject_shop_times(spark, sf_dir):
    """What the same stream set aside: with the table's rows, every message that carries the shop key or is no object."""
    root = _partitioned_shops(spark, sf_dir)
    stored = read_table(spark, f"{root}/table", "wm_poi_id string").select(F.lit(None).cast("string").alias("reject_reason"))
    set_aside = read_table(spark, f"{root}/rejected", "value string, reject_reason string").select("reject_reason")
    return stored.unionAll(set_aside).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"))


def reject_arrays(spark, sf_dir):
    """Messages whose array cannot be read, by topic and output."""
    parts = []
    for kind, messages in ((I.ITEM, _shops), (I.SHOP_BASIC, _shop_list)):
        judged = kind.frame(I.shared_parse((kind,))(messages(spark, sf_dir)))
        parts.append(kind.rejects(judged).select("sink", "reject_reason", F.length("value").alias("size")))
    return reduce(DataFrame.unionAll, parts).groupBy("sink", "reject_reason").agg(
        F.count(F.lit(1)).alias("rows"), F.count("size").alias("texts"))


def fanout_counts(spark, sf_dir):
    """Rows that one pass over the shop stream puts into each of its sinks."""
    root = scratch(spark, "fanout")
    write = I.topic_writer("shop1", root, X.NOW)
    runs.drain(runs.into_batches(_shop_stream(spark, sf_dir), write, f"{root}/checkpoint"))
    counts = []
    for kind in I.TOPICS["shop1"]:
        rows = read_table(spark, f"{root}/{kind.table}", S.ddl(kind.row, "batch_id long, batch_date string"))
        documents = read_documents(spark, f"{root}/documents", kind.document).where(F.col("doc_index") == kind.name)
        rejects = read_table(spark, f"{root}/rejected_{kind.name}", "sink string, value string, reject_reason string, batch_id long")
        for name, df in ((kind.table, rows), (f"doc_{kind.name}", documents), (f"rejected_{kind.name}", rejects)):
            counts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("sink"), "rows"))
    return reduce(DataFrame.unionAll, counts)


# -- SQL ---------------------------------------------------------------------------------------------

_CREATED = """CASE WHEN l_discount <> 0.09
  THEN strftime(date_trunc('month', l_shipdate) + to_hours(l_linenumber), '%Y-%m-%d %H:%M:%S') END"""
_KEY = "l_orderkey || '-' || l_linenumber"
_OFFSET = "CAST(l_orderkey * 64 + l_linenumber AS BIGINT)"
_HAS_KEY = f"NOT (l_linestatus = 'O' AND {X.NO_SHOP_KEY})"
_SHOP_ROWS = f"FROM lineitem WHERE NOT {X.BROKEN} AND {_HAS_KEY} AND NOT {X.BAD_NUMBER}"
_DOC_ROWS = f"{_SHOP_ROWS} AND NOT {X.TEXT_FEE}"
_ITEM_ROWS = f"FROM lineitem WHERE NOT {X.BROKEN} AND NOT {X.BAD_LIST} AND l_discount NOT IN (0.05, 0.06)"
_SHOP_ID = f"CASE WHEN NOT ({X.NO_SHOP_KEY}) THEN CAST(l_suppkey AS VARCHAR) END"

_SHOP = {
    "wm_poi_id": _SHOP_ID, "dp_shop_id": "l_linenumber", "shop_name": "'shop_' || l_suppkey",
    "shop_status": "CAST(l_quantity AS INT)", "shop_pic": "l_returnflag", "delivery_fee": f"CASE WHEN {X.TEXT_FEE} THEN 'free' ELSE CAST(l_linenumber AS VARCHAR) END",
    "delivery_type": "CAST(l_linenumber AS VARCHAR)", "delivery_time": "strftime(l_shipdate, '%Y-%m-%d')",
    "min_fee": "CASE WHEN l_discount <> 0.0 THEN l_extendedprice END",
    "online_pay": "CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS INT) END",
    "bulletin": "CASE WHEN l_returnflag = 'A' THEN 'a \"quoted\" text' END", "shipping_time": "l_linestatus",
    "create_time": _CREATED,
}
_SHOP_DOC = {
    **_SHOP, "delivery_fee": "l_linenumber", "delivery_type": "l_linenumber", "delivery_msg": "'msg_' || l_linenumber",
    "min_fee": "CASE WHEN l_discount <> 0.0 THEN l_extendedprice ELSE 0.0::DOUBLE END",
    "online_pay": "CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS INT) ELSE 0 END", "update_time": f"'{X.NOW}'",
}


def _item(key: str, prefix: str, price: str, current: str) -> dict[str, str]:
    return {
        "wm_poi_id": "CAST(l_suppkey AS VARCHAR)", "dp_shop_id": "l_linenumber", "shop_name": "'shop_' || l_suppkey",
        "spu_id": key, "spu_name": f"'{prefix}' || {key}", "unit": "l_returnflag",
        "tag": "CASE WHEN l_tax >= 0.04 THEN 'tag_' || l_linenumber END", "activity_tag": "l_linestatus",
        "little_image": f"'l/' || {key}", "big_image": f"'b/' || {key}", "origin_price": price, "current_price": current,
        "spu_desc": "l_linestatus", "praise_num": "CAST(l_quantity AS BIGINT)", "activity_type": "CAST(l_linenumber AS BIGINT)",
        "spu_promotion_info": "l_returnflag", "status_desc": "l_linestatus", "category_name": "l_returnflag",
        "category_type": "l_linestatus", "create_time": _CREATED,
    }


_COUPON = {
    "wm_poi_id": "CAST(l_suppkey AS VARCHAR)", "dp_shop_id": "l_linenumber", "shop_name": "'shop_' || l_suppkey",
    "coupon_id": "l_orderkey", "coupon_pool_id": "l_partkey", "activity_id": "CASE WHEN l_tax <> 0.02 THEN l_suppkey ELSE 0 END",
    "coupon_value": "l_discount", "coupon_condition_text": "'over_' || l_linenumber", "coupon_valid_time_text": "l_returnflag",
    "coupon_status": "l_linestatus", "limit_new_user": "CAST(NULL AS VARCHAR)", "create_time": _CREATED,
}
_COMMENT = {
    "shop_id": "CASE WHEN l_returnflag <> 'N' THEN l_suppkey END", "wm_poi_id": _SHOP_ID, "record_count": "l_orderkey",
    "dp_comment_num": "CAST(l_linenumber AS BIGINT)", "praise_ratio": "'p' || l_linenumber", "quality_score": "l_quantity",
    "pack_score": "l_tax", "integrated_score": "l_extendedprice", "shop_score": "0.0::DOUBLE", "delivery_score": "l_discount",
    "comment_labels": "'[\"' || l_returnflag || '\",\"' || l_linestatus || '\"]'", "create_time": _CREATED,
}


def _user_comment(key: str, score: str) -> dict[str, str]:
    return {
        "shop_id": "l_suppkey", "wm_poi_id": "CAST(l_suppkey AS VARCHAR)", "user_id": key, "user_name": f"'u_' || {key}",
        "user_pic_url": "CAST(NULL AS VARCHAR)", "comment_time": "strftime(l_shipdate, '%Y-%m-%d')", "score": score,
        "delivery_time": "l_linestatus", "content": "'said \"' || l_linestatus || '\"' || chr(10)",
        "shop_reply": "CASE WHEN l_tax > 0.03 THEN 'thanks' END", "is_anonymous": "CAST(l_linenumber AS BIGINT)",
        "pictures": f"'[\"p/' || {key} || '\"]'", "create_time": f"'{X.NOW}'",
    }


def _basic(suffix: str, score: str) -> dict[str, str]:
    return {
        "wm_poi_id": f"c_custkey || '{suffix}'", "shop_name": "c_name", "status_desc": "c_mktsegment",
        "address": "'n' || c_nationkey", "pic_url": "CAST(NULL AS VARCHAR)", "wm_poi_score": score, "shipping_time": "'09:00'",
        "status": "CASE WHEN c_nationkey > 9 THEN c_nationkey ELSE 0 END", "create_time": f"'{X.NOW}'",
    }


def _select(columns: dict[str, str], rows: str, **more: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in {**columns, **more}.items()) + f" {rows}"


def _union(parts: list[dict[str, str]], rows: str, **more: str) -> str:
    return " UNION ALL ".join(_select(p, rows, **more) for p in parts)


_TABLE = {"batch_date": f"'{X.DAY}'"}
_UPDATED = {"update_time": f"'{X.NOW}'"}
_ITEMS = [
    _item("l_partkey", "part_", "l_extendedprice", "l_extendedprice * (1 - l_discount)"),
    _item("l_orderkey", "order_", "l_tax", "0.0::DOUBLE"),
]
_COUPON_ROWS = f"FROM lineitem WHERE NOT {X.BROKEN} AND l_discount > 0.0"
_COMMENT_ROWS = f"FROM lineitem WHERE NOT {X.BROKEN} AND {_HAS_KEY}"
_USER_ROWS = f"FROM lineitem WHERE NOT {X.BROKEN} AND l_returnflag = 'R'"
_BASIC_ROWS = "FROM customer WHERE c_nationkey NOT IN (3, 4)"
_BASICS = [_basic("", "c_nationkey"), _basic("-b", "CAST(trunc(c_acctbal) AS INT)")]
_USERS = [_user_comment(k, "CAST(l_linenumber AS DOUBLE)") for k in ("l_orderkey", "l_partkey")]
_USER_DOCS = [_user_comment(k, "CAST(l_linenumber AS BIGINT)") for k in ("l_orderkey", "l_partkey")]


def _place(index: str) -> dict[str, str]:
    return {"doc_index": f"'{index}'", "doc_type": f"'{X.DAY}'"}


_LINE = " || chr(9) || ".join(f"coalesce(CAST({_SHOP[c]} AS VARCHAR), 'null')" for c in S.SHOP_LINE_COLUMNS)
_EVENT_TIME = f"coalesce({_CREATED}, '{X.NOW}')"


def _pick(columns: dict[str, str], *names: str) -> dict[str, str]:
    return {n: columns[n] for n in names}


def _count(sink: str, rows: str, times_: int = 1) -> str:
    return f"SELECT '{sink}' AS sink, CAST({times_} * count(*) AS BIGINT) AS rows {rows}"


QUERIES = {
    "json_scalars": json_scalars,
    "json_ignore_errors": json_ignore_errors,
    "filter_has_key": filter_has_key,
    "filter_value_not_null": filter_value_not_null,
    "reject_invalid": reject_invalid,
    "event_time_default": event_time_default,
    "explode_items": explode_items,
    "explode_coupons": explode_coupons,
    "explode_comments": explode_comments,
    "explode_top_array": explode_top_array,
    **{kind.table: _table_query(kind, messages) for kind, messages in SOURCES.items()},
    **{f"doc_{kind.name}": _document_query(kind, messages) for kind, messages in SOURCES.items()},
    "doc_shop_stream": doc_shop_stream,
    "tsv_line": tsv_line,
    "tsv_bucketed": tsv_bucketed,
    "reject_shop_times": reject_shop_times,
    "reject_arrays": reject_arrays,
    "shop_stream_partitioned": shop_stream_partitioned,
    "fanout_counts": fanout_counts,
}

ORACLES = {
    "json_scalars": """
      SELECT event_id, json_extract_string(props, '$.k') AS k_text, CAST(json_extract_string(props, '$.k') AS INT) AS k_int,
             CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_long, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_double,
             coalesce(CAST(json_extract_string(props, '$.absent') AS INT), 0) AS absent_int,
             coalesce(CAST(json_extract_string(props, '$.absent') AS DOUBLE), 0) AS absent_double,
             CAST(json_extract_string(props, '$.absent') AS INT) AS absent_boxed,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_boxed
      FROM events""",
    "json_ignore_errors": _select(
        {**_pick(_SHOP, "wm_poi_id", "shop_name"), "online_pay": "CASE WHEN l_returnflag <> 'N' THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) END"},
        f"FROM lineitem WHERE NOT {X.BROKEN}",
    ),
    "filter_has_key": f"SELECT {_KEY} AS key, {_OFFSET} AS \"offset\" FROM lineitem WHERE NOT {X.BROKEN} AND {_HAS_KEY}",
    "filter_value_not_null": f"""SELECT {_KEY} AS key, {_OFFSET} AS "offset" FROM lineitem
      WHERE NOT {X.BROKEN} AND l_discount <> 0.06""",
    "reject_invalid": f"""SELECT {_KEY} AS key, CASE WHEN {X.BROKEN} THEN 'not_an_object' ELSE 'bad_number:dp_shop_id' END AS reject_reason
      FROM lineitem WHERE {X.BROKEN} OR {X.BAD_NUMBER}""",
    "event_time_default": _select(_pick(_SHOP, "wm_poi_id", "create_time"), _SHOP_ROWS, event_time=_EVENT_TIME),
    "explode_items": _union([_pick(i, "spu_id", "spu_name") for i in _ITEMS], _ITEM_ROWS),
    "explode_coupons": _select(_pick(_COUPON, "coupon_id", "coupon_pool_id", "activity_id", "coupon_value"), _COUPON_ROWS),
    "explode_comments": _union([_pick(u, "user_id", "user_name", "score", "content", "pictures") for u in _USERS], _USER_ROWS),
    "explode_top_array": _union([_pick(b, "wm_poi_id", "shop_name", "wm_poi_score", "status") for b in _BASICS], _BASIC_ROWS),
    "ods_shop": _select(_SHOP, _SHOP_ROWS, **_TABLE),
    "ods_item": _union(_ITEMS, _ITEM_ROWS, **_TABLE),
    "ods_coupon": _select(_COUPON, _COUPON_ROWS, **_TABLE),
    "ods_shop_basic": _union(_BASICS, _BASIC_ROWS, **_TABLE),
    "ods_shop_comment": _select(_COMMENT, _COMMENT_ROWS, **_TABLE),
    "ods_user_comment": _union(_USERS, _USER_ROWS, **_TABLE),
    "doc_shop": _select(_SHOP_DOC, _DOC_ROWS, **_place("shop")),
    "doc_item": _union(_ITEMS, _ITEM_ROWS, **_UPDATED, **_place("item")),
    "doc_coupon": _select(_COUPON, _COUPON_ROWS, **_UPDATED, **_place("coupon")),
    "doc_shop_basic": _union(_BASICS, _BASIC_ROWS, **_UPDATED, **_place("shop_basic")),
    "doc_shop_comment": _select(_COMMENT, _COMMENT_ROWS, **_UPDATED, **_place("shop_comment")),
    "doc_user_comment": _union(_USER_DOCS, _USER_ROWS, **_UPDATED, **_place("user_comment")),
    "doc_shop_stream": _select(_SHOP, _SHOP_ROWS, **_place("shop")),
    "tsv_line": f"SELECT {_LINE} AS line {_SHOP_ROWS}",
    "tsv_bucketed": f"""SELECT {_LINE} AS line, strftime(CAST({_EVENT_TIME} AS TIMESTAMP) + INTERVAL 8 HOUR, '%Y-%m-%d') AS batch_date
      {_SHOP_ROWS}""",
    "shop_stream_partitioned": _select(
        _SHOP, f"{_SHOP_ROWS} AND l_discount <> 0.09", dt=f"left({_CREATED}, 10)", hr=f"substr({_CREATED}, 12, 2)",
        mm=f"substr({_CREATED}, 15, 2)",
    ),
    "reject_shop_times": f"""SELECT CASE WHEN {X.BROKEN} THEN 'not_an_object' WHEN {X.BAD_NUMBER} THEN 'bad_number:dp_shop_id'
      WHEN l_discount = 0.09 THEN 'no_event_time' END AS reject_reason, CAST(count(*) AS BIGINT) AS rows
      FROM lineitem WHERE {X.BROKEN} OR {_HAS_KEY} GROUP BY 1""",
    "reject_arrays": f"""SELECT sink, 'not_an_array' AS reject_reason, rows, rows AS texts FROM (
      SELECT unnest(['ods_item', 'doc_item']) AS sink, CAST(count(*) AS BIGINT) AS rows FROM lineitem WHERE {X.BAD_LIST}
      UNION ALL SELECT unnest(['ods_shop_basic', 'doc_shop_basic']), CAST(count(*) AS BIGINT) FROM customer WHERE c_nationkey IN (3, 4))""",
    "fanout_counts": " UNION ALL ".join([
        _count("ods_shop", _SHOP_ROWS), _count("doc_shop", _DOC_ROWS),
        f"""SELECT 'rejected_shop', CAST(count(*) FILTER ({X.BROKEN} OR {X.BAD_NUMBER})
          + count(*) FILTER ({X.BROKEN} OR {X.BAD_NUMBER} OR {X.TEXT_FEE}) AS BIGINT) FROM lineitem""",
        _count("ods_item", _ITEM_ROWS, 2), _count("doc_item", _ITEM_ROWS, 2), _count("rejected_item", f"FROM lineitem WHERE {X.BAD_LIST}", 2),
        _count("ods_coupon", _COUPON_ROWS), _count("doc_coupon", _COUPON_ROWS), "SELECT 'rejected_coupon', CAST(0 AS BIGINT)",
    ]),
}
