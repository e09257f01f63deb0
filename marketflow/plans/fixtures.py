"""Messages and tables derived from the supplied tables, row by row.

Each ``*_messages`` function maps one row of a table (or stream) to one message,
without grouping, so the work grows with the table and no key can gather rows.
The odd cases the operators must stand are tied to column values:

- status ``F``: numbers are sent as text, array elements as JSON text, and
  missing fields as explicit nulls; status ``O``: plain numbers and objects, and
  missing fields left out;
- ``BROKEN`` lines: the text has no end or is wrapped in an array;
- ``BAD_NUMBER`` lines: the shop number is no number;
- ``TEXT_FEE`` lines: the fee is a text, which the table takes and the documents do not;
- ``BAD_LIST`` lines: the item list is an object, or the text of an array without its end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import TIME_FORMAT
from ..sources.files import table_stream

NOW = "2024-06-01 12:00:00"
DAY = NOW[:10]

# Conditions that Spark and the checking SQL share.
BROKEN = "(l_tax = 0.08 AND l_discount IN (0.0, 0.1))"
BAD_NUMBER = "(l_linestatus = 'F' AND l_tax = 0.07 AND l_discount = 0.1)"
TEXT_FEE = "(l_linestatus = 'F' AND l_tax = 0.06 AND l_discount = 0.1)"
BAD_LIST = "(l_tax = 0.05 AND l_discount = 0.1)"
NO_SHOP_KEY = "l_tax = 0.0"
CUT_CLICK = "(value < 2)"
LOST_TIME = "(value >= 2 AND value < 4)"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """Deal the rows out when ``table`` (``df`` itself, or the files a stream reads) has fewer pieces than cores.

    A small table is one file, and one task would make all its messages. A large
    one comes in many pieces and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if (df if table is None else table).rdd.getNumPartitions() < cores else df


def load_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table as a stream, dealt out like the table."""
    rows = load(spark, sf_dir, table)
    return spread(table_stream(spark, f"{sf_dir}/{table}.parquet", rows.schema), rows)


def _object(fields: dict[str, Column], as_text: bool) -> Column:
    values = [(c.cast("string") if as_text else c).alias(k) for k, c in fields.items()]
    return F.to_json(F.struct(*values), {"ignoreNullFields": str(not as_text).lower()})


def _array(elements: list[dict[str, Column]], as_text: bool) -> Column:
    if as_text:
        return F.array(*(_object(e, True) for e in elements))
    return F.array(*(F.struct(*(c.alias(k) for k, c in e.items())) for e in elements))


def _with_arrays(fields: dict[str, Column], arrays: dict[str, Column], as_text: bool) -> Column:
    values = [(c.cast("string") if as_text else c).alias(k) for k, c in fields.items()]
    values += [c.alias(k) for k, c in arrays.items()]
    return F.to_json(F.struct(*values), {"ignoreNullFields": str(not as_text).lower()})


def _line_messages(lineitem: DataFrame, topic: str, message, spoilt=lambda text, as_text: text) -> DataFrame:
    """``message(as_text)`` of every line: as text for status F, plain for the others; ``spoilt`` may change it.

    What a message holds several times is made in a projection of its own, once.
    """

    def part(as_text: bool) -> DataFrame:
        rows = lineitem.where(F.col("l_linestatus") == "F" if as_text else F.col("l_linestatus") != "F")
        rows = rows.withColumns({"_created": _created(), "_shop_id": F.col("l_suppkey").cast("string"), "_shop_name": _text("shop_", "l_suppkey")})
        rows = rows.withColumn("_text", message(as_text))
        opened = F.expr("CASE WHEN l_tax = 0.08 AND l_discount = 0.1 THEN '{\"cut\":' WHEN l_tax = 0.08 AND l_discount = 0.0 THEN '[' ELSE '' END")
        closed = F.expr("CASE WHEN l_tax = 0.08 AND l_discount = 0.0 THEN ']' ELSE '' END")
        return rows.select(
            F.lit(topic).alias("topic"),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"),
            F.concat(opened, spoilt(F.col("_text"), as_text), closed).alias("value"),
            F.lit(0).alias("partition"),
            (F.col("l_orderkey") * 64 + F.col("l_linenumber")).alias("offset"),
            F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        )

    return part(True).unionAll(part(False))


def _created() -> Column:
    at = F.date_trunc("month", F.col("l_shipdate")) + F.make_dt_interval(hours=F.col("l_linenumber"))
    return F.when(F.expr("l_discount <> 0.09"), F.date_format(at, TIME_FORMAT))


def _text(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _shop_keys() -> dict[str, Column]:
    return {"mtWmPoiId": F.col("_shop_id"), "dpShopId": F.col("l_linenumber"), "shopName": F.col("_shop_name")}


def shop_messages(lineitem: DataFrame) -> DataFrame:
    """Topic ``shop1``: a shop with two items (none, or no list, at some discounts) and up to one coupon."""
    c = F.col

    def item(key: str, prefix: str, price: Column, current: Column) -> dict[str, Column]:
        return {
            **_shop_keys(), "spuId": c(key), "spuName": _text(prefix, key), "unit": c("l_returnflag"),
            "tag": F.when(F.expr("l_tax >= 0.04"), _text("tag_", "l_linenumber")), "activityTag": c("l_linestatus"),
            "littleImageUrl": _text("l/", key), "bigImageUrl": _text("b/", key), "originPrice": price,
            "currentPrice": current, "spuDesc": c("l_linestatus"), "praiseNum": c("l_quantity").cast("long"),
            "activityType": c("l_linenumber"), "spuPromotionInfo": c("l_returnflag"), "statusDesc": c("l_linestatus"),
            "categoryName": c("l_returnflag"), "categoryType": c("l_linestatus"), "createTime": c("_created"),
        }

    items = [
        item("l_partkey", "part_", c("l_extendedprice"), c("l_extendedprice") * (1 - c("l_discount"))),
        item("l_orderkey", "order_", c("l_tax"), F.lit(None).cast("double")),
    ]
    coupon = {
        **_shop_keys(), "couponId": c("l_orderkey"), "couponPoolId": c("l_partkey"),
        "activityId": F.when(F.expr("l_tax <> 0.02"), c("l_suppkey")), "couponValue": c("l_discount"),
        "couponConditionText": _text("over_", "l_linenumber"), "couponValidTimeText": c("l_returnflag"),
        "couponStatus": c("l_linestatus"), "limitNewUser": F.lit(None).cast("string"), "createTime": c("_created"),
    }

    def message(as_text: bool) -> Column:
        shop = {
            "mtWmPoiId": F.when(~F.expr(NO_SHOP_KEY), c("l_suppkey").cast("string")),
            "dpShopId": F.when(F.expr(BAD_NUMBER), _text("x", "l_linenumber")).otherwise(c("l_linenumber").cast("string"))
            if as_text else c("l_linenumber"),
            "shopName": c("_shop_name"), "shopStatus": c("l_quantity").cast("int"), "shopPic": c("l_returnflag"),
            "deliveryFee": F.when(F.expr(TEXT_FEE), F.lit("free")).otherwise(c("l_linenumber").cast("string"))
            if as_text else c("l_linenumber"), "deliveryType": c("l_linenumber"),
            "deliveryTime": F.date_format("l_shipdate", "yyyy-MM-dd"), "deliveryMsg": _text("msg_", "l_linenumber"),
            "minFee": F.when(F.expr("l_discount <> 0.0"), c("l_extendedprice")),
            "onlinePay": F.when(F.expr("l_returnflag <> 'N'"), c("l_quantity").cast("int")),
            "bulletin": F.when(F.expr("l_returnflag = 'A'"), F.lit('a "quoted" text')), "shipping_time": c("l_linestatus"),
            "createTime": c("_created"),
        }
        listed = _array(items, as_text)
        sent = F.when(F.expr("l_discount = 0.05"), 0).otherwise(2)
        arrays = {
            "itemList": F.when(F.expr(f"l_discount <> 0.06 AND NOT {BAD_LIST}"), F.slice(listed, F.lit(1), sent)),
            "couponList": F.when(F.expr("l_discount > 0.0"), _array([coupon], as_text)),
        }
        return _with_arrays(shop, arrays, as_text)

    def spoilt(text: Column, as_text: bool) -> Column:
        if as_text:
            unread = F.replace(text, F.lit('"itemList":null'), F.lit('"itemList":"[{"'))
        else:
            unread = F.concat(F.lit('{"itemList":{"spuId":1},'), F.substr(text, F.lit(2)))
        return F.when(F.expr(BAD_LIST), unread).otherwise(text)

    return _line_messages(lineitem, "shop1", message, spoilt)


def comment_messages(lineitem: DataFrame) -> DataFrame:
    """Topic ``comment1``: a shop's scores with two user comments (flag R), an empty list (A) or none (N)."""
    c = F.col

    def comment(key: str) -> dict[str, Column]:
        return {
            "shopId": c("l_suppkey"), "mtWmPoiId": c("l_suppkey").cast("string"), "userID": c(key),
            "userName": _text("u_", key), "userPicUrl": F.lit(None).cast("string"),
            "commentTime": F.date_format("l_shipdate", "yyyy-MM-dd"), "score": c("l_linenumber"),
            "deliveryTime": c("l_linestatus"), "content": F.concat(F.lit('said "'), "l_linestatus", F.lit('"\n')),
            "shopReply": F.when(F.expr("l_tax > 0.03"), F.lit("thanks")), "isAnonymous": c("l_linenumber"),
            "originalPicUrls": F.to_json(F.array(_text("p/", key))),
        }

    def message(as_text: bool) -> Column:
        labels = F.array("l_returnflag", "l_linestatus")
        shop = {
            "shopId": F.when(F.expr("l_returnflag <> 'N'"), c("l_suppkey")),
            "mtWmPoiId": F.when(~F.expr(NO_SHOP_KEY), c("l_suppkey").cast("string")), "recordCount": c("l_orderkey"),
            "dpCommentNum": c("l_linenumber"), "PraiseRatio": _text("p", "l_linenumber"), "qualityScore": c("l_quantity"),
            "packScore": c("l_tax"), "integratedScore": c("l_extendedprice"), "shopScore": F.lit(None).cast("double"),
            "deliveryScore": c("l_discount"), "commentLabels": F.to_json(labels) if as_text else labels,
            "createTime": c("_created"),
        }
        listed = _array([comment("l_orderkey"), comment("l_partkey")], as_text)
        sent = F.when(F.expr("l_returnflag = 'R'"), 2).otherwise(0)
        some = F.when(F.expr("l_returnflag <> 'N'"), F.slice(listed, F.lit(1), sent))
        return _with_arrays(shop, {"list": some}, as_text)

    return _line_messages(lineitem, "comment1", message)


def shop_list_messages(customer: DataFrame) -> DataFrame:
    """Topic ``shop_list1``: an array of a shop and its branch; nation 3 sends an object, nation 4 a cut text."""
    c = F.col

    def shop(suffix: str, score: Column) -> Column:
        return F.struct(
            F.concat(c("c_custkey").cast("string"), F.lit(suffix)).alias("mtWmPoiId"), c("c_name").alias("shopName"),
            c("c_mktsegment").alias("statusDesc"), _text("n", "c_nationkey").alias("address"),
            F.lit(None).cast("string").alias("picUrl"), score.alias("wmPoiScore"), F.lit("09:00").alias("shipping_time"),
            F.when(F.expr("c_nationkey > 9"), c("c_nationkey")).alias("status"), F.lit(NOW).alias("createTime"),
        )

    pair = F.to_json(F.array(shop("", c("c_nationkey").cast("double")), shop("-b", c("c_acctbal"))))
    value = (
        F.when(F.expr("c_nationkey = 3"), F.to_json(shop("", c("c_acctbal"))))
        .when(F.expr("c_nationkey = 4"), F.expr("left(message, length(message) - 2)"))
        .otherwise(c("message"))
    )
    return customer.withColumn("message", pair).select(
        F.lit("shop_list1").alias("topic"), c("c_custkey").cast("string").alias("key"), value.alias("value")
    )


def behavior_messages(events: DataFrame) -> DataFrame:
    """Topic ``user_behavior``: one click per event; the shop is the number in ``props``."""
    shop = F.get_json_object("props", "$.k")
    fields = {
        "sessionId": F.col("event_id").cast("string"), "userId": F.col("user_id").cast("string"), "mtWmPoiId": shop,
        "shopName": F.concat(F.lit("shop_"), shop), "platform": F.col("event_type"),
        "source": F.concat(F.lit("src"), (F.col("user_id") % 3).cast("string")),
        "createTime": F.date_format("ts", TIME_FORMAT),
    }
    return events.select(
        F.lit("user_behavior").alias("topic"), F.col("user_id").cast("string").alias("key"),
        _object(fields, False).alias("value"), (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
    )


def spoilt_behavior_messages(events: DataFrame) -> DataFrame:
    """The same clicks; the text of some is cut, the time of some is no time."""
    condition = F.when(F.expr(CUT_CLICK), 1).when(F.expr(LOST_TIME), 2).otherwise(0)
    clicks = behavior_messages(events.withColumn("event_type", F.concat(condition, F.col("event_type"))))
    mark = F.regexp_extract("value", '"platform":"([0-2])', 1)
    spoilt = (
        F.when(mark == "1", F.regexp_replace("value", "}$", ""))
        .when(mark == "2", F.regexp_replace("value", '"createTime":"[^"]*"', '"createTime":"2024-13-01 00:00:00"'))
        .otherwise(F.col("value"))
    )
    return clicks.withColumn("value", spoilt)


# SQL of the same clicks. ``{where}`` narrows the events.
BEHAVIOR_SQL = """
  SELECT CAST(event_id AS VARCHAR) AS session_id, CAST(user_id AS VARCHAR) AS user_id,
         json_extract_string(props, '$.k') AS mt_wm_poi_id, 'shop_' || json_extract_string(props, '$.k') AS shop_name,
         'src' || CAST(user_id % 3 AS VARCHAR) AS source, event_type AS platform,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr,
         strftime(ts, '%M') AS mm, date_trunc('second', ts) AS event_time, user_id % 4 AS part, event_id AS pos
  FROM events
"""


def change_messages(events: DataFrame) -> DataFrame:
    """Topic of database changes: ``{"table": …, "data": {…}}``; some texts are cut, some name no table."""
    data = F.struct("event_id", "user_id")
    full = F.to_json(F.struct(F.col("event_type").alias("table"), data.alias("data")))
    value = (
        F.when(F.expr("value < 5"), F.expr("left(message, length(message) - 1)"))
        .when(F.expr("value < 10"), F.to_json(F.struct(data.alias("data"))))
        .otherwise(F.col("message"))
    )
    return events.withColumn("message", full).select(F.col("user_id").cast("string").alias("key"), value.alias("value"))


def records(lineitem: DataFrame) -> DataFrame:
    """The ``record`` table: a shop message as response, with its request and time."""
    messages = shop_messages(lineitem)
    return messages.select(
        F.col("value").alias("response"), F.concat(F.lit("q="), "key").alias("request"),
        F.date_format("timestamp", TIME_FORMAT).alias("create_time"),
    )


def shop_table(customer: DataFrame) -> DataFrame:
    """Wide shop rows; nation 0 has no key, segment MACHINERY no picture."""
    return customer.select(
        F.when(F.expr("c_nationkey <> 0"), F.col("c_custkey").cast("string")).alias("wm_poi_id"),
        F.col("c_name").alias("shop_name"), F.col("c_nationkey").cast("string").alias("shop_status"),
        F.when(F.expr("c_mktsegment <> 'MACHINERY'"), F.col("c_mktsegment")).alias("shop_pic"),
    )
