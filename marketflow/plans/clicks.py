"""Clicks: windows, ranked shops, time columns, and the streams of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, times
from ..operators import behavior as B
from ..operators import views as V
from ..operators.ranking import top_rows
from ..schemas import BEHAVIOR
from ..session import configure, scratch
from ..sinks.commit import PartitionCommit
from ..sinks.keyed import KeyedTable
from ..sinks.tables import create_table, insert_dynamic, insert_static, read_table, write_batch
from ..sinks.topic import write_topic
from ..sources.files import read_partition
from ..sources.topic import FILE_RECORDS, topic_batch, topic_head, topic_parts, topic_stream
from ..streaming import runs
from ..streaming.windows import RankedShops, windowed
from . import fixtures as X

BEHAVIOR_DDL = ", ".join(f"{f.name} string" for f in BEHAVIOR)
DAY_WINDOW = "1 day"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.spread(X.load(configure(spark), sf_dir, "events"))


def _behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.behaviors(X.behavior_messages(_events(spark, sf_dir)))


def _behavior_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.behaviors(X.behavior_messages(X.load_stream(configure(spark), sf_dir, "events")))


def _text_times(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.date_format(c, times.TIME_FORMAT) for c in ("window_start", "window_end")})


# -- windows and ranks over the table ------------------------------------------------------------


def hot_shop_window(spark, sf_dir):
    return _text_times(B.shop_windows(_behaviors(spark, sf_dir)))


def hot_shop_window_day(spark, sf_dir):
    return _text_times(B.shop_windows(_behaviors(spark, sf_dir), DAY_WINDOW))


def hot_shop_window_platform(spark, sf_dir):
    """Windows per shop and platform."""
    return _text_times(B.shop_windows(_behaviors(spark, sf_dir), DAY_WINDOW, ("mt_wm_poi_id", "platform")))


def hot_shop_top3(spark, sf_dir):
    return B.ranked_shops(B.shop_windows(_behaviors(spark, sf_dir)), 3)


def hot_shop_top3_day(spark, sf_dir):
    return B.ranked_shops(B.shop_windows(_behaviors(spark, sf_dir), DAY_WINDOW), 3)


def hot_shop_top10(spark, sf_dir):
    return B.ranked_shops(B.shop_windows(_behaviors(spark, sf_dir)), 10)


def hot_shop_by_name(spark, sf_dir):
    return B.shops_by_name(B.first_per_shop(_behaviors(spark, sf_dir)), 10)


def _window_sql(size: str, by: str = "mt_wm_poi_id", source: str = X.BEHAVIOR_SQL, where: str = "") -> str:
    first = ", ".join(
        f"first({c} ORDER BY event_time, part, pos) AS {c}" for c in B.BEHAVIOR_COLUMNS if c not in by.split(", ")
    )
    return f"""
      SELECT time_bucket(INTERVAL '{size}', event_time) AS w, {by}, {first}, CAST(count(*) AS BIGINT) AS action_num
      FROM ({source}) {where} GROUP BY w, {by}"""


def _window_result(size: str, inner: str) -> str:
    return f"""
      SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
             strftime(w + INTERVAL '{size}', '%Y-%m-%d %H:%M:%S') AS window_end, {", ".join(B.BEHAVIOR_COLUMNS)}, action_num
      FROM ({inner})"""


def _top_sql(inner: str, n: int) -> str:
    return f"""
      SELECT md5(platform || '|' || mt_wm_poi_id || '|' || time_key) AS id, mt_wm_poi_id, shop_name, source, platform,
             time_key, action_num, '1' AS status
      FROM (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY action_num DESC, time_key, mt_wm_poi_id) AS row_num
            FROM (SELECT *, dt || ' ' || hr || ':' || mm AS time_key FROM ({inner})))
      WHERE row_num <= {n}"""


BY_NAME_SQL = f"""
  SELECT md5(platform || '|' || mt_wm_poi_id || '|' || '0000-00-00 00:00') AS id, mt_wm_poi_id, shop_name, source, platform,
         '0000-00-00 00:00' AS time_key, CAST(10 AS BIGINT) AS action_num, '1' AS status
  FROM (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY shop_name DESC, mt_wm_poi_id) AS row_num
        FROM (SELECT mt_wm_poi_id, first(shop_name ORDER BY event_time, part, pos) AS shop_name,
                     first(source ORDER BY event_time, part, pos) AS source,
                     first(platform ORDER BY event_time, part, pos) AS platform
              FROM ({X.BEHAVIOR_SQL}) GROUP BY mt_wm_poi_id))
  WHERE row_num <= 10"""


def reject_clicks(spark, sf_dir):
    """Every message of a click topic with bad ones among them: the reason of those that give no click."""
    messages = X.spoilt_behavior_messages(_events(spark, sf_dir))
    good = B.behaviors(messages).select("offset", F.lit(None).cast("string").alias("reject_reason"), "session_id")
    bad = B.rejected_behaviors(messages).select("offset", "reject_reason", F.lit(None).cast("string").alias("session_id"))
    return good.unionAll(bad)


# -- columns ---------------------------------------------------------------------------------------


def time_key_concat(spark, sf_dir):
    rows = _behaviors(spark, sf_dir)
    return rows.select("session_id", B.time_key().alias("time_key"), F.concat("mt_wm_poi_id", "shop_name").alias("name"))


def surrogate_id(spark, sf_dir):
    rows = _behaviors(spark, sf_dir).withColumn("time_key", B.time_key())
    return rows.select("session_id", ids.stable_id("platform", "mt_wm_poi_id", "time_key").alias("id"))


def date_parts(spark, sf_dir):
    rows = _behaviors(spark, sf_dir)
    return rows.select("session_id", "create_time", "dt", "hr", "mm", times.epoch_millis(F.col("create_time")).alias("epoch_ms"))


def partition_time(spark, sf_dir):
    """Time of the partition of every click, also of values out of range: the month is moved on
    by the last digit of the user, the day by the hour, the minute by the user."""
    rows = _behaviors(spark, sf_dir).select("session_id", F.col("user_id").cast("int").alias("u"), "dt", "hr", "mm")
    year, month, day = (F.split("dt", "-")[i].cast("int") for i in range(3))
    moved = F.concat_ws("-", year, month + F.col("u") % 10, (day + F.col("hr").cast("int")) % 100)
    minute = ((F.col("mm").cast("int") + F.col("u")) % 100).cast("string")
    exact = {"dt": F.col("dt"), "hr": F.col("hr"), "mm": F.col("mm")}
    late = {"dt": moved, "hr": F.col("hr"), "mm": minute}
    return rows.select(
        "session_id",
        F.date_format(times.partition_time(exact), times.TIME_FORMAT).alias("partition_time"),
        F.date_format(times.partition_time(late), times.TIME_FORMAT).alias("rolled_time"),
        F.date_format(times.partition_time({"dt": F.col("dt")}, "$dt", shift=0), times.TIME_FORMAT).alias("date_only"),
        F.unix_millis(times.partition_time(exact, shift=0)).alias("partition_ms"),
    )


# -- tables ----------------------------------------------------------------------------------------


def _click_table(spark: SparkSession, name: str) -> tuple[str, str]:
    path = scratch(spark, name)
    table = f"mf_{name}_{path[-12:]}"
    create_table(spark, table, BEHAVIOR_DDL, "dt string, hr string", path=path)
    return table, path


def partition_pruned_scan(spark, sf_dir):
    """One day of the partitioned click table."""
    rows = _behaviors(spark, sf_dir)
    table, _ = _click_table(spark, "pruned")
    insert_dynamic(rows.hint("rebalance", "dt", "hr"), table)
    return read_partition(spark, table, {"dt": "2024-01-15"}).select(*B.BEHAVIOR_COLUMNS[:7], "dt", "hr")


def static_partition_insert(spark, sf_dir):
    """All clicks put into one named partition."""
    rows = _behaviors(spark, sf_dir)
    table, _ = _click_table(spark, "static")
    insert_static(rows, table, {"dt": "2021-01-10", "hr": "14"})
    return read_partition(spark, table, {"dt": "2021-01-10", "hr": "14"})


def preview_limit(spark, sf_dir):
    rows = _behaviors(spark, sf_dir).select(*B.BEHAVIOR_COLUMNS, "offset")
    return top_rows(rows, 10, [F.asc("offset")]).drop("offset")


def topk_behavior(spark, sf_dir):
    counted = _behaviors(spark, sf_dir).groupBy("mt_wm_poi_id").agg(F.count(F.lit(1)).alias("count"))
    return top_rows(counted, 3, [F.desc("count"), F.asc("mt_wm_poi_id")])


# -- streams ---------------------------------------------------------------------------------------


def src_topic_stream(spark, sf_dir):
    """Clicks sent to a topic and read from it as a stream."""
    root = scratch(spark, "topic")
    write_topic(X.behavior_messages(_events(spark, sf_dir)), path=f"{root}/topics")
    messages = topic_stream(spark, ["user_behavior"], path=f"{root}/topics").select("topic", "key", "value", "partition", "offset")
    runs.drain(runs.into_files(messages, f"{root}/out", f"{root}/checkpoint"))
    return read_table(spark, f"{root}/out", "topic string, key string, value string, partition int, offset long")


def topic_latest(spark, sf_dir):
    """Messages that a stream without a checkpoint finds which starts at the latest: those sent after it has been started.

    The first half of the clicks is there before; the second half comes in two parts, the latter while the stream stands still.
    """
    root = scratch(spark, "latest")
    messages = X.behavior_messages(_events(spark, sf_dir))
    last = messages.agg(F.max("offset")).first()[0] or 0
    old, late = F.col("offset") <= last // 2, F.col("offset") > last * 3 // 4
    for part in (old, ~old & ~late, late):
        write_topic(messages.where(part), path=f"{root}/topics")
        stream = topic_stream(spark, ["user_behavior"], path=f"{root}/topics", start="latest", starts=f"{root}/starts")
        runs.drain(runs.into_files(stream.select("key", "value", "partition", "offset"), f"{root}/out", f"{root}/checkpoint"))
    return read_table(spark, f"{root}/out", "key string, value string, partition int, offset long")


def topic_bounded(spark, sf_dir):
    """All messages with the bound of a batch, and whether the batch that brought each kept to it. Each partition of the topic has a stream."""
    root, bound = scratch(spark, "bounded"), 2 * FILE_RECORDS
    write_topic(X.behavior_messages(_events(spark, sf_dir)), path=f"{root}/topics", file_records=FILE_RECORDS, by_partition=True)

    def bounded(i: int, part: str):
        stream = topic_stream(spark, ["user_behavior"], path=f"{root}/topics", max_per_trigger=bound, part=part)
        write = lambda batch, batch_id: write_batch(batch.coalesce(1), f"{root}/out/stream={i}", batch_id)
        return runs.into_batches(stream.select("partition", "offset", "value"), write, f"{root}/checkpoint/{i}")

    runs.drain_all(bounded(i, part) for i, part in enumerate(topic_parts(spark, "user_behavior", f"{root}/topics")))
    rows = read_table(spark, f"{root}/out", "partition int, offset long, value string, stream int, batch_id long")
    sizes = rows.groupBy("stream", "batch_id").agg((F.count(F.lit(1)) <= bound).alias("kept"))
    return rows.join(sizes, ["stream", "batch_id"]).select("partition", "offset", "value", F.when(F.col("kept"), F.lit(bound)).alias("bound"))


def topic_head_lines(spark, sf_dir):
    """The first records of the click topic."""
    root = scratch(spark, "head")
    write_topic(X.behavior_messages(_events(spark, sf_dir)), path=root)
    return topic_head(topic_batch(spark, ["user_behavior"], path=root)).select("line")


def behavior_partitioned(spark, sf_dir):
    """Clicks streamed into a table partitioned by day and hour."""
    root = scratch(spark, "behavior")
    stream = _behavior_stream(spark, sf_dir).select(*B.BEHAVIOR_COLUMNS)
    write = lambda batch, batch_id: write_batch(batch, f"{root}/table", batch_id, ("dt", "hr"))
    runs.drain(runs.into_batches(stream, write, f"{root}/checkpoint"))
    schema = f"{BEHAVIOR_DDL}, mm string, batch_id long, dt string, hr string"
    return read_table(spark, f"{root}/table", schema).select(*B.BEHAVIOR_COLUMNS)


def hot_shop_window_stream(spark, sf_dir):
    root = scratch(spark, "windows")
    windows = windowed(_behavior_stream(spark, sf_dir))
    runs.drain(runs.into_files(windows, f"{root}/out", f"{root}/checkpoint"))
    return _text_times(read_table(spark, f"{root}/out", _ddl(windows)))


def watermark_3500ms(spark, sf_dir):
    root = scratch(spark, "watermark")
    windows = windowed(_behavior_stream(spark, sf_dir), delay=B.SHOP_DELAY, size=DAY_WINDOW)
    runs.drain(runs.into_files(windows, f"{root}/out", f"{root}/checkpoint"))
    return _text_times(read_table(spark, f"{root}/out", _ddl(windows)))


def hot_shop_top3_stream(spark, sf_dir):
    """Ranked shops kept up to date from the stream of closed windows."""
    root = scratch(spark, "ranked")
    ranked = RankedShops(spark, f"{root}/state", 3)
    windows = windowed(_behavior_stream(spark, sf_dir), size=DAY_WINDOW)
    query = runs.drain(runs.into_batches(windows, ranked, f"{root}/checkpoint"))
    return ranked.result(query.lastProgress.batchId)


def ranked_upsert_stream(spark, sf_dir):
    """Ranked shops of every batch put into a table by id, where a shop that was ranked once stays.

    The month arrives in two steps; a shop's window keeps its id.
    """
    root = scratch(spark, "ranked_table")
    schema = "id string, mt_wm_poi_id string, shop_name string, source string, platform string, time_key string, action_num long, status string"
    table = KeyedTable(spark, f"{root}/table", schema, "id", "action_num")
    write = lambda batch, batch_id: table(B.ranked_shops(batch, 3), batch_id)
    messages = X.behavior_messages(_events(spark, sf_dir))
    first_half = F.col("timestamp") < F.lit("2024-01-16").cast("timestamp")
    for part in (first_half, ~first_half):
        write_topic(messages.where(part), path=f"{root}/topics")
        clicks = B.behaviors(topic_stream(spark, ["user_behavior"], path=f"{root}/topics"))
        query = runs.drain(runs.into_batches(windowed(clicks, size=DAY_WINDOW), write, f"{root}/checkpoint"))
    return table.result(query.lastProgress.batchId)


def view_stream(spark, sf_dir):
    """A stream of clicks under a name, queried in SQL."""
    root = scratch(spark, "view")
    sql = "SELECT session_id, upper(platform) AS platform, source FROM click_stream WHERE shop_name LIKE 'shop_1%' AND hr < '12'"
    rows = V.query(spark, sql, {"click_stream": _behavior_stream(spark, sf_dir)})
    runs.drain(runs.into_files(rows, f"{root}/out", f"{root}/checkpoint"))
    return read_table(spark, f"{root}/out", "session_id string, platform string, source string")


def late_drop(spark, sf_dir):
    """Sign-ups arrive after all other clicks: those of closed windows are dropped."""
    root = scratch(spark, "late")
    messages = X.behavior_messages(_events(spark, sf_dir))
    signup = F.get_json_object("value", "$.platform") == "signup"
    for part in (~signup, signup):
        write_topic(messages.where(part), path=f"{root}/topics")
        stream = topic_stream(spark, ["user_behavior"], path=f"{root}/topics")
        windows = windowed(B.behaviors(stream), size=DAY_WINDOW)
        runs.drain(runs.into_files(windows, f"{root}/out", f"{root}/checkpoint"))
    return _text_times(read_table(spark, f"{root}/out", _ddl(windows)))


def restart_no_duplicates(spark, sf_dir):
    """A stream stopped after the first half of the month and resumed from its checkpoint."""
    root = scratch(spark, "restart")
    messages = X.behavior_messages(_events(spark, sf_dir))
    write = lambda batch, batch_id: write_batch(batch, f"{root}/table", batch_id)
    first_half = F.col("timestamp") < F.lit("2024-01-16").cast("timestamp")
    for part in (first_half, ~first_half):
        write_topic(messages.where(part), path=f"{root}/topics")
        stream = B.behaviors(topic_stream(spark, ["user_behavior"], path=f"{root}/topics")).select(*B.BEHAVIOR_COLUMNS)
        runs.drain(runs.into_batches(stream, write, f"{root}/checkpoint"))
    schema = ", ".join(f"{c} string" for c in B.BEHAVIOR_COLUMNS)
    return read_table(spark, f"{root}/table", f"{schema}, batch_id long").drop("batch_id")


def partition_commit(spark, sf_dir):
    """Clicks in the hours that the watermark has left behind."""
    path = scratch(spark, "commit")
    sink = PartitionCommit(spark, f"mf_commit_{path[-12:]}", BEHAVIOR_DDL, f"{path}/table", commit_delay="1 hour")
    runs.drain(runs.into_batches(_behavior_stream(spark, sf_dir), sink, f"{path}/checkpoint"))
    return spark.table(sink.table).drop("batch_id")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _closed(size: str, delay: str, source: str = X.BEHAVIOR_SQL) -> str:
    return f"w + INTERVAL '{size}' <= (SELECT max(event_time) FROM ({source})) - INTERVAL '{delay}'"


def _stream_window_sql(size: str, delay: str) -> str:
    return _window_result(size, f"SELECT * FROM ({_window_sql(size)}) WHERE {_closed(size, delay)}")


_CLOSED_FIRST = _closed("1 day", "20 seconds", f"SELECT * FROM ({X.BEHAVIOR_SQL}) WHERE dt < '2024-01-16'")
_ON_TIME = f"(SELECT * FROM ({X.BEHAVIOR_SQL}) WHERE platform <> 'signup')"
_KEPT = f"""
  SELECT * FROM ({X.BEHAVIOR_SQL})
  WHERE platform <> 'signup'
     OR time_bucket(INTERVAL '1 day', event_time) + INTERVAL '1 day'
        > (SELECT max(event_time) FROM {_ON_TIME}) - INTERVAL '20 seconds'"""

_ALL = f"SELECT {', '.join(B.BEHAVIOR_COLUMNS)} FROM ({X.BEHAVIOR_SQL})"
_VALUE = """'{"sessionId":"' || session_id || '","userId":"' || user_id || '","mtWmPoiId":"' || mt_wm_poi_id
  || '","shopName":"' || shop_name || '","platform":"' || platform || '","source":"' || source
  || '","createTime":"' || create_time || '"}'"""
_KEPT_COLUMNS = ", ".join([*B.BEHAVIOR_COLUMNS[:7], "dt", "hr"])

QUERIES = {
    "hot_shop_window": hot_shop_window,
    "hot_shop_window_day": hot_shop_window_day,
    "hot_shop_window_platform": hot_shop_window_platform,
    "hot_shop_top3": hot_shop_top3,
    "hot_shop_top3_day": hot_shop_top3_day,
    "hot_shop_top10": hot_shop_top10,
    "hot_shop_by_name": hot_shop_by_name,
    "reject_clicks": reject_clicks,
    "time_key_concat": time_key_concat,
    "surrogate_id": surrogate_id,
    "date_parts": date_parts,
    "partition_time": partition_time,
    "partition_pruned_scan": partition_pruned_scan,
    "static_partition_insert": static_partition_insert,
    "preview_limit": preview_limit,
    "topk_behavior": topk_behavior,
    "src_topic_stream": src_topic_stream,
    "topic_latest": topic_latest,
    "topic_bounded": topic_bounded,
    "topic_head": topic_head_lines,
    "behavior_partitioned": behavior_partitioned,
    "hot_shop_window_stream": hot_shop_window_stream,
    "watermark_3500ms": watermark_3500ms,
    "hot_shop_top3_stream": hot_shop_top3_stream,
    "ranked_upsert_stream": ranked_upsert_stream,
    "view_stream": view_stream,
    "late_drop": late_drop,
    "restart_no_duplicates": restart_no_duplicates,
    "partition_commit": partition_commit,
}

ORACLES = {
    "hot_shop_window": _window_result("2 minutes", _window_sql("2 minutes")),
    "hot_shop_window_day": _window_result("1 day", _window_sql("1 day")),
    "hot_shop_window_platform": _window_result("1 day", _window_sql("1 day", "mt_wm_poi_id, platform")),
    "hot_shop_top3": _top_sql(_window_sql("2 minutes"), 3),
    "hot_shop_top3_day": _top_sql(_window_sql("1 day"), 3),
    "hot_shop_top10": _top_sql(_window_sql("2 minutes"), 10),
    "hot_shop_by_name": BY_NAME_SQL,
    "reject_clicks": f"""SELECT event_id AS "offset", CASE WHEN {X.CUT_CLICK} THEN 'not_an_object' WHEN {X.LOST_TIME} THEN 'bad_time' END
      AS reject_reason, CASE WHEN NOT {X.CUT_CLICK} AND NOT {X.LOST_TIME} THEN CAST(event_id AS VARCHAR) END AS session_id FROM events""",
    "time_key_concat": f"SELECT session_id, dt || ' ' || hr || ':' || mm AS time_key, mt_wm_poi_id || shop_name AS name FROM ({X.BEHAVIOR_SQL})",
    "view_stream": f"""SELECT session_id, upper(platform) AS platform, source FROM ({X.BEHAVIOR_SQL})
      WHERE shop_name LIKE 'shop_1%' AND hr < '12'""",
    "surrogate_id": f"""SELECT session_id, md5(platform || '|' || mt_wm_poi_id || '|' || dt || ' ' || hr || ':' || mm) AS id
      FROM ({X.BEHAVIOR_SQL})""",
    "date_parts": f"SELECT session_id, create_time, dt, hr, mm, epoch_ms(event_time) AS epoch_ms FROM ({X.BEHAVIOR_SQL})",
    "partition_time": f"""
      SELECT session_id, strftime(date_trunc('minute', event_time) - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS partition_time,
             strftime(make_timestamp(year(event_time), 1, 1, 0, 0, 0) + to_months(month(event_time)::INT - 1 + u % 10)
               + to_days((day(event_time)::INT + hour(event_time)::INT) % 100 - 1) + to_hours(hour(event_time)::INT)
               + to_minutes((minute(event_time)::INT + u) % 100) - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS rolled_time,
             strftime(date_trunc('day', event_time), '%Y-%m-%d %H:%M:%S') AS date_only,
             epoch_ms(date_trunc('minute', event_time)) AS partition_ms
      FROM (SELECT *, CAST(user_id AS INT) AS u FROM ({X.BEHAVIOR_SQL}))""",
    "partition_pruned_scan": f"SELECT {_KEPT_COLUMNS} FROM ({X.BEHAVIOR_SQL}) WHERE dt = '2024-01-15'",
    "static_partition_insert": f"""SELECT {', '.join(B.BEHAVIOR_COLUMNS[:7])}, '2021-01-10' AS dt, '14' AS hr
      FROM ({X.BEHAVIOR_SQL})""",
    "preview_limit": f"SELECT {', '.join(B.BEHAVIOR_COLUMNS)} FROM ({X.BEHAVIOR_SQL}) ORDER BY pos LIMIT 10",
    "topk_behavior": f"""SELECT mt_wm_poi_id, count(*) AS count FROM ({X.BEHAVIOR_SQL}) GROUP BY 1
      ORDER BY count DESC, mt_wm_poi_id LIMIT 3""",
    "src_topic_stream": f"""SELECT 'user_behavior' AS topic, user_id AS key, {_VALUE} AS value,
      CAST(part AS INT) AS partition, pos AS "offset" FROM ({X.BEHAVIOR_SQL})""",
    "topic_latest": f"""SELECT user_id AS key, {_VALUE} AS value, CAST(part AS INT) AS partition, pos AS "offset" FROM ({X.BEHAVIOR_SQL})
      WHERE pos > (SELECT max(event_id) // 2 FROM events)""",
    "topic_bounded": f"""SELECT CAST(part AS INT) AS partition, pos AS "offset", {_VALUE} AS value, {2 * FILE_RECORDS} AS bound FROM ({X.BEHAVIOR_SQL})""",
    "topic_head": f"""SELECT 'topic=user_behavior, partition=' || part || ', offset=' || pos || ', customer=' || user_id
      || ', country=' || {_VALUE} AS line FROM ({X.BEHAVIOR_SQL}) ORDER BY part, pos LIMIT 51""",
    "behavior_partitioned": _ALL,
    "hot_shop_window_stream": _stream_window_sql("2 minutes", "20 seconds"),
    "watermark_3500ms": _stream_window_sql("1 day", "3500 milliseconds"),
    "hot_shop_top3_stream": _top_sql(f"SELECT * FROM ({_window_sql('1 day')}) WHERE {_closed('1 day', '20 seconds')}", 3),
    "ranked_upsert_stream": " UNION ALL ".join(
        "SELECT * FROM (" + _top_sql(f"SELECT * FROM ({_window_sql(DAY_WINDOW)}) WHERE {part}", 3) + ")"
        for part in (_CLOSED_FIRST, f"NOT ({_CLOSED_FIRST}) AND {_closed('1 day', '20 seconds')}")
    ),
    "late_drop": _window_result(
        "1 day", f"SELECT * FROM ({_window_sql('1 day', source=_KEPT)}) WHERE {_closed('1 day', '20 seconds')}"
    ),
    "restart_no_duplicates": _ALL,
    "partition_commit": f"""SELECT {_KEPT_COLUMNS} FROM ({X.BEHAVIOR_SQL})
      WHERE date_trunc('hour', event_time) + INTERVAL 1 HOUR <= (SELECT max(event_time) FROM ({X.BEHAVIOR_SQL})) - INTERVAL '20 seconds'""",
}

