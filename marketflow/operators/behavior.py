"""Click events: typing, windows per shop, and ranked shops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..functions.ids import stable_id
from ..functions.json_fields import is_object, parse_objects
from ..schemas import BEHAVIOR, TOP_SHOP_COLUMNS, columns
from .ranking import top_per_group
from .records import REASON, accepted, rejected, typed

BEHAVIOR_COLUMNS = [*columns(BEHAVIOR), "dt", "hr", "mm"]
WINDOW_SIZE = "2 minutes"
EVENT_DELAY = "20 seconds"
SHOP_DELAY = "3500 milliseconds"


def behaviors(messages: DataFrame, shift: int = 0) -> DataFrame:
    """Typed clicks of a topic with ``dt``, ``hr``, ``mm``, ``action_num`` 1 and ``event_time``.

    ``partition`` and ``offset`` are kept as the order of arrival. Messages that are
    no object or have no readable time are not among them: see ``rejected_behaviors``.
    """
    return accepted(judged_behaviors(messages, shift)).drop("value")


def rejected_behaviors(messages: DataFrame) -> DataFrame:
    """The messages that give no click, with the reason."""
    return rejected(judged_behaviors(messages)).select("value", "partition", "offset", REASON)


def judged_behaviors(messages: DataFrame, shift: int = 0) -> DataFrame:
    """Every message as a click, with its text and a ``reject_reason`` where it is none."""
    keys = [f.key for f in BEHAVIOR]
    parsed = parse_objects(messages, keys, keep=["value", "partition", "offset"])
    created = F.col("_created")
    rows = parsed.withColumn("_object", is_object()).select(*(typed(f) for f in BEHAVIOR), "partition", "offset", "value", "_object")
    timed = rows.withColumn("_created", times.parse_time(F.col("create_time")))
    return timed.select(
        *columns(BEHAVIOR),
        *(F.date_format(created, fmt).alias(name) for name, fmt in times.PART_FORMATS.items()),
        F.lit(1).cast("long").alias("action_num"),
        (times.shift_hours(created, shift) if shift else created).alias("event_time"),
        "partition",
        "offset",
        "value",
        F.when(~F.col("_object"), F.lit("not_an_object")).when(created.isNull(), F.lit("bad_time")).alias(REASON),
    )


def time_key() -> Column:
    return F.concat("dt", F.lit(" "), "hr", F.lit(":"), "mm")


def shop_windows(rows: DataFrame, size: str = WINDOW_SIZE, by: Sequence[str] = ("mt_wm_poi_id",)) -> DataFrame:
    """Clicks per tumbling window and key; the other columns come from the window's first event.

    "First" is the smallest (event time, partition, offset), which a shuffle cannot
    change. Both aggregates combine before the shuffle, so a shop with most of the
    clicks sends one row per task and window.
    """
    others = [c for c in BEHAVIOR_COLUMNS if c not in by]
    first = F.min_by(F.struct(*others), F.struct("event_time", "partition", "offset"))
    grouped = rows.groupBy(F.window("event_time", size), *by).agg(
        F.sum("action_num").alias("action_num"), first.alias("first")
    )
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *by,
        *(F.col(f"first.{c}").alias(c) for c in others),
        "action_num",
    )


def top_windows(windows: DataFrame, n: int) -> DataFrame:
    """The ``n`` most clicked shop windows of each platform; equal counts by time key and shop."""
    keyed = windows.withColumn("time_key", time_key())
    return top_per_group(keyed, n, ["platform"], [F.desc("action_num"), F.asc("time_key"), F.asc("mt_wm_poi_id")])


def ranked_shops(windows: DataFrame, n: int, row_id: Column | None = None) -> DataFrame:
    """The top windows as rows of the ranked sink.

    The id depends on the row only, so that a later result for the same row replaces it.
    """
    return _as_sink_rows(top_windows(windows, n), F.col("action_num"), F.col("time_key"), row_id)


def shops_by_name(shops: DataFrame, n: int, row_id: Column | None = None) -> DataFrame:
    """The last ``n`` shop names of each platform, with constant count and time key."""
    top = top_per_group(shops, n, ["platform"], [F.desc("shop_name"), F.asc("mt_wm_poi_id")])
    return _as_sink_rows(top, F.lit(10).cast("long"), F.lit("0000-00-00 00:00"), row_id)


def _as_sink_rows(top: DataFrame, count: Column, key: Column, row_id: Column | None) -> DataFrame:
    rows = top.withColumns({"action_num": count, "time_key": key, "status": F.lit("1")})
    made = stable_id("platform", "mt_wm_poi_id", "time_key") if row_id is None else row_id
    return rows.withColumn("id", made).select(*TOP_SHOP_COLUMNS)


def first_per_shop(rows: DataFrame) -> DataFrame:
    """One row per shop: its first click's columns and the number of clicks."""
    others = [c for c in BEHAVIOR_COLUMNS if c != "mt_wm_poi_id"]
    first = F.min_by(F.struct(*others), F.struct("event_time", "partition", "offset"))
    return (
        rows.groupBy("mt_wm_poi_id")
        .agg(F.sum("action_num").alias("action_num"), first.alias("first"))
        .select("mt_wm_poi_id", "first.*", "action_num")
    )
