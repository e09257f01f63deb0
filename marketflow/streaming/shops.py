"""The shop stream: event time, delimited lines by day, documents, and a partitioned table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..operators import records as R
from ..operators.behavior import EVENT_DELAY, SHOP_DELAY
from ..schemas import SHOP, SHOP_LINE_COLUMNS, columns
from ..sinks.tables import stored_once, write_batch


NO_TIME = "no_event_time"


def judged_shops(messages: DataFrame, default_time: Column | None = None, need_time: bool = False) -> DataFrame:
    """Shops with ``event_time`` and, for those to set aside, a ``reject_reason``; the text of the message is kept in ``value``."""
    shops = R.typed_records(messages, SHOP, keep=["value"])
    timed = shops.withColumn("event_time", times.event_time(F.col("create_time"), default_time))
    if not need_time:
        return timed
    missing = F.when(F.col("event_time").isNull(), F.lit(NO_TIME))
    return timed.withColumn(R.REASON, F.coalesce(F.col(R.REASON), missing))


def shop_events(messages: DataFrame, default_time: Column | None = None, delay: str | None = SHOP_DELAY) -> DataFrame:
    """Good shops with ``event_time``: their create time, or ``default_time`` where it is missing.

    On a stream the watermark follows the greatest event time at ``delay``.
    """
    timed = R.accepted(judged_shops(messages, default_time)).drop("value")
    return timed.withWatermark("event_time", delay) if delay else timed


def shop_lines(shops: DataFrame, zone: str = "UTC") -> DataFrame:
    """One delimited line per shop, with the day bucket of its event time."""
    dated = shops.withColumn("batch_date", times.bucket_date(F.col("event_time"), zone))
    return R.delimited_line(dated, SHOP_LINE_COLUMNS, keep=["batch_date"])


def shop_documents(shops: DataFrame) -> DataFrame:
    """Shops as JSON text without their NULL fields; rejects of ``judged_shops`` keep the text of their message and the reason."""
    document = R.json_document(shops, columns(SHOP))
    if R.REASON not in shops.columns:
        return shops.select(document.alias("value"))
    return shops.select(F.when(F.col(R.REASON).isNull(), document).otherwise(F.col("value")).alias("value"), R.REASON)


def partitioned_shops(messages: DataFrame, delay: str | None = EVENT_DELAY) -> DataFrame:
    """Shops with ``dt``, ``hr``, ``mm`` of their create time, and the ``reject_reason`` and ``value`` of those to set aside.

    A shop without a readable time has no partition: it is a reject.
    """
    timed = judged_shops(messages, need_time=True)
    timed = timed.withWatermark("event_time", delay) if delay else timed
    parts = times.date_parts(F.col("create_time"))
    return timed.select(*columns(SHOP), *(part.alias(name) for name, part in parts.items()), "event_time", "value", R.REASON)


def write_partitioned_shops(batch: DataFrame, path: str, rejects: str, batch_id: int) -> None:
    """A batch of ``partitioned_shops``: the shops below ``path``, what has no place there below ``rejects``, with its text; no other text is kept."""
    told = batch.drop("event_time").withColumn("value", F.when(F.col(R.REASON).isNotNull(), F.col("value")))
    with stored_once(told) as held:
        write_batch(R.accepted(held).drop("value"), path, batch_id, ("dt", "hr", "mm"))
        write_batch(R.rejected(held).select("value", R.REASON), rejects, batch_id)
