"""Change messages: filter by source table and route to a topic per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json_fields import is_object, parse_objects

# Fixed value: prefix of the target topics.
TOPIC_PREFIX = "ods_"


def changes_of(messages: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Messages of the listed tables with their ``table``; no object or no table name means dropped."""
    kept = [c for c in messages.columns if c != "table"]
    parsed = parse_objects(messages, ["table"], keep=kept)
    return parsed.where(is_object() & F.col("table").isin(*tables)).select(*kept, "table")


def route(messages: DataFrame, tables: Sequence[str], prefix: str = TOPIC_PREFIX) -> DataFrame:
    """The kept messages unchanged, each with its target ``topic``. No shuffle."""
    routed = changes_of(messages, tables).withColumn("topic", F.concat(F.lit(prefix), "table"))
    return routed.select("topic", "key", "value") if "key" in messages.columns else routed.select("topic", "value")
