"""Change messages: filter and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import cdc
from ..session import configure, scratch
from ..sinks.topic import topic_writer
from ..sinks.tables import read_table
from ..streaming import runs
from . import fixtures as X

TABLES = ("click", "purchase")


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.change_messages(X.load(configure(spark), sf_dir, "events"))


def cdc_filter(spark, sf_dir):
    return cdc.changes_of(_changes(spark, sf_dir), TABLES).select("table", "value")


def cdc_route(spark, sf_dir):
    """Change messages streamed to a topic per table."""
    root = scratch(spark, "route")
    events = X.load_stream(configure(spark), sf_dir, "events")
    routed = cdc.route(X.change_messages(events), TABLES)
    runs.drain(topic_writer(routed, f"{root}/checkpoint", path=f"{root}/topics"))
    return read_table(spark, f"{root}/topics", "key string, value string, topic string", "json").select("topic", "key", "value")


_KEPT = """(SELECT event_type AS "table", CAST(user_id AS VARCHAR) AS key,
  '{"table":"' || event_type || '","data":{"event_id":' || event_id || ',"user_id":' || user_id || '}}' AS value
  FROM events WHERE value >= 10 AND event_type IN ('click', 'purchase'))"""

QUERIES = {"cdc_filter": cdc_filter, "cdc_route": cdc_route}
ORACLES = {
    "cdc_filter": f'SELECT "table", value FROM {_KEPT}',
    "cdc_route": f"""SELECT 'ods_' || "table" AS topic, key, value FROM {_KEPT}""",
}
