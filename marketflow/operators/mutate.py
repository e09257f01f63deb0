"""Get, put, update and delete rows of a table by key.

Stored rows are unique per key. Changes may repeat a key; the last one by
``order`` wins. The stored table is the streamed side of every join, so small
changes are broadcast by size and the stored rows are not moved; changes above
Spark's broadcast size shuffle both sides. A key that many changes share is
reduced before the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_change(changes: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One change per key: the last by ``order``, else the greatest row."""
    others = [c for c in changes.columns if c != key]
    lead = [F.col(order).alias("_order")] if order else []
    top = F.max(F.struct(*lead, *others)).alias("top")
    return changes.where(F.col(key).isNotNull()).groupBy(key).agg(top).select(
        key, *(F.col(f"top.{c}").alias(c) for c in others)
    )


def partial_update(stored: DataFrame, changes: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Stored rows with the given fields of their change; keys not stored are ignored.

    A field the change leaves NULL keeps its value, a field the stored table lacks is added;
    ``order`` is a field like the others where it is stored, and not added where it is not.
    """
    return _merged(stored, last_change(changes, key, order), key, order)


def _merged(stored: DataFrame, latest: DataFrame, key: str, order: str | None) -> DataFrame:
    fields = [c for c in latest.columns if c != key and (c != order or c in stored.columns)]
    new = latest.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_new_{c}") for c in fields))
    joined = stored.join(new, F.col(key) == F.col("_key"), "left")
    merged = [
        F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in stored.columns
    ]
    added = [F.col(f"_new_{c}").alias(c) for c in fields if c not in stored.columns]
    return joined.select(*merged, *added)


def upsert(stored: DataFrame, changes: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Partial update of stored keys, and a new row for every other key.

    The keys that are stored already are found from the changes' side: no more of them than changes leave the join.
    """
    latest = last_change(changes, key, order)
    updated = _merged(stored, latest, key, order)
    hit = stored.select(key).join(latest.select(key), key, "left_semi")
    fresh = latest.join(hit, key, "left_anti")
    return updated.unionByName(fresh.select(*(c for c in fresh.columns if c in updated.columns)), allowMissingColumns=True)


def put(stored: DataFrame, rows: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Stored rows with whole rows replaced or added by key."""
    latest = last_change(rows, key, order)
    kept = stored.join(latest.select(key), key, "left_anti")
    return kept.unionByName(latest.select(*(c for c in latest.columns if c in stored.columns)), allowMissingColumns=True)


def delete(stored: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Stored rows whose key is not listed."""
    return stored.join(keys.select(key).distinct(), key, "left_anti")


def get_many(stored: DataFrame, keys: DataFrame | Sequence, key: str) -> DataFrame:
    """Stored rows of the listed keys as JSON documents; keys not stored give no row."""
    if isinstance(keys, DataFrame):
        found = stored.join(keys.select(key).distinct(), key, "left_semi")
    else:
        found = stored.where(F.col(key).isin(list(keys)))
    return found.select(key, F.to_json(F.struct(*stored.columns), {"ignoreNullFields": "false"}).alias("document"))
