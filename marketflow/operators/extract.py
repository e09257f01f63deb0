"""Shops, items and their relation out of recorded responses."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.times import now_text
from ..schemas import RECORD_ITEM, RECORD_SHOP, columns
from .records import element_records, explode_property, parent_children, records_of


def shop_catalog(records: DataFrame, now: str | None = None) -> dict[str, DataFrame]:
    """Distinct ``shop``, ``item`` and ``relation`` rows of the ``response`` texts.

    Duplicates are dropped in every task before the shuffle. A response without
    items still names its shop. Each result parses only the fields it needs.
    """
    created = now_text(now=now).alias("create_time")
    shop = records_of(records, RECORD_SHOP, require=None, value="response")
    item = element_records(explode_property(records, "itemList", value="response"), RECORD_ITEM)
    relation = parent_children(records, RECORD_SHOP, RECORD_ITEM, "itemList", value="response")
    found = {"shop": shop, "item": item, "relation": relation}
    names = {"shop": columns(RECORD_SHOP), "item": columns(RECORD_ITEM), "relation": columns(RECORD_SHOP + RECORD_ITEM)}
    return {name: df.select(*names[name]).distinct().select(*names[name], created) for name, df in found.items()}
