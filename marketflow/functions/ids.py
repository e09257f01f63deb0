"""Row ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(*columns: str | Column) -> Column:
    """32 hex digits that depend on the columns only, so a row can be updated later."""
    return F.md5(F.concat_ws("|", *columns))


def random_id() -> Column:
    """32 random hex digits."""
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))
