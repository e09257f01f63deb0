"""Time texts, partition times and bucket names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats of the input and of the partition columns.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
PART_FORMATS = {"dt": "yyyy-MM-dd", "hr": "HH", "mm": "mm"}
MINUTE_PATTERN = "$dt $hr:$mm:00"
HOUR_PATTERN = "$dt $hr:00:00"


def parse_time(text: Column, fmt: str = TIME_FORMAT) -> Column:
    """Timestamp in the session zone, NULL where the text does not fit."""
    return F.try_to_timestamp(text, F.lit(fmt))


def reformat(text: Column, fmt: str) -> Column:
    return F.date_format(parse_time(text), fmt)


def date_parts(text: Column) -> dict[str, Column]:
    """The partition columns ``dt``, ``hr`` and ``mm`` of a time text."""
    return {name: reformat(text, fmt) for name, fmt in PART_FORMATS.items()}


def epoch_millis(text: Column) -> Column:
    return F.unix_millis(parse_time(text))


def shift_hours(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(hours=F.lit(hours))


def event_time(text: Column, default: Column | None = None, shift: int = 0) -> Column:
    """Event time of a record: its time text, else ``default``; moved by ``shift`` hours."""
    ts = parse_time(text)
    if default is not None:
        ts = F.coalesce(ts, default)
    return shift_hours(ts, shift) if shift else ts


def now_text(fmt: str = TIME_FORMAT, now: str | None = None) -> Column:
    """Current time as text; ``now`` (in ``TIME_FORMAT``) fixes it for replays and tests."""
    ts = F.current_timestamp() if now is None else F.to_timestamp(F.lit(now), TIME_FORMAT)
    return F.date_format(ts, fmt)


def bucket_date(ts: Column, zone: str = "UTC", fmt: str = DATE_FORMAT) -> Column:
    """Name of the day bucket an instant belongs to in ``zone`` (session zone UTC)."""
    return F.date_format(F.from_utc_timestamp(ts, zone), fmt)


def partition_text(values: Mapping[str, Column], pattern: str = MINUTE_PATTERN) -> Column:
    """Fill ``$name`` places of a pattern; longer names first, so ``$hr`` leaves ``$hr2`` alone."""
    text = F.lit(pattern)
    for name in sorted(values, key=len, reverse=True):
        text = F.replace(text, F.lit(f"${name}"), values[name])
    return text


def lenient_timestamp(text: Column) -> Column:
    """``y-m-d [h:m:s[.fraction]]`` where fields out of range roll over.

    Month 13 is January of the next year, minute 61 the first minute of the next
    hour, a date alone means midnight; a text of another shape gives NULL. The
    text and its parts are bound by ``transform``, so both are made once per row.
    """
    shape = r"^\d{1,10}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,9})?)?$"

    def of_parts(parts: Column) -> Column:
        whole = [F.coalesce(F.get(parts, F.lit(i)).try_cast("int"), F.lit(0)) for i in range(5)]
        seconds = F.coalesce(F.get(parts, F.lit(5)).try_cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))
        start = F.try_make_timestamp(whole[0], F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
        months = F.make_ym_interval(F.lit(0), whole[1] - 1)
        return start + months + F.make_dt_interval(whole[2] - 1, whole[3], whole[4], seconds)

    def of_text(t: Column) -> Column:
        return F.when(t.rlike(shape), F.get(F.transform(F.array(F.split(t, "[-: ]")), of_parts), F.lit(0)))

    return F.get(F.transform(F.array(text), of_text), F.lit(0))


def partition_time(values: Mapping[str, Column], pattern: str = MINUTE_PATTERN, shift: int = -8) -> Column:
    """Time a partition stands for: its values through the pattern, moved by ``shift`` hours."""
    return shift_hours(lenient_timestamp(partition_text(values, pattern)), shift)
