"""JSON messages to typed records, arrays to rows, and the rows that fail."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import json_fields as J
from ..functions.times import now_text
from ..schemas import SHOP_KEY, Field

REASON = "reject_reason"
NOT_AN_ARRAY = "not_an_array"


def typed(field: Field, now: str | None = None) -> Column:
    """The column of a record, from the parsed text columns."""
    if field.kind == "now":
        return now_text(now=now).alias(field.name)
    text = F.col(f"`{field.key}`")
    if field.kind == "text":
        return text.alias(field.name)
    read, _, stored = field.kind.partition(">")
    if read.endswith("0"):
        number = J.unboxed(text, read[:-1])
    else:
        number = J.boxed(text, read)
    return (number.cast(stored) if stored else number).alias(field.name)


def _reason(fields: tuple[Field, ...], value: str) -> Column:
    reason = F.when(~J.well_formed(value), F.lit("not_an_object"))
    for f in fields:
        if f.kind not in ("text", "now"):
            read = f.kind.split(">")[0].removesuffix("0")
            reason = reason.when(J.bad_number(F.col(f"`{f.key}`"), read), F.lit(f"bad_number:{f.name}"))
    return reason


def parsed_messages(messages: DataFrame, fields: tuple[Field, ...], require: str | None = SHOP_KEY,
                    keep: Iterable[str] = (), value: str = "value", arrays: Iterable[str] = ()) -> DataFrame:
    """Text columns for the keys of ``fields``, and the elements of ``arrays``, in one parse.

    Objects without the ``require`` key are left out; a key that is present with
    null passes. Text that is no object stays, to be rejected with its reason.
    """
    keys = [*(f.key for f in fields if f.key), *([require] if require else [])]
    parsed = J.parse_objects(messages, keys, value, keep=list(dict.fromkeys([*keep, value])), arrays=arrays)
    return having_key(parsed, require, value) if require else parsed


def having_key(parsed: DataFrame, key: str, value: str = "value") -> DataFrame:
    return parsed.where(_passes(key, value))


def _passes(key: str, value: str) -> Column:
    return ~J.well_formed(value) | J.has_key(key, value, parsed=F.col(f"`{key}`"))


def reason_of(output: str) -> str:
    """The column with an output's own reason: what one output cannot store another may."""
    return f"{REASON}_{output}"


def bad_array_of(key: str) -> str:
    """The column that tells whether the array under ``key`` could not be read."""
    return f"bad_array_{key}"


def shared_messages(messages: DataFrame, outputs: Mapping[str, tuple[Field, ...]], arrays: Iterable[str],
                    require: str = SHOP_KEY, value: str = "value") -> DataFrame:
    """One parse for a record, in each of its ``outputs``, and the arrays beside it.

    ``has_key`` tells whether the message itself counts as a record; the arrays
    count either way, and are NULL where the text is no object.
    """
    arrays = list(arrays)
    fields = tuple(f for output in outputs.values() for f in output)
    parsed = parsed_messages(messages, fields, None, [], value, arrays)
    told = parsed.withColumns({
        **({"has_key": _passes(require, value)} if outputs else {}),
        **{bad_array_of(a): J.bad_array(a, value) for a in arrays},
        **{a: J.elements(a, value) for a in arrays},
    })
    return judged(told, outputs, value, [bad_array_of(a) for a in arrays])


def judged(parsed: DataFrame, outputs: Mapping[str, tuple[Field, ...]], value: str = "value", faults: Iterable[str] = ()) -> DataFrame:
    """Parsed messages with a reason per output; the raw text is kept for rejects only.

    ``faults`` are flags that also make a reject. Worth it before rows are held
    for several sinks: the text is most of their size.
    """
    first: dict[tuple, str] = {}  # outputs that read the same numbers have the same reason, found once
    same = {reason_of(name): first.setdefault(tuple(f for f in fields if f.kind not in ("text", "now")), reason_of(name)) for name, fields in outputs.items()}
    others = [c for c in parsed.columns if c not in (value, J.CORRUPT)]
    told = parsed.withColumns({reason_of(name): _reason(fields, value) for name, fields in outputs.items() if same[reason_of(name)] == reason_of(name)})
    reasons = [F.col(own).alias(name) for name, own in same.items()]
    bad = F.lit(False)
    for test in (*(F.col(r).isNotNull() for r in first.values()), *(F.col(f"`{f}`") for f in faults)):
        bad = bad | test
    return told.select(*(F.col(f"`{c}`") for c in others), *reasons, F.when(bad, F.col(value)).alias(value))


def typed_rows(parsed: DataFrame, fields: tuple[Field, ...], keep: Iterable[str] = (), value: str = "value",
               now: str | None = None, output: str | None = None) -> DataFrame:
    """Typed columns of parsed messages, with a ``reject_reason`` (NULL for good rows).

    Text that is no object, and a number field with other text in it, is a reason.
    ``output`` names the judgement of messages that ``judged`` has seen.
    """
    reason = F.col(reason_of(output)) if output else _reason(fields, value)
    return parsed.select(*keep, *(typed(f, now) for f in fields), reason.alias(REASON))


def typed_records(messages: DataFrame, fields: tuple[Field, ...], require: str | None = SHOP_KEY, keep: Iterable[str] = (),
                  value: str = "value", now: str | None = None) -> DataFrame:
    """Messages to typed rows with their ``reject_reason``."""
    keep = list(keep)
    return typed_rows(parsed_messages(messages, fields, require, keep, value), fields, keep, value, now)


def accepted(records: DataFrame) -> DataFrame:
    return records.where(F.col(REASON).isNull()).drop(REASON)


def rejected(records: DataFrame) -> DataFrame:
    return records.where(F.col(REASON).isNotNull())


def records_of(messages: DataFrame, fields: tuple[Field, ...], **options) -> DataFrame:
    """Good records only."""
    return accepted(typed_records(messages, fields, **options))


def with_key(messages: DataFrame, key: str, value: str = "value") -> DataFrame:
    """Messages whose object carries ``key``, even with null."""
    parsed = J.parse_objects(messages, [key], value, keep=messages.columns)
    return parsed.where(J.is_object(value) & J.has_key(key, value, parsed=F.col(f"`{key}`"))).select(messages.columns)


def with_value(messages: DataFrame, key: str, value: str = "value") -> DataFrame:
    """Messages whose object carries ``key`` with a value other than null."""
    parsed = J.parse_objects(messages, [key], value, keep=messages.columns)
    return parsed.where(J.is_object(value) & F.col(f"`{key}`").isNotNull()).select(messages.columns)


def explode_property(messages: DataFrame, key: str, keep: Iterable[str] = (), value: str = "value") -> DataFrame:
    """One row per element of the array under ``key``, the element as JSON text in ``value``.

    The enclosing object is not carried; an empty, missing or null array gives no row.
    """
    keep = list(keep)
    parsed = J.parse_objects(messages, [], value, keep=list(dict.fromkeys([*keep, value])), arrays=[key])
    return explode_parsed(parsed, key, keep, value)


def explode_parsed(parsed: DataFrame, key: str, keep: Iterable[str] = (), value: str = "value") -> DataFrame:
    """The same for messages already parsed with ``key`` among the arrays."""
    return parsed.select(*keep, F.explode(J.elements(key, value)).alias("value"))


def explode_message(messages: DataFrame, keep: Iterable[str] = (), value: str = "value") -> DataFrame:
    """One row per element of a message that is itself a JSON array."""
    return messages.select(*keep, F.explode(J.array_elements(F.col(value))).alias("value"))


def element_records(elements: DataFrame, fields: tuple[Field, ...], **options) -> DataFrame:
    """Good records of exploded elements; every object counts, whatever keys it has."""
    return records_of(elements, fields, require=None, **options)


def ignore_parse_errors(messages: DataFrame, fields: tuple[Field, ...], value: str = "value") -> DataFrame:
    """Messages read as a table: a missing field is NULL, text that does not parse is skipped."""
    parsed = J.parse_objects(messages, [f.key for f in fields], value, keep=[value])
    return parsed.where(J.is_object(value)).select(*(typed(f) for f in fields))


def parent_children(records: DataFrame, parent: tuple[Field, ...], child: tuple[Field, ...], array_key: str,
                    value: str = "value") -> DataFrame:
    """Parent columns beside the columns of each child in ``array_key``."""
    parsed = J.parse_objects(records, [f.key for f in parent], value, keep=[value], arrays=[array_key])
    rows = parsed.select(*(typed(f) for f in parent), F.explode(J.elements(array_key, value)).alias("value"))
    names = [f.name for f in parent]
    children = J.parse_objects(rows, [f.key for f in child], "value", keep=[*names, "value"])
    return children.where(J.is_object("value")).select(*names, *(typed(f) for f in child))


def delimited_line(df: DataFrame, columns: Iterable[str], keep: Iterable[str] = (), separator: str = "\t") -> DataFrame:
    """The columns in the given order as one text line; NULL is written ``null``."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
    return df.select(F.concat_ws(separator, *texts).alias("value"), *keep)


def json_document(df: DataFrame, columns: Iterable[str] | None = None, nulls: bool = False) -> Column:
    """The row as JSON text, without its NULL fields unless ``nulls``."""
    names = list(columns or df.columns)
    return F.to_json(F.struct(*names), {"ignoreNullFields": str(not nulls).lower()})
