"""Reading JSON objects whose fields have irregular types.

Every leaf is read as text and cast afterwards, so ``"12"`` and ``12`` give the
same number, and a nested value read as text is its raw JSON.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"


def parse_objects(df: DataFrame, keys: Iterable[str], value: str = "value", keep: Iterable[str] = (),
                  arrays: Iterable[str] = ()) -> DataFrame:
    """Add one text column per key, plus ``_corrupt_record`` (NULL when the text parsed).

    A key in ``arrays`` becomes a column of its elements, each as JSON text. The
    struct is spread with ``inline`` and not with a projection: a projection would
    be merged into later filters and parse the text once per use.
    """
    fields = [*(f"`{k}` string" for k in dict.fromkeys(keys)), *(f"`{k}` array<string>" for k in arrays)]
    schema = ", ".join([*fields, f"`{CORRUPT}` string"])
    parsed = F.from_json(F.col(value), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return df.select(*keep, F.inline(F.array(parsed)))


def is_object(value: str = "value") -> Column:
    """True where the parsed text was a JSON object (not blank, malformed, or an array).

    One CASE and not a conjunction: the test on the raw text would be moved below the parse.
    """
    return F.when(F.col(CORRUPT).isNull(), F.coalesce(F.trim(F.col(value)) != "", F.lit(False))).otherwise(False)


def well_formed(value: str = "value") -> Column:
    """``is_object`` for a parse with arrays: a field of an unexpected type does not spoil its object."""
    return F.when(F.col(CORRUPT).isNull(), is_object(value)).otherwise(F.json_object_keys(F.col(value)).isNotNull())


def elements(key: str, value: str = "value") -> Column:
    """The elements of a parsed array; also of an array that was sent as text."""
    again = F.from_json(F.get_json_object(F.col(value), f"$.{key}"), "array<string>")
    return F.when(F.col(CORRUPT).isNull(), F.col(f"`{key}`")).when(F.json_object_keys(F.col(value)).isNotNull(), again)


def bad_array(key: str, value: str = "value") -> Column:
    """True where a parsed object carries something under ``key`` that yields no array: a cut text, a number, an object."""
    given = F.json_object_keys(F.col(value)).isNotNull() & F.get_json_object(F.col(value), f"$.{key}").isNotNull()
    return F.when(F.col(CORRUPT).isNull(), False).otherwise(F.coalesce(given & elements(key, value).isNull(), F.lit(False)))


def has_key(key: str, value: str = "value", parsed: Column | None = None) -> Column:
    """True where the object carries ``key``, also when its value is null.

    With ``parsed`` (the field as text) the key list is only read where the
    field is null.
    """
    in_keys = F.coalesce(F.array_contains(F.json_object_keys(F.col(value)), key), F.lit(False))
    return in_keys if parsed is None else F.when(parsed.isNotNull(), True).otherwise(in_keys)


def value_not_null(key: str, value: str = "value") -> Column:
    """True where ``key`` is present with a value other than null."""
    return F.get_json_object(F.col(value), f"$.{key}").isNotNull()


def array_elements(text: Column) -> Column:
    """The elements of a JSON array, each as JSON text (objects and quoted objects alike)."""
    return F.from_json(text, "array<string>")


def boxed(text: Column, type_name: str) -> Column:
    """Number or NULL. Commas are ignored, a fraction in an integer field is cut off."""
    plain = F.replace(text, F.lit(","), F.lit(""))
    readings = [text.try_cast(type_name), plain.try_cast(type_name)]
    if type_name != "double":
        readings.append(plain.try_cast("double").try_cast(type_name))
    return F.coalesce(*readings)


def unboxed(text: Column, type_name: str) -> Column:
    """Number, with 0 for a missing or null field."""
    return F.coalesce(boxed(text, type_name), F.lit(0).cast(type_name))


def bad_number(text: Column, type_name: str) -> Column:
    """True where a text is given that is no number."""
    unread = text.isNotNull() & boxed(text, type_name).isNull()  # the rare case first
    return F.coalesce(unread & ~text.isin("", "null", "NULL"), F.lit(False))
