"""JSON text and the fields of JSON records.

Records are parsed once, by ``parse_fields``, into the fields a table needs.
Whether a null field is absent or null is looked up in the record's keys, but
only for those rows: the ``when`` around the lookup keeps it from the others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def json_text(value: Column | str, key: str) -> Column:
    """A field of a JSON object as text; NULL if absent, null or no object."""
    return F.get_json_object(_column(value), f"$['{key}']")


def json_dumps(value: Column | str) -> Column:
    """JSON text that keeps null fields."""
    return F.to_json(_column(value), {"ignoreNullFields": "false"})


def json_validate(value: Column | str, *, fail: bool = True) -> Column:
    """Parse JSON text; malformed text raises, or gives NULL if ``fail`` is off."""
    parse = F.parse_json if fail else F.try_parse_json
    return parse(_column(value))


def record_schema(texts: Sequence[str], values: Sequence[str] = ()) -> T.StructType:
    """Fields of a record: ``texts`` as STRING, ``values`` as VARIANT."""
    return T.StructType(
        [T.StructField(key, T.StringType()) for key in texts]
        + [T.StructField(key, T.VariantType()) for key in values]
    )


def parse_fields(
    record: Column | str, texts: Sequence[str], values: Sequence[str] = ()
) -> Column:
    """The record's fields as a struct: ``texts`` as STRING, ``values`` as VARIANT.

    Malformed records fail the job. A text field that is absent or null is
    NULL, one that is no JSON string is its JSON text. An absent value is NULL,
    a null one a variant null.
    """
    return F.from_json(_column(record), record_schema(texts, values), {"mode": "FAILFAST"})


def missing_keys(record: Column | str, keys: Sequence[str]) -> Column:
    present = F.json_object_keys(_column(record))
    return F.array_except(F.array(*[F.lit(key) for key in keys]), present)


Missing = Callable[[Column | str, Sequence[str]], Column]


def lacks(
    record: Column | str, fields: Column, keys: Sequence[str], have: Missing = missing_keys
) -> Column:
    """Message about the required text keys that the record lacks; NULL if it has them all."""
    missing = have(record, keys)
    message = F.concat(F.lit("record without required key "), F.array_join(missing, ", "))
    any_null = reduce(or_, [fields.getField(key).isNull() for key in keys])
    return F.when(any_null, F.when(F.size(missing) > 0, message))


def integer_field(fields: Column, key: str, type_: T.DataType) -> Column:
    """A text field assigned to an integer column; NULL if it is no whole number."""
    return fields.getField(key).try_cast(type_)


def ill_typed(fields: Column, key: str, type_: T.DataType) -> Column:
    """Message about a text field that an integer column cannot take; else NULL."""
    text = fields.getField(key)
    message = F.concat(F.lit(f"key '{key}' holds no {type_.simpleString()}: "), text)
    return F.when(text.isNotNull() & integer_field(fields, key, type_).isNull(), message)


def optional_text_field(
    record: Column | str, fields: Column, key: str, default: str = "", missing: Missing = missing_keys
) -> Column:
    """The field, or the default when the record lacks the key; null stays NULL."""
    text = fields.getField(key)
    absent = F.size(missing(record, [key])) > 0
    return F.when(text.isNotNull(), text).otherwise(F.when(absent, F.lit(default)))


def optional_value_field(
    fields: Column, key: str, default: str = "{}", as_text: bool = True
) -> Column:
    """The field as JSON text, or the default; null is the text ``null``. Else as VARIANT."""
    value = fields.getField(key)
    if not as_text:
        return F.coalesce(value, F.parse_json(F.lit(default)))
    return F.when(value.isNull(), F.lit(default)).otherwise(json_dumps(value))
