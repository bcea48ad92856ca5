"""JSON values kept as VARIANT: parsed once, read by path, compared by value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

STRING_OR_REST = r'"(?:[^"\\]|\\.)*+"|[^"]+'
BEHIND = r"(?=[,}\]]|$)"


def _path(key: str) -> str:
    return f"$['{key}']"


def variant_value(record: Column, key: str) -> Column:
    """The value under a key: NULL if it is absent, a variant null if it is null."""
    return F.variant_get(record, _path(key), "variant")


def variant_text(record: Column, key: str) -> Column:
    """The value under a key as text, its JSON text if it is no string; NULL if absent or null."""
    return F.variant_get(record, _path(key), "string")


def absent(record: Column | str, keys: Sequence[str]) -> Column:
    """Which of the keys a record lacks."""
    record = F.col(record) if isinstance(record, str) else record
    return F.array_compact(F.array(*[F.when(variant_value(record, key).isNull(), F.lit(key)) for key in keys]))


def canonical(value: Column) -> Column:
    """A text that two JSON values share if they are equal.

    As for JSONB, neither blanks nor the order of keys count, the last of
    repeated keys does, and numbers are equal that differ in trailing zeros.
    Numbers beyond 38 digits are doubles, equal as those.
    """
    parts = F.regexp_extract_all(F.to_json(value), F.lit(STRING_OR_REST), F.lit(0))
    shorter = lambda text: F.regexp_replace(
        F.regexp_replace(text, r"(\.[0-9]*?)0+" + BEHIND, "$1"), r"\." + BEHIND, ""
    )
    plain = F.transform(parts, lambda t: F.when(F.startswith(t, F.lit('"')), t).otherwise(shorter(t)))
    return F.array_join(plain, "")


def same_value(one: Column, other: Column) -> Column:
    """Whether two JSON values are equal; NULL if one of them is NULL."""
    return canonical(one) == canonical(other)
