from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def body_length(value: Column | str) -> Column:
    """Number of characters; NULL for NULL."""
    return F.length(_column(value))


def word_count(value: Column | str) -> Column:
    """Pieces between single spaces; empty pieces count, NULL for an empty text.

    Counting the spaces instead of building the array of pieces keeps long
    texts from being copied. A space is one byte in UTF-8 and part of no other
    character, so the count can be taken on bytes.
    """
    text = _column(value)
    spaces = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(F.octet_length(text) > 0, spaces + 1)
