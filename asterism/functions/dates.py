from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_WIDTH = 9  # month and day names come blank-padded to this width


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def date_key(value: Column | str) -> Column:
    """20240131 for 2024-01-31, from a date or a timestamp without zone."""
    day = _column(value).cast("date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_name(value: Column | str) -> Column:
    return F.rpad(F.date_format(_column(value), "MMMM"), NAME_WIDTH, " ")


def day_name(value: Column | str) -> Column:
    return F.rpad(F.date_format(_column(value), "EEEE"), NAME_WIDTH, " ")


def day_of_week(value: Column | str) -> Column:
    """Sunday is 0, Saturday is 6."""
    return F.dayofweek(_column(value)) - 1


def is_weekend(value: Column | str) -> Column:
    return F.dayofweek(_column(value)).isin(1, 7)
