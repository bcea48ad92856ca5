from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bounds of the calendar.
CALENDAR_START = date(2020, 1, 1)
CALENDAR_END = date(2025, 12, 31)


def date_series(bounds: DataFrame, start: Column | str, end: Column | str) -> DataFrame:
    """One row per day from ``start`` to ``end`` of each row, both included."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    days = F.sequence(start.cast("date"), end.cast("date"), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("d"))


def calendar_days(
    spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END
) -> DataFrame:
    return date_series(spark.range(1), F.lit(start), F.lit(end))
