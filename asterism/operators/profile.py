"""Profiles of loads: counts and sketches per day and column, which merge over days.

A profile row is a few KB whatever the load's size. Distinct values are
estimated by HyperLogLog, quantiles of numbers by KLL; rows and NULLs are exact.
Days are merged from their profiles, without the loads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_K = 12  # 2**12 buckets: a relative standard error of 0.016
DISTINCT_ERROR = 0.05  # three standard errors
KLL_K = 200  # ranks within 0.0165, with a probability of 0.99
RANK_ERROR = 0.0165


def load_profile(df: DataFrame, day: str, columns: Sequence[str]) -> DataFrame:
    """(day, column, n_rows, n_nulls, values, quantiles): one pass over the load.

    ``values`` and ``quantiles`` are sketches; the latter is NULL for columns
    that are no numbers. Numbers are taken as doubles; NaN counts as no value.
    """
    made, described = [F.count(F.lit(1)).alias("n_rows")], []
    for i, name in enumerate(columns):
        kind, column = df.schema[name].dataType, F.col(f"`{name}`")
        number = isinstance(kind, T.NumericType)
        made += [
            F.count_if(column.isNull()).alias(f"nulls{i}"),
            F.hll_sketch_agg(column.cast("string"), LG_K).alias(f"values{i}"),
        ]
        quantiles = F.lit(None).cast("binary")
        if number:
            value = column.cast("double")
            value = F.when(~F.isnan(value), value)
            made.append(F.kll_sketch_agg_double(value, KLL_K).alias(f"quantiles{i}"))
            quantiles = F.col(f"quantiles{i}")
        described.append(
            F.struct(
                F.lit(name).alias("column"), F.col("n_rows"), F.col(f"nulls{i}").alias("n_nulls"),
                F.col(f"values{i}").alias("values"), quantiles.alias("quantiles"),
            )
        )
    return df.groupBy(day).agg(*made).select(day, F.explode(F.array(*described)).alias("x")).select(day, "x.*")


def merged(profiles: DataFrame, by: Sequence[str] = ("column",)) -> DataFrame:
    """Profiles put together, by column over all their days unless ``by`` says otherwise."""
    return profiles.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.hll_union_agg("values").alias("values"),
        F.kll_merge_agg_double("quantiles", KLL_K).alias("quantiles"),
    )


def n_distinct() -> Column:
    """Estimate from a profile's ``values``."""
    return F.hll_sketch_estimate("values")


def quantile(rank: float) -> Column:
    """Estimate from a profile's ``quantiles``; NULL where no number was seen."""
    some = F.kll_sketch_get_n_double("quantiles") > 0
    return F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(rank))))


def alerts(profiles: DataFrame, day: str, days: int = 7, factor: float = 2.0, nulls: float = 0.1) -> DataFrame:
    """(day, column, reason): days that differ from the ``days`` before them.

    ``rows``: more, or fewer, by ``factor`` than their mean; ``nulls``: a share
    of NULLs further than ``nulls`` from theirs; ``median``: beyond their range of
    medians by more than its width. The first day has nothing to differ from.
    """
    before = Window.partitionBy("column").orderBy(day).rowsBetween(-days, -1)
    share, median = F.col("n_nulls") / F.greatest("n_rows", F.lit(1)), quantile(0.5)
    known = profiles.select(
        day, "column", F.col("n_rows").cast("double").alias("n_rows"), share.alias("share"), median.alias("median")
    )
    seen = known.select(
        "*",
        F.avg("n_rows").over(before).alias("usual"),
        F.avg("share").over(before).alias("usual_share"),
        F.min("median").over(before).alias("low"),
        F.max("median").over(before).alias("high"),
    )
    width = F.col("high") - F.col("low")
    reasons = F.array_compact(
        F.array(
            F.when((F.col("n_rows") > F.col("usual") * factor) | (F.col("n_rows") * factor < F.col("usual")), F.lit("rows")),
            F.when(F.abs(F.col("share") - F.col("usual_share")) > nulls, F.lit("nulls")),
            F.when((F.col("median") > F.col("high") + width) | (F.col("median") < F.col("low") - width), F.lit("median")),
        )
    )
    return seen.select(day, "column", F.explode(reasons).alias("reason"))
