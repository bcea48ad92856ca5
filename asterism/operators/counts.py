"""Counts by a foreign key, kept up to date by signed changes instead of a recount."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterism.operators.dml import distinct_keys


def count_changes(before: DataFrame | None, batch: DataFrame, on: str, group: str) -> DataFrame:
    """(group, change): what an upsert of ``batch`` over ``before`` does to the rows per group.

    ``batch`` has one row per key ``on``, as an upsert leaves it. A new row
    counts 1 for its group; a known one counts -1 for the group it had and 1
    for the one it has, so a row that stays where it was changes nothing. NULL
    groups are not counted. Of ``before`` only the rows that the batch meets
    are read beyond their key, and only ``on`` and ``group`` of them.
    """
    added = batch.select(F.col(group).alias(group), F.lit(1).alias("change"))
    changes = added
    if before is not None:
        met = before.select(on, group).join(distinct_keys(batch, on), on, "left_semi")
        changes = added.unionByName(met.select(group, F.lit(-1).alias("change")))
    changes = changes.filter(F.col(group).isNotNull()).groupBy(group).agg(F.sum("change").alias("change"))
    return changes.filter("change <> 0")


def apply_changes(counts: DataFrame, changes: Sequence[DataFrame], group: str, count: str) -> DataFrame:
    """``counts`` after the changes of one or more loads; groups that end up empty go."""
    kind = counts.schema[count].dataType
    rows = counts.select(group, F.col(count).cast("bigint").alias("change"))
    for one in changes:
        rows = rows.unionByName(one.select(group, F.col("change").cast("bigint").alias("change")))
    total = rows.groupBy(group).agg(F.sum("change").alias("change")).filter("change <> 0")
    return total.select(group, F.col("change").cast(kind).alias(count))
