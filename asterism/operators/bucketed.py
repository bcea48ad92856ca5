"""MERGE into a table that stays bucketed by its key, so that it is never shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asterism.operators.checks import required
from asterism.operators.dml import _enforce_sole, materialize


def write_bucketed(df: DataFrame, entry: str, location: str, on: str, buckets: int) -> None:
    """Write an external table with one sorted file for each bucket of ``on``."""
    dealt = df.repartition(buckets, on)
    dealt.write.bucketBy(buckets, on).sortBy(on).option("path", location).saveAsTable(entry)


def buckets_of(spark: SparkSession, entry: str, on: str) -> int:
    """Number of buckets of a table that is bucketed by ``on`` alone."""
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {entry}").collect()}
    if described.get("Bucket Columns") != f"[`{on}`]":
        raise ValueError(f"{entry} is not bucketed by {on}")
    return int(described["Num Buckets"])


def merged(
    target: DataFrame,
    batch: DataFrame,
    on: str,
    *,
    update: Sequence[str],
    stamp: Mapping[str, Column] | None = None,
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The target after the batch: matched rows updated, others inserted, the rest kept.

    One full outer join on the key gives all three at once, bucket by bucket,
    and stays dealt by the key. Keys are unique on both sides, so there is no
    hot one; a batch that repeats a key fails, and so does a NULL key.
    """
    batch = required(batch, F.col(on).isNotNull(), F.lit(f"null value in key column '{on}'"))
    batch = materialize(batch.select(on, *update))
    _enforce_sole(batch, on)
    stamp, defaults = dict(stamp or {}), dict(defaults or {})
    old = target.select(F.col(on).alias("__key"), F.struct(*target.columns).alias("__old"))
    new = batch.select(F.col(on).alias("__on"), F.struct(*update).alias("__new"))
    joined = old.join(new, F.col("__key") == F.col("__on"), "full")
    known, hit = F.col("__key").isNotNull(), F.col("__on").isNotNull()

    def value(name: str) -> Column:
        kind, was = target.schema[name].dataType, F.col(f"__old.{name}")
        if name == on:
            return F.coalesce("__key", "__on").cast(kind).alias(name)
        fresh = F.col(f"__new.{name}") if name in update else defaults.get(name, F.lit(None))
        changed = F.col(f"__new.{name}") if name in update else stamp.get(name, was)
        kept = F.when(hit, changed.cast(kind)).otherwise(was)
        return F.when(known, kept).otherwise(fresh.cast(kind)).alias(name)

    return joined.select(*[value(name) for name in target.columns])


def merge_bucketed(
    spark: SparkSession, entry: str, batch: DataFrame, on: str, into: str, location: str, **options
) -> None:
    """MERGE ``batch`` into the bucketed table ``entry`` and write the outcome as ``into``.

    The batch is dealt to the target's buckets; each task reads one bucket of
    the target, merges it and writes that bucket, so no target row is shuffled
    or, as the files are sorted, sorted again. ``options`` are those of ``merged``.
    """
    buckets = buckets_of(spark, entry, on)
    key, value = "spark.sql.shuffle.partitions", str(buckets)
    before = {name: spark.conf.get(name) for name in (key, "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set(key, value)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        rows = merged(spark.table(entry), batch, on, **options)
        rows.write.bucketBy(buckets, on).sortBy(on).option("path", location).saveAsTable(into)
    finally:
        for name, old in before.items():
            spark.conf.set(name, old)
