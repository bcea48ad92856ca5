"""Upserts, insert-or-ignore and MERGE as DataFrame rewrites of the target.

Every write is two joins on the key: the target rows look up their new values
(left join), the batch rows look for absence in the target (left anti join).
Unlike one full outer join, both let Spark broadcast a batch that proves small,
so that a large target is not shuffled, and both let AQE split a hot key.
On a fresh target (``None``) neither join is needed. AQE splits a hot key only
if both sides come straight from a shuffle: a side that was just grouped by the
key shares that shuffle, so where the other side's key may repeat, the grouped
one is written first (``materialize``) or grouped otherwise (``distinct_keys``).

Presence of the struct of new values, never ``coalesce``, decides what a row
takes: a NULL in the batch overwrites.

A write that has to fail does so whatever is read of its result: NULL keys meet
a row filter, repeated keys are looked for before anything is joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterism.operators.checks import ConstraintViolation, required
from asterism.operators.keys import highest, number_rows
from asterism.session import scratch_path


def _with_key(df: DataFrame, name: str) -> DataFrame:
    return required(
        df, F.col(name).isNotNull(), F.lit(f"null value in key column '{name}'")
    )


def _enforce_sole(batch: DataFrame, on: str) -> None:
    """Fail on a key that occurs more than once; reads the key column only."""
    repeated = batch.groupBy(on).agg(F.count("*").alias("n")).filter("n > 1").first()
    if repeated is not None:
        raise ConstraintViolation(f"batch repeats {on} = {repeated[on]}")


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back."""
    path = scratch_path(df.sparkSession, "batch")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The key column with repeats reduced to at most one per task.

    For the far side of a semi or anti join, which few repeats do not harm but
    a key that is most of the rows would. It leaves the rows partitioned by
    more than the key, so that the join shuffles them anew.
    """
    return df.select(key, F.spark_partition_id().alias("__task")).distinct().select(key)


def _first_per_key(batch: DataFrame, on: str, order: Sequence[Column]) -> DataFrame:
    # Spark keeps each task's own first row per key before the one shuffle, so
    # a key that fills the batch arrives as one row per task.
    ranked = Window.partitionBy(on).orderBy(*order)
    return (
        batch.withColumn("__rank", F.row_number().over(ranked))
        .filter("__rank = 1")
        .drop("__rank")
    )


def last_per_key(batch: DataFrame, on: str, order: str | Column) -> DataFrame:
    """The last row per key, whole."""
    order = F.col(order) if isinstance(order, str) else order
    return _first_per_key(batch, on, [order.desc()])


def one_per_key(batch: DataFrame, on: str) -> DataFrame:
    """Any one row per key; the choice depends on the rows only."""
    rest = [F.col(name) for name in batch.columns if name != on]
    return _first_per_key(batch, on, rest) if rest else batch.distinct()


def with_defaults(
    rows: DataFrame, schema: T.StructType, defaults: Mapping[str, Column] | None = None
) -> DataFrame:
    """Insert with a column list: omitted columns take their default, else NULL."""
    given, defaults = set(rows.columns), defaults or {}

    def value(field: T.StructField) -> Column:
        if field.name in given:
            column = F.col(field.name)
        else:
            column = defaults.get(field.name, F.lit(None))
        return column.cast(field.dataType).alias(field.name)

    return rows.select(*[value(field) for field in schema.fields])


def merge(
    target: DataFrame | None,
    batch: DataFrame,
    on: str,
    *,
    update: Sequence[str] = (),
    stamp: Mapping[str, Column] | None = None,
    defaults: Mapping[str, Column] | None = None,
    schema: T.StructType | None = None,
    serial: str | None = None,
    unique: bool = False,
    unique_target: bool = False,
) -> DataFrame:
    """MERGE: matched rows are updated, the others inserted, target-only rows kept.

    ``update`` columns are taken from the batch and ``stamp`` columns set to
    their expression; all others keep the target's value. Two batch rows for a
    matched key fail; for an unmatched key both are inserted. ``unique`` states
    that the batch was already reduced to one row per key, ``unique_target``
    that ``on`` is a key of the target: otherwise the target's keys are reduced
    before they are shuffled, as one of them may be most of it. ``serial`` names a
    surrogate key that inserted rows receive after the highest one in use, in
    the order of ``on`` if that is unique: then only the keys are written and
    ordered, and the numbers join back on them.

    Without ``unique`` the batch rows that match, and no others, are written
    and searched for repeated keys before the joins. With it the caller answers
    for the batch: a key repeated all the same would repeat target rows.

    With a target the batch is read more than once; a batch that is costly to
    compute should be written first (``materialize``).
    """
    schema = schema or target.schema

    fresh = batch
    if target is not None:
        known = target.select(on) if unique_target else distinct_keys(target, on)
        fresh = batch.join(known, on, "left_anti")
    if serial:
        key_type, start = schema[serial].dataType.simpleString(), highest(target, serial)
        if unique:
            fresh = _with_key(fresh, on)
            numbers = number_rows(fresh.select(on), serial, [on], start, key_type)
            fresh = fresh.join(numbers, on)
        else:
            fresh = number_rows(fresh, serial, (), start, key_type)
    fresh = _with_key(with_defaults(fresh, schema, defaults), on)
    if target is None:
        return fresh

    stamp = dict(stamp or {})
    if not update and not stamp:
        return target.select(*schema.names).unionByName(fresh)
    new = F.struct(F.lit(True).alias("hit"), *update).alias("__new")
    matched = batch
    if not unique:
        matched = materialize(batch.select(on, *update).join(known, on, "left_semi"))
        _enforce_sole(matched, on)
    found = matched.select(F.col(on).alias("__on"), new)
    joined = target.join(found, F.col(on) == F.col("__on"), "left")
    hit = F.col("__new").isNotNull()

    def value(field: T.StructField) -> Column:
        name, old = field.name, F.col(field.name)
        if name in stamp:
            column = F.when(hit, stamp[name].cast(field.dataType)).otherwise(old)
        elif name in update:
            column = F.when(hit, F.col(f"__new.{name}").cast(field.dataType)).otherwise(old)
        else:
            column = old
        return column.alias(name)

    return joined.select(*[value(field) for field in schema.fields]).unionByName(fresh)


def upsert_sequential(
    target: DataFrame | None,
    batch: DataFrame,
    on: str,
    order: str | Column,
    *,
    stamp: Mapping[str, Column] | None = None,
    defaults: Mapping[str, Column] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Row-by-row upsert in payload order: the last row per key replaces all columns.

    ``order`` has to be non-null and unique per key. With a target, the last
    rows are written to scratch, as both joins read them.
    """
    schema = schema or target.schema
    batch = last_per_key(batch, on, order)
    if target is not None:
        batch = materialize(batch.drop(*set(batch.columns) - set(schema.names)))
    update = [name for name in batch.columns if name != on and name in schema.names]
    return merge(
        target, batch, on, update=update, stamp=stamp, defaults=defaults,
        schema=schema, unique=True, unique_target=True,
    )


def upsert_set(
    target: DataFrame | None,
    batch: DataFrame,
    on: str,
    *,
    update: Sequence[str],
    stamp: Mapping[str, Column] | None = None,
    defaults: Mapping[str, Column] | None = None,
    schema: T.StructType | None = None,
    serial: str | None = None,
    unique: bool = False,
    distinct: bool = False,
) -> DataFrame:
    """One-statement upsert: a key repeated in the batch fails, matched or not.

    ``distinct`` upserts the distinct rows of the batch. The batch is written
    to scratch, checked there by its keys alone, and read by the joins.
    ``unique`` states that the caller knows the keys to be unique: then it is
    neither written nor checked.
    """
    if not unique:
        batch = materialize(batch.distinct() if distinct else batch)
        _enforce_sole(batch, on)
    return merge(
        target, batch, on, update=update, stamp=stamp, defaults=defaults,
        schema=schema, serial=serial, unique=True, unique_target=True,
    )


def insert_ignore(
    target: DataFrame | None,
    batch: DataFrame,
    on: str,
    *,
    defaults: Mapping[str, Column] | None = None,
    schema: T.StructType | None = None,
    serial: str | None = None,
) -> DataFrame:
    """Insert rows whose key is new; a key repeated in the batch is kept once."""
    return merge(
        target, one_per_key(batch, on), on, defaults=defaults,
        schema=schema, serial=serial, unique=True, unique_target=True,
    )
