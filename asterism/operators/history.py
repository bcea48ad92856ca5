"""Type-2 history: versions of a row with the interval they were valid in.

A feed of changes becomes versions by comparing each row of a key with the one
before and closing it where the next one begins. Both need rows in order within
a key, and one key may be a third of the feed. So rows are range-partitioned by
key and time, which splits a key over tasks, and look at their neighbours within
their part; what crosses parts is the last or first row of each part of a key,
few and narrow rows, which are put in order by themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterism.operators.checks import required
from asterism.operators.dml import materialize, with_defaults
from asterism.operators.keys import highest, number_rows

PART, PLACE = "__part", "__place"


def in_parts(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df``, written in order, with the number of each row's part and its place in the whole."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialize(ordered.withColumn(PLACE, F.monotonically_increasing_id()))
    return rows.withColumn(PART, F.shiftright(PLACE, 33))


def _with_edges(rows: DataFrame, key: str, edge: Column, across: Column) -> DataFrame:
    """Add ``__edge``: what the other parts of a row's key hand over to its part."""
    edges = rows.groupBy(key, PART).agg(edge.alias("__own"))
    handed = edges.select(key, PART, across.alias("__edge")).filter("__edge IS NOT NULL")
    # Most keys lie in one part and have nothing handed over.
    return rows.join(materialize(handed), [key, PART], "left")


def _neighbour(rows: DataFrame, key: str, value: Column, name: str, *, next_: bool) -> DataFrame:
    look = F.lead if next_ else F.lag
    pick = F.min_by if next_ else F.max_by
    across = look("__own").over(Window.partitionBy(key).orderBy(PART))
    joined = _with_edges(rows, key, pick(value, F.col(PLACE)), across)
    beside = look(value).over(Window.partitionBy(key, PART).orderBy(PLACE))
    return joined.withColumn(name, F.coalesce(beside, F.col("__edge"))).drop("__edge")


def with_next(rows: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """Add ``value`` of the following row of the same key; ``value`` must not be NULL."""
    return _neighbour(rows, key, value, name, next_=True)


def with_previous(rows: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    return _neighbour(rows, key, value, name, next_=False)


def with_latest(rows: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """Add the last ``value`` that is not NULL, up to and with the row itself."""
    so_far = Window.partitionBy(key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    across = F.last("__own", ignorenulls=True).over(so_far)
    held = F.max_by(value, F.when(value.isNotNull(), F.col(PLACE)))
    joined = _with_edges(rows, key, held, across)
    here = Window.partitionBy(key, PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    latest = F.coalesce(F.last(value, ignorenulls=True).over(here), F.col("__edge"))
    return joined.withColumn(name, latest).drop("__edge")


def versions(
    feed: DataFrame, key: str, at: str, attributes: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """``key``, the attributes, ``valid_from``, ``valid_to`` and ``is_current`` of every version.

    A version begins where an attribute differs from the row before, NULL being
    a value like any other, and ends where the next one begins; the last one is
    open. Of rows of a key at the same time, the last one by ``order`` counts.
    A NULL key or time fails.
    """
    known = required(
        feed, F.col(key).isNotNull() & F.col(at).isNotNull(), F.lit(f"null value in '{key}' or '{at}'")
    )
    value = F.struct(*attributes).alias("__value")
    rows = in_parts(known.select(key, at, *[c for c in order if c not in (key, at)], value), [key, at, *order])
    rows = with_next(rows, key, F.struct(at), "__next")
    settled = rows.filter(F.col("__next").isNull() | (F.col(f"__next.{at}") != F.col(at)))
    settled = with_previous(settled.drop("__next"), key, F.struct("__value"), "__before")
    same = F.col("__before").isNotNull() & F.col("__before.__value").eqNullSafe(F.col("__value"))
    changed = with_next(settled.filter(~same).drop("__before"), key, F.struct(at), "__next")
    end = F.col(f"__next.{at}")
    return changed.select(
        key,
        *[F.col(f"__value.{name}").alias(name) for name in attributes],
        F.col(at).alias("valid_from"),
        end.alias("valid_to"),
        end.isNull().alias("is_current"),
    )


def as_of(
    facts: DataFrame, history: DataFrame, key: str, at: str, columns: Sequence[str]
) -> DataFrame:
    """``facts`` with ``columns`` of the version of their key that was valid at their time.

    A version holds from its ``valid_from`` until before its ``valid_to``. Facts
    without a valid version, or without key or time, have NULLs. Facts and
    versions are sorted together and each fact takes the version last seen, so
    a key costs its facts plus its versions, not their product.
    """
    bounds = F.struct(*[c for c in columns], F.col("valid_to").alias("__end")).alias("__version")
    none = F.lit(None)
    fact = F.struct(*facts.columns).alias("__fact")
    complete = F.col(key).isNotNull() & F.col(at).isNotNull()
    began = history.select(
        F.col(key).alias("__key"), F.col("valid_from").alias("__at"), F.lit(0).alias("__kind"),
        F.lit(0).cast("bigint").alias("__salt"), bounds, none.cast(T.StructType(facts.schema.fields)).alias("__fact"),
    )
    shape = began.schema["__version"].dataType
    asked = facts.filter(complete).select(
        F.col(key).alias("__key"), F.col(at).alias("__at"), F.lit(1).alias("__kind"),
        F.monotonically_increasing_id().alias("__salt"), none.cast(shape).alias("__version"), fact,
    )
    rows = in_parts(began.unionByName(asked), ["__key", "__at", "__kind", "__salt"])
    seen = with_latest(rows, "__key", F.col("__version"), "__held").filter("__kind = 1")
    valid = F.col("__held.__end").isNull() | (F.col("__at") < F.col("__held.__end"))
    found = seen.select("__fact.*", *[F.when(valid, F.col(f"__held.{c}")).alias(c) for c in columns])
    without = facts.filter(~complete).select(
        "*", *[none.cast(shape[c].dataType).alias(c) for c in columns]
    )
    return found.unionByName(without)


def load_versions(
    target: DataFrame | None,
    batch: DataFrame,
    key: str,
    attributes: Sequence[str],
    now: Column,
    *,
    schema: T.StructType,
    serial: str,
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """A dimension with history after one more load.

    ``batch`` has one row per key. Keys whose attributes differ from their open
    version have it closed ``now`` and a new one opened; so have keys that are
    new. Versions that were closed before, and keys that the batch lacks, stay.
    """
    attributes = list(attributes)
    new = F.struct(*attributes)
    if target is not None:
        current = target.filter("is_current").select(key, F.struct(*attributes).alias("__old"))
        compared = batch.join(current, key, "left")
        batch = compared.filter(F.col("__old").isNull() | ~F.col("__old").eqNullSafe(new)).drop("__old")
    batch = materialize(batch)
    start = highest(target, serial)
    numbers = number_rows(batch.select(key), serial, [key], start, schema[serial].dataType.simpleString())
    opening = {"valid_from": now, "valid_to": F.lit(None), "is_current": F.lit(True)}
    opened = with_defaults(batch.join(numbers, key).withColumns(opening), schema, defaults)
    if target is None:
        return opened
    changed = batch.select(F.col(key).alias("__key"))
    joined = target.join(changed, (F.col(key) == F.col("__key")) & F.col("is_current"), "left")
    closes = F.col("__key").isNotNull()
    kept = joined.withColumns(
        {
            "valid_to": F.when(closes, now.cast(schema["valid_to"].dataType)).otherwise(F.col("valid_to")),
            "is_current": F.col("is_current") & ~closes,
        }
    )
    return kept.select(*schema.names).unionByName(opened)
