from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterism.functions.dates import date_key, day_name, day_of_week, is_weekend, month_name
from asterism.functions.json import json_text
from asterism.functions.variant import variant_text
from asterism.operators.checks import assign_varchars
from asterism.operators.dml import insert_ignore, upsert_set, with_defaults
from asterism.operators.history import load_versions
from asterism.plans.staging import moment
from asterism.schemas import star_schema

USER_ATTRIBUTES = ("username", "name", "email", "phone", "website", "city", "company_name")


def user_attributes(staging_users: DataFrame) -> DataFrame:
    """Columns of the dimension; address and company may be JSON text or VARIANT."""

    def inner(column: str, key: str) -> Column:
        if isinstance(staging_users.schema[column].dataType, T.VariantType):
            return variant_text(F.col(column), key)
        return json_text(column, key)

    return staging_users.select(
        F.col("id").alias("user_id"),
        "username",
        "name",
        "email",
        "phone",
        "website",
        inner("address", "city").alias("city"),
        inner("company", "name").alias("company_name"),
    )


def populate_dim_users(
    staging_users: DataFrame, run_ts: datetime, target: DataFrame | None = None,
    id_type: str = "int", unique: bool = False,
) -> DataFrame:
    """Overwrite attributes of known users, add the others under new keys.

    The first version's validity columns stay as they are: no history is kept.
    ``unique`` states that staged ids do not repeat, as is so for a staging
    table; else the distinct rows are taken and a repeated id fails.
    """
    table, now = star_schema(id_type)["dim_users"], moment(run_ts)
    batch = assign_varchars(
        user_attributes(staging_users),
        {name: n for name, n in table.lengths.items() if name in USER_ATTRIBUTES},
    )
    return upsert_set(
        target, batch, "user_id", update=USER_ATTRIBUTES, stamp={"updated_at": now},
        defaults=table.defaults(now), schema=table.schema, serial=table.serial,
        unique=unique, distinct=True,
    )


def populate_dim_users_history(
    staging_users: DataFrame, run_ts: datetime, target: DataFrame | None = None,
    id_type: str = "int",
) -> DataFrame:
    """The dimension with history: a changed user's row is closed and a new one opened.

    Facts find their version by ``as_of`` on user_id; user_id alone is no key
    any more. Users that are not staged keep their open version.
    """
    table, now = star_schema(id_type)["dim_users"], moment(run_ts)
    lengths = {name: n for name, n in table.lengths.items() if name in USER_ATTRIBUTES}
    batch = assign_varchars(user_attributes(staging_users), lengths)
    return load_versions(
        target, batch, "user_id", USER_ATTRIBUTES, now,
        schema=table.schema, serial=table.serial, defaults=table.defaults(now),
    )


def calendar_attributes(days: DataFrame) -> DataFrame:
    """Calendar columns for a frame of days ``d``."""
    d = F.col("d")
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        month_name(d).alias("month_name"),
        F.dayofmonth(d).alias("day"),
        day_of_week(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        is_weekend(d).alias("is_weekend"),
    )


def populate_dim_dates(days: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Add the days the calendar lacks; known days stay as they are."""
    schema = star_schema()["dim_dates"].schema
    return insert_ignore(
        target, with_defaults(calendar_attributes(days), schema), "date_key", schema=schema
    )
