"""Records -> staging tables. Each function gives the new contents of its table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterism.functions.json import (
    ill_typed,
    integer_field,
    lacks,
    missing_keys,
    optional_text_field,
    optional_value_field,
    parse_fields,
    record_schema,
)
from asterism.functions.variant import absent, variant_text, variant_value
from asterism.operators.checks import required
from asterism.operators.dml import upsert_sequential
from asterism.schemas import Table, star_schema


def moment(run_ts: datetime) -> Column:
    """The run's timestamp as a column, whatever the session's time zone."""
    return F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")


@dataclass(frozen=True)
class Collection:
    """Keys of a collection's records and the table they are staged in.

    ``required`` maps JSON keys to columns; ``texts`` and ``values`` are
    optional keys of the same name, defaulting to an empty text and object.
    """

    table: str
    required: dict[str, str]
    texts: tuple[str, ...] = ()
    values: tuple[str, ...] = ()

    @property
    def fields(self) -> T.StructType:
        return record_schema([*self.required, *self.texts], self.values)


POSTS = Collection(
    "staging_posts", {"id": "id", "userId": "user_id", "title": "title", "body": "body"}
)
USERS = Collection(
    "staging_users",
    {"id": "id", "name": "name", "username": "username", "email": "email"},
    ("phone", "website"),
    ("address", "company"),
)
COMMENTS = Collection(
    "staging_comments",
    {"id": "id", "postId": "post_id", "name": "name", "email": "email", "body": "body"},
)


def declared(collection: Collection, id_type: str = "int", variant: bool = False) -> Table:
    """The table the collection is staged in."""
    return star_schema(id_type, variant)[collection.table]


def load(
    collection: Collection, records: DataFrame, run_ts: datetime,
    target: DataFrame | None = None, id_type: str = "int",
) -> DataFrame:
    """Upsert records in payload order.

    Records come with their ``fields`` where they were read with them, else
    they are parsed here. A record without a required key, or with a number
    that its column cannot take, fails whichever columns are read. Records that
    were read as VARIANT give VARIANT columns for JSON.
    """
    variant = isinstance(records.schema["record"].dataType, T.VariantType)
    table, now = declared(collection, id_type, variant), moment(run_ts)
    fields, keys = F.col("fields"), collection.required
    if variant:
        texts = [variant_text(F.col("record"), key).alias(key) for key in (*keys, *collection.texts)]
        values = [variant_value(F.col("record"), key).alias(key) for key in collection.values]
        records = records.withColumn("fields", F.struct(*texts, *values))
    elif "fields" not in records.columns:
        parsed = parse_fields("record", [*keys, *collection.texts], collection.values)
        records = records.withColumn("fields", parsed)
    kinds = {key: table.schema[name].dataType for key, name in keys.items()}
    numbers = {key: kind for key, kind in kinds.items() if not isinstance(kind, T.StringType)}
    have = absent if variant else missing_keys
    fault = F.coalesce(
        lacks("record", fields, list(keys), have), *[ill_typed(fields, k, t) for k, t in numbers.items()]
    )
    records = required(records, fault.isNull(), fault)

    def column(key: str, name: str) -> Column:
        value = integer_field(fields, key, numbers[key]) if key in numbers else fields.getField(key)
        return value.alias(name)

    batch = records.select(
        *[column(key, name) for key, name in keys.items()],
        *[optional_text_field("record", fields, key, missing=have).alias(key) for key in collection.texts],
        *[optional_value_field(fields, key, as_text=not variant).alias(key) for key in collection.values],
        F.col("record").alias("raw_data"),
        "arrival",
    )
    return upsert_sequential(
        target, batch, table.primary_key, "arrival",
        stamp={"loaded_at": now}, defaults=table.defaults(now), schema=table.schema,
    )


def kept(target: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Rows of the former table that were not staged again.

    A record gives every column of its row, so nothing of a former row with the
    same key is left: staged and kept rows are the whole new table.
    """
    return target.join(staged.select(key), key, "left_anti").select(*staged.columns)


load_posts = partial(load, POSTS)
load_users = partial(load, USERS)
load_comments = partial(load, COMMENTS)
