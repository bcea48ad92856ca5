"""Table definitions: columns, keys, lengths, defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column as Expression
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Key types: 32-bit as in the original data model, 64-bit for collections
# with more than 2^31 records.
KEY_TYPES = {"int": T.IntegerType(), "bigint": T.LongType()}

NOW = object()  # default that stands for the run's timestamp


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    length: int | None = None  # VARCHAR(n)
    not_null: bool = False
    default: object = None


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    primary_key: str
    unique: tuple[str, ...] = ()
    serial: str | None = None
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type) for c in self.columns])

    @property
    def lengths(self) -> dict[str, int]:
        return {c.name: c.length for c in self.columns if c.length}

    def defaults(self, now: Expression) -> dict[str, Expression]:
        """What columns get that an insert leaves out; ``now`` is the run's timestamp."""
        given = {c.name: c.default for c in self.columns if c.default is not None}
        return {name: now if value is NOW else F.lit(value) for name, value in given.items()}

    @property
    def not_null(self) -> list[str]:
        return [c.name for c in self.columns if c.not_null or c.name == self.primary_key]


def star_schema(id_type: str = "int", variant: bool = False) -> dict[str, Table]:
    """The three staging and three warehouse tables; JSON columns as text or as VARIANT."""
    key = KEY_TYPES[id_type]
    integer, text = T.IntegerType(), T.StringType()
    json = T.VariantType() if variant else text
    moment, day, flag = T.TimestampNTZType(), T.DateType(), T.BooleanType()

    def varchar(name: str, length: int) -> Column:
        return Column(name, text, length=length)

    tables = [
        Table(
            "staging_posts",
            (
                Column("id", key),
                Column("user_id", key),
                Column("title", text),
                Column("body", text),
                Column("raw_data", json),
                Column("loaded_at", moment, default=NOW),
            ),
            primary_key="id",
        ),
        Table(
            "staging_users",
            (
                Column("id", key),
                Column("name", text),
                Column("username", text),
                Column("email", text),
                Column("phone", text),
                Column("website", text),
                Column("address", json),
                Column("company", json),
                Column("raw_data", json),
                Column("loaded_at", moment, default=NOW),
            ),
            primary_key="id",
        ),
        Table(
            "staging_comments",
            (
                Column("id", key),
                Column("post_id", key),
                Column("name", text),
                Column("email", text),
                Column("body", text),
                Column("raw_data", json),
                Column("loaded_at", moment, default=NOW),
            ),
            primary_key="id",
        ),
        Table(
            "dim_users",
            (
                Column("user_key", key),
                Column("user_id", key, not_null=True),
                varchar("username", 100),
                varchar("name", 200),
                varchar("email", 200),
                varchar("phone", 50),
                varchar("website", 200),
                varchar("city", 100),
                varchar("company_name", 200),
                Column("valid_from", moment, default=NOW),
                Column("valid_to", moment),
                Column("is_current", flag, default=True),
                Column("updated_at", moment, default=NOW),
            ),
            primary_key="user_key",
            unique=("user_id",),
            serial="user_key",
        ),
        Table(
            "dim_dates",
            (
                Column("date_key", integer),
                Column("full_date", day, not_null=True),
                Column("year", integer),
                Column("quarter", integer),
                Column("month", integer),
                varchar("month_name", 20),
                Column("day", integer),
                Column("day_of_week", integer),
                varchar("day_name", 20),
                Column("is_weekend", flag),
            ),
            primary_key="date_key",
        ),
        Table(
            "fact_posts",
            (
                Column("post_key", key),
                Column("post_id", key, not_null=True),
                Column("user_key", key),
                Column("date_key", integer),
                Column("title", text),
                Column("body", text),
                Column("body_length", integer),
                Column("word_count", integer),
                Column("comment_count", integer, default=0),
                Column("created_at", moment, default=NOW),
                Column("updated_at", moment, default=NOW),
            ),
            primary_key="post_key",
            serial="post_key",
            foreign_keys={
                "user_key": ("dim_users", "user_key"),
                "date_key": ("dim_dates", "date_key"),
            },
        ),
    ]
    return {table.name: table for table in tables}
