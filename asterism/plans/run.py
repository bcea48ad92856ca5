"""The whole load, from landed files to a published star schema."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterism.functions.dates import date_key
from asterism.operators.audit import counted
from asterism.operators.checks import enforce, enforce_table, fk_orphans
from asterism.plans.dimensions import populate_dim_dates, populate_dim_users
from asterism.plans.facts import populate_fact_posts
from asterism.plans.staging import COMMENTS, POSTS, USERS, declared, kept, load
from asterism.schemas import star_schema
from asterism.session import configure, scratch_released
from asterism.sources.calendar import CALENDAR_END, CALENDAR_START, calendar_days
from asterism.sources.records import read_records
from asterism.warehouse import Warehouse

log = logging.getLogger(__name__)

COLLECTIONS = {"posts": POSTS, "users": USERS, "comments": COMMENTS}


@dataclass
class Run:
    """One run over ``<landing>/posts``, ``/users`` and ``/comments``.

    By default every table starts empty, as after dropping and creating it.
    With ``refresh`` off the current tables are the targets.

    ``buckets`` keeps the staged posts bucketed by id, so that the texts are
    not shuffled again for the fact table, nor by the next run with as many
    buckets. It is worth its files for large loads; with as many buckets as
    shuffle partitions, staging the posts takes no other shuffle than the one
    that looks for repeated ids.

    The loads keep the declared keys, lengths and references by construction
    or fail on the way. ``verify`` looks for breaches once more in the stored
    tables before they are published, with one job for each.

    ``variant`` keeps the JSON columns of the staging tables as VARIANT.
    """

    spark: SparkSession
    landing: str
    warehouse: Warehouse
    run_ts: datetime
    layout: str = "lines"
    id_type: str = "int"
    refresh: bool = True
    calendar: tuple[date, date] = (CALENDAR_START, CALENDAR_END)
    buckets: int | None = None
    verify: bool = False
    variant: bool = False
    counts: dict[str, int] = field(default_factory=dict)
    saved: dict[str, str] = field(default_factory=dict)
    entries: list[str] = field(default_factory=list)

    def _target(self, name: str) -> DataFrame | None:
        return None if self.refresh else self.warehouse.read_or_none(name)

    def _save(self, name: str, df: DataFrame) -> DataFrame:
        self.saved[name] = self.warehouse.save(name, df)
        return self.warehouse.open(self.saved[name])

    def _bucketed_target(self, name: str, key: str) -> DataFrame | None:
        """The current table with its buckets, if it has those of this run."""
        folder = None if self.refresh else self.warehouse.current().get(name)
        entry = folder and self.warehouse.open_bucketed(folder, key, self.buckets)
        if not entry:
            return self._target(name)
        self.entries.append(entry)
        return self.spark.table(entry)

    def _stage(self, collection: str) -> DataFrame:
        """Write the last record of each id, then add the rows of other ids.

        What was written tells which ids those are, so the records are neither
        stored twice nor joined; of wide rows, only the former ones are, and
        not even these are shuffled where both versions have the same buckets.
        """
        known = COLLECTIONS[collection]
        table = known.table
        records = read_records(self.spark, f"{self.landing}/{collection}", self.layout, known.fields, self.variant)
        records, seen = counted(records, collection)
        rules = declared(known, self.id_type, self.variant)
        key, bucketed = rules.primary_key, bool(self.buckets) and collection == "posts"
        target = self._bucketed_target(table, key) if bucketed else self._target(table)
        types = {field.name: field.dataType for field in rules.schema}
        alike = target is not None and types == {field.name: field.dataType for field in target.schema}
        # A target of other types is merged as a whole, which widens them.
        contents = load(known, records, self.run_ts, None if alike else target, self.id_type)
        if bucketed:
            self.saved[table], entry = self.warehouse.save_bucketed(table, contents, key, self.buckets)
            self.entries.append(entry)
            if alike:
                rest = kept(target, self.spark.table(entry), key)
                self.warehouse.add_bucketed(entry, rest, key, self.buckets)
            staged = self.spark.table(entry)
            if staged.isEmpty():
                # Without a row no bucket has a file, and none tells the columns.
                empty, staged = self.saved[table], self._save(table, staged)
                self.warehouse.drop(empty)
        else:
            staged = self._save(table, contents)
            if alike:
                self.warehouse.add(self.saved[table], kept(target, staged, key))
                staged = self.warehouse.open(self.saved[table])
        self.counts[f"{collection}_count"] = seen.get["rows"]
        log.info("loaded %s %s into %s", seen.get["rows"], collection, table)
        return staged

    def _users(self, staging_users: DataFrame) -> DataFrame:
        target = self._target("dim_users")
        return self._save(
            "dim_users",
            populate_dim_users(staging_users, self.run_ts, target, self.id_type, unique=True),
        )

    def _dates(self) -> DataFrame:
        days = calendar_days(self.spark, *self.calendar)
        return self._save("dim_dates", populate_dim_dates(days, self._target("dim_dates")))

    def execute(self) -> dict[str, int]:
        """Load everything, then publish; returns records attempted per collection."""
        try:
            with scratch_released(self.spark, f"{self.warehouse.root}/_scratch"):
                self._load()
            if self.verify:
                self._verify()
            self.warehouse.publish(self.saved)
        except BaseException:
            self.warehouse.discard()
            raise
        finally:
            for entry in self.entries:
                self.spark.sql(f"DROP TABLE IF EXISTS {entry}")
        return self.counts

    def _verify(self) -> None:
        stored = {name: self.warehouse.open(folder) for name, folder in self.saved.items()}
        for name, table in star_schema(self.id_type).items():
            enforce_table(stored[name], table, stored)

    def _load(self) -> None:
        # Loads that do not depend on each other share the cluster.
        inherited = inheritable_thread_target(self.spark)

        def start(task, *arguments):
            return pool.submit(copy_context().run, inherited(task), *arguments)

        with ThreadPoolExecutor(len(COLLECTIONS)) as pool:
            loads = [start(self._stage, name) for name in COLLECTIONS]
            posts, users, comments = [started.result() for started in loads]
            dimensions = [start(self._users, users), start(self._dates)]
            dim_users, dim_dates = [started.result() for started in dimensions]

        # All dates the fact can hold; user keys exist because of the inner join.
        dates = posts.select(date_key("loaded_at").alias("date_key")).distinct()
        enforce(
            fk_orphans(dates, "date_key", dim_dates, "date_key"),
            "fact_posts.date_key has to be in dim_dates",
        )
        target = self._target("fact_posts")
        self._save(
            "fact_posts",
            populate_fact_posts(posts, dim_users, comments, self.run_ts, target, self.id_type),
        )


def run(
    spark: SparkSession, landing: str, root: str, run_ts: datetime | None = None, **options
) -> dict[str, int]:
    """Load the landed collections and publish the star schema under ``root``."""
    configure(spark)
    warehouse = Warehouse(spark, root)
    warehouse.drop_superseded()
    run_ts = run_ts or spark.range(1).select(F.localtimestamp()).first()[0]
    return Run(spark, landing, warehouse, run_ts, **options).execute()
