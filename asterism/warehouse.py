"""Full refresh on plain Parquet folders.

Every save goes to a new folder. A publication is one more row in a small JSON
table that names the folder of each table, so all tables of a run appear
together, and a run that fails leaves the former ones in place. Rows are counted
up, whatever the clocks of their writers say. They are also the record of what
this library wrote: nothing else is ever deleted. One writer at a time.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterism import storage

log = logging.getLogger(__name__)

PUBLICATIONS = "publications"
SCHEMA = "version bigint, tables map<string, string>"
# Tables hold texts, the staged posts twice; this takes less room than Spark's default.
COMPRESSION = "zstd"


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._unpublished: list[str] = []

    def _publications(self) -> list[tuple[int, dict[str, str]]]:
        path = f"{self.root}/{PUBLICATIONS}"
        if not storage.exists(self.spark, path):
            return []
        try:
            rows = self.spark.read.schema(SCHEMA).option("mode", "FAILFAST").json(path).collect()
        except Exception as error:
            raise ValueError(f"{path} cannot be read, so nothing below {self.root} is touched") from error
        return sorted(((r.version, r.tables) for r in rows), key=lambda r: (r[0], sorted(r[1].items())))

    def history(self) -> list[dict[str, str]]:
        """Table name -> folder below the root, of every publication, the current one last."""
        return [tables for _, tables in self._publications()]

    def current(self) -> dict[str, str]:
        return next(reversed(self.history()), {})

    def _new_folder(self, name: str, layout: str = "") -> str:
        folder = f"{name}/v-{uuid.uuid4().hex}{layout}"
        self._unpublished.append(folder)
        return folder

    def save(self, name: str, df: DataFrame) -> str:
        """Write a new version without publishing it; returns its folder."""
        folder = self._new_folder(name)
        df.write.option("compression", COMPRESSION).parquet(f"{self.root}/{folder}")
        return folder

    def add(self, folder: str, df: DataFrame) -> None:
        """Add rows to a version that is not published yet."""
        df.write.mode("append").option("compression", COMPRESSION).parquet(f"{self.root}/{folder}")

    def save_bucketed(self, name: str, df: DataFrame, column: str, buckets: int) -> tuple[str, str]:
        """Write a new version bucketed by ``column``, a file each; returns its folder and catalog entry.

        The entry, which tells Spark about the buckets, is external: dropping it keeps the files.
        The folder's name tells the buckets, for ``open_bucketed``.
        """
        folder = self._new_folder(name, f"-{column}-{buckets}")
        entry = f"asterism_{uuid.uuid4().hex}"
        location = storage.qualified(self.spark, f"{self.root}/{folder}")
        writer = df.repartition(buckets, column).write.bucketBy(buckets, column)
        writer.option("path", location).option("compression", COMPRESSION).saveAsTable(entry)
        return folder, entry

    def add_bucketed(self, entry: str, df: DataFrame, column: str, buckets: int) -> None:
        """Add rows to a version that ``save_bucketed`` wrote and that is not published yet."""
        writer = df.repartition(buckets, column).write.bucketBy(buckets, column)
        writer.mode("append").option("compression", COMPRESSION).saveAsTable(entry)

    def open_bucketed(self, folder: str, column: str, buckets: int) -> str | None:
        """A catalog entry of a stored version, if it has these buckets."""
        if not folder.endswith(f"-{column}-{buckets}"):
            return None
        entry = f"asterism_{uuid.uuid4().hex}"
        location = storage.qualified(self.spark, f"{self.root}/{folder}").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {entry} ({self.open(folder).schema.toDDL()}) USING parquet"
            f" CLUSTERED BY ({column}) INTO {buckets} BUCKETS LOCATION '{location}'"
        )
        return entry

    def open(self, folder: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{folder}")

    def read(self, name: str) -> DataFrame:
        return self.open(self.current()[name])

    def read_or_none(self, name: str) -> DataFrame | None:
        folder = self.current().get(name)
        return None if folder is None else self.open(folder)

    def create_views(self) -> list[str]:
        """Temporary views of the current tables, for ``spark.sql``."""
        tables = self.current()
        for name, folder in tables.items():
            self.open(folder).createOrReplaceTempView(name)
        return sorted(tables)

    def publish(self, folders: Mapping[str, str]) -> None:
        """Make the given versions current, all at once; fail if another writer came in between."""
        last, former = next(reversed(self._publications()), (0, {}))
        tables = {**former, **folders}
        pairs = F.create_map(*[F.lit(x) for pair in tables.items() for x in pair])
        row = self.spark.range(1, numPartitions=1).select(F.lit(last + 1).alias("version"), pairs.alias("tables"))
        row.write.mode("append").json(f"{self.root}/{PUBLICATIONS}")
        if self.current() != tables:
            raise RuntimeError(f"another writer published below {self.root} at the same time")
        self._unpublished = [f for f in self._unpublished if f not in tables.values()]

    def refresh(self, name: str, df: DataFrame) -> DataFrame:
        """Replace a table's contents and read them back."""
        self.publish({name: self.save(name, df)})
        return self.read(name)

    def drop_superseded(self) -> None:
        """Delete the versions that an earlier publication named and the current one does not.

        Done by the next run, so that readers of the former version finish.
        """
        *_, kept = history = [{}, *self.history()]
        if not kept:
            log.info("nothing is published below %s, so nothing is deleted", self.root)
        for folder in sorted({f for tables in history for f in tables.values()} - set(kept.values())):
            storage.delete(self.spark, f"{self.root}/{folder}")

    def drop(self, folder: str) -> None:
        """Delete one version that is not published."""
        storage.delete(self.spark, f"{self.root}/{folder}")
        self._unpublished.remove(folder)

    def discard(self) -> None:
        """Delete what this object has saved and not published."""
        for folder in self._unpublished:
            storage.delete(self.spark, f"{self.root}/{folder}")
        self._unpublished = []
