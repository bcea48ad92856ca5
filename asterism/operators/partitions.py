"""Tables partitioned by a day key, of which single days are replaced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterism import storage
from asterism.operators.checks import required


def write_days(df: DataFrame, path: str, column: str = "date_key") -> None:
    """Write a whole table, one folder for each value of ``column``."""
    df.write.partitionBy(column).mode("overwrite").parquet(path)


def replace_days(
    df: DataFrame, path: str, days: Sequence[int], column: str = "date_key"
) -> None:
    """Make ``df`` the contents of the given days; the others are neither read nor written.

    The days may be new, or left without rows. A row of any other day fails the
    write before anything is replaced. Running it again gives the same table,
    also after a run that was broken off.
    """
    outside = F.concat(F.lit(f"row outside the days to replace: {column} = "), F.col(column).cast("string"))
    checked = required(df, F.col(column).isin(*days), F.coalesce(outside, F.lit(f"null {column}")))
    # Dynamic overwrite replaces the folders that rows were written to, when all tasks are done.
    checked.write.partitionBy(column).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    spark = df.sparkSession
    for day in days:
        if df.filter(F.col(column) == day).isEmpty():
            storage.delete(spark, f"{path.rstrip('/')}/{column}={day}")


def read_days(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
