"""Dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asterism.session import scratch_path


def number_rows(
    df: DataFrame,
    column: str,
    order_by: Sequence[str] = (),
    start: int = 0,
    type_: str = "int",
) -> DataFrame:
    """Add ``column`` = start+1, start+2, ... without gaps.

    The rows are written once to the shared scratch folder and numbered by
    where they lie: rows in the files before theirs, plus their index in their
    own file. So no task sees more than one file, nothing is sorted globally,
    and the numbers cannot change between two readings of the same rows.

    With ``order_by`` the numbers follow that order, which has to be unique for
    a reproducible result: the rows are range-partitioned first. Without it
    they are not shuffled at all, so copies of a row cannot pile up in a task.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    rows = df
    if order_by:
        rows = rows.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    rows.write.parquet(path)

    written = spark.read.schema(df.schema).parquet(path)
    file = F.col("_metadata.file_path").alias("__file")
    row = F.col("_metadata.row_index").alias("__row")
    files = (
        written.select(file, row)
        .groupBy("__file")
        .agg((F.max("__row") + 1).alias("__rows"))
        .withColumn("__part", F.regexp_extract("__file", r"part-(\d+)[^/]*$", 1).cast("int"))
    )
    # One row per written file, so this window and the broadcast are bounded by
    # the number of tasks that wrote, not by the data.
    before = Window.orderBy("__part", "__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select(
        "__file", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before")
    )
    number = (F.col("__before") + F.col("__row") + F.lit(start + 1)).cast(type_)
    return (
        written.select("*", file, row)
        .join(F.broadcast(offsets), "__file")
        .select(number.alias(column), *[F.col(name) for name in df.columns])
    )


def highest(df: DataFrame | None, column: str) -> int:
    """Largest key in use, 0 for a fresh table."""
    if df is None:
        return 0
    return df.agg(F.max(column)).first()[0] or 0
