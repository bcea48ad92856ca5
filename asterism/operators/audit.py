from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def row_counts(sources: Mapping[str, DataFrame]) -> DataFrame:
    """``source, row_count`` for each source."""
    counts = [
        df.agg(F.count("*").cast("int").alias("row_count")).select(
            F.lit(name).alias("source"), "row_count"
        )
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def counted(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    """Count rows on their way through another job, without a job of its own."""
    seen = Observation(label)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _fingerprints(df: DataFrame) -> DataFrame:
    """(rows, a, b): two sums over independent hashes of the rows, whatever their order."""
    # The hash passes over NULLs, so which columns are NULL is hashed as well.
    columns = [F.col(f"`{name}`") for name in sorted(df.columns)]
    inputs = [*columns, *[column.isNull() for column in columns]]
    hashes = [F.xxhash64(F.lit(seed), *inputs).cast("decimal(38,0)") for seed in (1, 2)]
    zero = F.lit(0).cast("decimal(38,0)")
    sums = [F.coalesce(F.sum(one), zero).alias(name) for one, name in zip(hashes, "ab", strict=True)]
    return df.select(*columns).agg(F.count(F.lit(1)).alias("rows"), *sums)


def fingerprint(df: DataFrame) -> str:
    """A text that two tables share if they hold the same rows equally often.

    It comes from one pass without a shuffle of rows, and does not depend on
    their order, their partitioning or the order of the columns. Tables with
    other contents, types or column names share it by chance only, with a
    probability of about 2**-128. Columns of map type cannot be hashed.
    """
    row = _fingerprints(df).first()
    kinds = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in sorted(df.schema.fields, key=lambda f: f.name))
    return f"{row.rows}:{row.a}:{row.b}:{kinds}"


def same_contents(one: DataFrame, other: DataFrame) -> bool:
    """Whether two tables hold the same rows, so that replacing one by the other changes nothing."""
    return fingerprint(one) == fingerprint(other)
