"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterism.session import scratch_path, scratch_released

# Characters of text a Python task holds as arrays at a time. A single longer
# text is taken whole.
CHUNK_CHARS = 1 << 20

# Rows of an Arrow batch, where the session has no setting of its own: the
# batches of texts that a task and its Python worker hold stay at a few MB.
BATCH_ROWS = 500
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage with a table every executor can reach, so a lost executor
    costs its running tasks only.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Store what ``make`` gives and delete the scratch tables it made on the way."""
    path = scratch_path(spark, label)
    with scratch_released(spark):
        df = make()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def without(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns of ``df`` other than ``names``, which an operator is about to set."""
    dropped = {name.lower() for name in names}
    return [name for name in df.columns if name.lower() not in dropped]


def add_columns(
    df: DataFrame,
    column: str,
    outputs: str,
    compute: Callable[[list], list[pa.Array]],
    *more: str,
    chars: int = CHUNK_CHARS,
    finish: Callable[[], None] | None = None,
) -> DataFrame:
    """Add the columns of the DDL string ``outputs``, computed in Arrow batches.

    ``compute`` gets the Python values of ``column`` (of several columns: one
    list each) for a bounded piece of a batch and returns one Arrow array for
    each output. The other columns pass through untouched. Columns that have
    the name of an output are replaced. ``finish`` is called at the end of each
    task, to give back what the worker has cached: it goes on to other stages.
    """
    small_batches(df.sparkSession)
    fields = T.StructType.fromDDL(outputs).fields
    kept = without(df, [f.name for f in fields])
    schema = T.StructType([df.schema[name] for name in kept] + fields)
    inputs = (column, *more)
    plain = df.select(
        *[F.col(f"`{name}`").alias(f"k{i}") for i, name in enumerate(kept)],
        *[F.col(f"`{name}`").alias(f"x{i}") for i, name in enumerate(inputs)],
    )
    names = [field.name for field in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, len(kept), chars):
                values = [piece.column(len(kept) + i).to_pylist() for i in range(len(inputs))]
                made = compute(*values)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(i) for i in range(len(kept))] + made, names=names
                )
        if finish is not None:
            finish()

    return plain.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose values in a text or binary column add up to about ``limit`` bytes."""
    if not batch.num_rows:
        return
    lengths = batch.column(column)
    if pa.types.is_string(lengths.type) or pa.types.is_binary(lengths.type):
        sizes = np.nan_to_num(
            pc.binary_length(lengths).to_numpy(zero_copy_only=False).astype(float)
        )
    else:
        sizes = np.full(batch.num_rows, 64.0)
    group = (np.cumsum(sizes) // limit).astype(np.int64)
    cuts = np.flatnonzero(np.diff(group)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(start, end - start)


def packed(values: Sequence[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())
