"""Landed JSON collections: the text of each record, with its payload order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterism.sources.arrays import array_records

FAILFAST = {"mode": "FAILFAST"}
END = "__end"  # key of the mark behind a record


def read_records(
    spark: SparkSession,
    path: str,
    layout: str = "lines",
    fields: T.StructType | None = None,
    variant: bool = False,
) -> DataFrame:
    """Read a collection as ``record STRING, arrival STRUCT``, and ``fields`` where they are named.

    With ``variant`` the record is a VARIANT, made by the one parse, and there
    are no ``fields``: any value can be read of it without parsing again.

    ``arrival`` orders records as they were landed: by file path, then by place
    in the file. Within one split of a file the row number rises in reading
    order, and splits are ordered by their start offset, so the order is exact
    and comes out the same when a lost task is run again.

    ``lines`` is one record per line. ``array`` is one JSON array per file, as a
    response body is saved. Both split to any size.

    A JSON parser stops at the end of the first value. So each text is parsed
    inside an array that ends with a mark, a number that nothing inside the text
    can anticipate, and fails unless the mark comes next; no text after a record
    is dropped. The same parse gives the fields. The check decides on rows, not
    on a column, so it holds whichever columns are read.
    """
    # Blanks, tabs and line ends around a value are no part of it.
    text = F.btrim("value", F.lit(" \t\r\n")).alias("record")
    if layout == "lines":
        place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")]
        texts = spark.read.text(path).select(text, *place, F.monotonically_increasing_id().alias("row"))
    elif layout == "array":
        texts = array_records(spark, path)
    else:
        raise ValueError(f"unknown layout {layout!r}")

    mark = F.xxhash64("record").cast("string")
    element = T.StructType([*(fields or T.StructType()).fields, T.StructField(END, T.StringType())])
    enclosed = F.concat(F.lit("["), F.col("record"), F.lit(',{"' + END + '":"'), mark, F.lit('"}]'))
    enclosed = F.when(F.col("record") != "", enclosed)
    if variant:
        parts = F.parse_json(enclosed)
        size = F.when(F.variant_get("parts", "$[2]", "variant").isNull(), F.lit(2))
        end = F.variant_get("parts", f"$[1].{END}", "string")
    else:
        parts = F.from_json(enclosed, T.ArrayType(element), FAILFAST)
        size, end = F.size("parts"), F.col("parts")[1][END]
    parsed = texts.withColumns({"parts": parts, "mark": mark, "seen": F.monotonically_increasing_id()})
    whole = F.startswith("record", F.lit("{")) & (size == 2) & (end == F.col("mark"))
    fail = F.raise_error(F.concat(F.lit("malformed record in "), F.col("file"))).cast("boolean")
    blank = F.when(F.col("record") == "", F.lit(False))
    # Looking at a column that depends on the reading keeps the filter above the
    # parse; pushed below it, it would parse every record again.
    fine = F.coalesce(whole, F.lit(False)) & (F.col("seen") >= 0)
    kept = parsed.filter(blank.when(fine, F.lit(True)).otherwise(fail))
    if variant:
        kept = kept.withColumn("record", F.variant_get("parts", "$[0]", "variant"))
    values = [F.col("parts")[0].alias("fields")] if fields and not variant else []
    return kept.select("record", F.struct("file", "split", "row").alias("arrival"), *values)


def read_typed(spark: SparkSession, path: str, schema: str, layout: str = "lines") -> DataFrame:
    """Read records with a declared schema; malformed or ill-typed ones fail.

    A nested object under a STRING field arrives as its JSON text.
    """
    fields = T.StructType.fromDDL(schema)
    records = read_records(spark, path, layout, fields)
    return records.select(*[F.col("fields")[name].alias(name) for name in fields.names])
