"""Records of JSON array files of any size, read by many tasks.

A file that is one array has no lines to split at. It is read in pieces that end
at ``}``, so Spark's text source can start a task at any byte. Whether a piece
begins inside a string, and how deep it is nested, depends on all text before
it. So each split is first reduced to what it does to (inside a string, depth),
once for either way it may begin; these effects are put together by a prefix
scan over the splits of a file, one row each; then every split cuts its records
knowing how it begins. A record that crosses splits is joined from its parts.

No task holds more than a batch of pieces and the record it is in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from asterism.session import scratch_path, ship_package

STRING = re.compile(r'"(?:[^"\\]+|\\.)*+"', re.S)
COMPLETE = re.compile(r'(?:[^"]+|"(?:[^"\\]+|\\.)*+")*+', re.S)
REST_OF_STRING = re.compile(r'(?:[^"\\]+|\\.)*+"', re.S)
FIRST = re.compile(r"[ \t\r\n]*\[[ \t\r\n]*(?=\{)")
NEXT = re.compile(r"[ \t\r\n]*,[ \t\r\n]*(?=\{)")
LAST = re.compile(r"[ \t\r\n]*\][ \t\r\n]*")
EMPTY = re.compile(r"[ \t\r\n]*\[[ \t\r\n]*\][ \t\r\n]*")

EFFECT = (
    "file string, split bigint, size bigint, bytes bigint, "
    "inside0 boolean, depth0 bigint, inside1 boolean, depth1 bigint"
)
START = (
    "file string, split bigint, inside boolean, depth bigint, "
    "is_first boolean, is_last boolean, is_open boolean"
)
CUT = "file string, split bigint, row bigint, part string, record string"


def scanned(text: str, inside: bool) -> tuple[bool, int]:
    """Whether a string is open behind the text, and by how much it is nested deeper there."""
    if inside:
        end = REST_OF_STRING.match(text)
        if end is None:
            return True, 0
        text = text[end.end() :]
    end = COMPLETE.match(text).end()
    plain = STRING.sub("", text[:end])
    depth = plain.count("{") + plain.count("[") - plain.count("}") - plain.count("]")
    return end < len(text), depth


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("row"),
        F.octet_length("value").alias("bytes"),
        "value",
    )


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The parts of a batch that lie in one split of one file."""
    split = batch.column("split").to_numpy(zero_copy_only=False)
    file = batch.column("file").dictionary_encode().indices.to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((np.diff(split) != 0) | (np.diff(file) != 0)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        if end > start:
            yield batch.slice(start, end - start)


def _head(run: pa.RecordBatch) -> dict:
    return run.slice(0, 1).to_pylist()[0]


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple, dict] = {}
    for batch in batches:
        for run in _runs(batch):
            head = _head(run)
            blank = {"inside0": False, "depth0": 0, "inside1": True, "depth1": 0, "bytes": 0}
            effect = known.setdefault((head["file"], head["split"]), {**head, **blank})
            # Every piece counts with a bracket behind it.
            effect["bytes"] += pc.sum(run.column("bytes")).as_py() + run.num_rows
            for text in run.column("value").to_pylist():
                for way in "01":
                    inside, deeper = scanned(text + "}", effect["inside" + way])
                    effect["inside" + way] = inside
                    effect["depth" + way] += deeper
    yield _packed(list(known.values()), EFFECT)


def _packed(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
    fields = [field.split() for field in schema.split(", ")]
    return pa.RecordBatch.from_pylist(rows, pa.schema([(name, kinds[kind]) for name, kind in fields]))


def _starts(effects: pa.Table) -> pa.Table:
    """How each split of a file begins; the splits come as one row each."""
    rows = effects.sort_by("split").to_pylist()
    # Only the last piece of a file has no bracket behind it.
    is_open = sum(row["bytes"] for row in rows) == rows[0]["size"] + 1
    inside, depth, out = False, 0, []
    for n, row in enumerate(rows):
        out.append(
            {"file": row["file"], "split": row["split"], "inside": inside, "depth": depth}
            | {"is_first": n == 0, "is_last": n + 1 == len(rows), "is_open": is_open}
        )
        way = "1" if inside else "0"
        inside, depth = row["inside" + way], depth + row["depth" + way]
    return pa.Table.from_batches([_packed(out, START)])


@dataclass
class _Cutter:
    """Cuts the records of one split out of its pieces."""

    file: str
    inside: bool
    depth: int
    is_first: bool
    n: int = 0

    def __post_init__(self) -> None:
        self.held: list[str] = []  # of the record that is open
        self.part = "tail" if self.depth > 1 or self.inside else "whole"
        self.ended = False

    def fail(self) -> ValueError:
        return ValueError(f"malformed record in {self.file}")

    def take(self, text: str) -> Iterator[tuple[int, str, str]]:
        if self.depth <= 1 and not self.inside:  # between two records
            begin = (FIRST if self.is_first and not self.n and self.depth == 0 else NEXT).match(text)
            if begin is None:
                raise self.fail()
            self.depth = 1
            text = text[begin.end() :]
        self.inside, deeper = scanned(text + "}", self.inside)
        self.depth += deeper
        self.held.append(text + "}")
        if self.depth < 1:
            raise self.fail()
        if self.depth == 1 and not self.inside:
            yield self.n, self.part, "".join(self.held)
            self.n, self.part = self.n + 1, "whole"
            self.held.clear()

    def end(self, rest: str | None) -> Iterator[tuple[int, str, str]]:
        """``rest`` is what follows the last bracket of the file, where the split is its last."""
        if rest is not None:
            nothing = self.is_first and not self.n and self.depth == 0 and EMPTY.fullmatch(rest)
            if not nothing and (self.held or self.depth != 1 or self.inside or not LAST.fullmatch(rest)):
                raise self.fail()
        elif self.held:
            yield self.n, "head" if self.part == "whole" else "middle", "".join(self.held)


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter, start, before = None, {}, None

    def cut(found: Iterator[tuple[int, str, str]]) -> list[dict]:
        key = {"file": start["file"], "split": start["split"]}
        return [key | {"row": n, "part": part, "record": record} for n, part, record in found]

    def finish() -> list[dict]:
        if cutter is None:
            return []
        if not start["is_last"]:
            return cut(cutter.take(before)) + cut(cutter.end(None))
        if not start["is_open"]:
            raise cutter.fail()
        return cut(cutter.end(before))

    for batch in batches:
        out = []
        for run in _runs(batch):
            head, texts = _head(run), run.column("value").to_pylist()
            if (head["file"], head["split"]) != (start.get("file"), start.get("split")):
                out += finish()
                cutter = _Cutter(head["file"], head["inside"], head["depth"], head["is_first"])
                start, before, texts = head, texts[0], texts[1:]
            for text in texts:  # one piece late, as the last one of a file is no piece like the others
                out += cut(cutter.take(before))
                before = text
        yield _packed(out, CUT)
    yield _packed(finish(), CUT)


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, row, record) of every object in the arrays, in their order.

    Each file has to hold one array of objects and nothing else but white
    space; anything else fails, naming the file, whatever is read of the rows.
    """
    ship_package(spark)  # the cutting runs in Python workers
    pieces = _pieces(spark, path)
    effects = pieces.mapInArrow(_effects, EFFECT)
    written = scratch_path(spark, "splits")
    effects.groupBy("file").applyInArrow(_starts, START).write.parquet(written)
    starts = spark.read.schema(START).parquet(written)
    # Spark's readers pass over files without a byte.
    if starts.filter("is_first").count() < len(pieces.inputFiles()):
        raise ValueError(f"malformed record in {path}: a file is empty")
    # The join may move whole splits, so their order is put up again behind it.
    known = pieces.drop("size", "bytes").join(starts, ["file", "split"])
    cuts = known.sortWithinPartitions("file", "split", "row").mapInArrow(_cuts, CUT)

    whole = cuts.filter("part = 'whole'").select("file", "split", "row", "record")
    # At most two parts for each split. A record's parts end with a tail.
    parts = cuts.filter("part <> 'whole'")
    in_order = Window.partitionBy("file").orderBy("split", "row")
    chain = F.sum(F.when(F.col("part") == "head", 1).otherwise(0)).over(in_order)
    place = F.struct("split", "row", "record")
    joined = parts.withColumn("chain", chain).groupBy("file", "chain").agg(
        F.sort_array(F.collect_list(place)).alias("parts")
    )
    first = F.col("parts")[0]
    crossing = joined.select(
        "file", first["split"].alias("split"), first["row"].alias("row"),
        F.array_join(F.transform("parts", lambda p: p["record"]), "").alias("record"),
    )
    return whole.unionByName(crossing)


def _bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of a partition as one array, a record a line."""

    def lines(texts: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])

    between = "["
    for batch in batches:
        texts = batch.column(0).to_pylist()
        if texts:
            yield lines([(between if i == 0 else ",") + text for i, text in enumerate(texts)])
            between = ","
    yield lines(["[]" if between == "[" else "]"])


def write_arrays(df: DataFrame, path: str) -> None:
    """Write rows as JSON, one array for each partition of ``df``; NULL fields are written as null."""
    ship_package(df.sparkSession)
    texts = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    texts.mapInArrow(_bracketed, "value string").write.text(path)
