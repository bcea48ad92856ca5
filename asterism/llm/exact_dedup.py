"""Exact duplicates by recipes of content-defined chunks.

A normalised text is cut where a rolling hash of its last 32 bytes says so, so
equal texts have equal cuts whatever lies around them. Chunks are deduplicated
to verified identifiers: the contents behind each 64-bit hash are compared as
they are, once, and a hash that turns out to stand for several contents is told
apart by an ordinal. From then on a text is its recipe, the ordered list of
identifiers, and only recipes are grouped and joined; texts do not move again.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asterism.llm.common import (
    CHUNK_CHARS,
    add_columns,
    pieces,
    settled,
    small_batches,
    stored,
)
from asterism.llm.words import SPACES, constants

SHORTEST, LONGEST = 512, 8192  # bytes of a chunk; the shortest exceeds the rolling window
CUT_BITS = 10  # a cut every 1024 bytes on average, behind the shortest length
GEAR = (constants(5, 256) >> np.uint64(32)).astype(np.uint32)


def rolling(raw: np.ndarray) -> np.ndarray:
    """Gear hash of the 32 bytes up to each position, built by doubling."""
    out = GEAR[raw]
    for reach in (1, 2, 4, 8, 16):
        out[reach:] += out[:-reach] << np.uint32(reach)
    return out


def normalised_chunks(texts: list[str | None]) -> list[list[bytes]]:
    """The chunks of every text without its white space; null counts as empty."""
    coded = [(text or "").encode() for text in texts]
    raw = np.frombuffer(b"".join(coded), np.uint8)
    stay = ~SPACES[raw]
    ends = np.cumsum([0, *map(len, coded)])
    ends = np.concatenate([[0], np.cumsum(stay)])[ends].tolist()
    raw = raw[stay]
    data = raw.tobytes()
    cuts = (np.flatnonzero(rolling(raw) >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist()
    out = []
    for start, end in zip(ends[:-1], ends[1:], strict=True):
        chunks, at = [], start
        while end - at > SHORTEST:
            place = bisect.bisect_left(cuts, at + SHORTEST)
            stop = min(at + LONGEST, end)
            if place < len(cuts):
                stop = min(stop, cuts[place])
            chunks.append(data[at:stop])
            at = stop
        if at < end:
            chunks.append(data[at:end])
        out.append(chunks)
    return out


def _chunk_hash(chunk: bytes, bits: int) -> int:
    value = int.from_bytes(hashlib.blake2b(chunk, digest_size=8).digest(), "little", signed=True)
    return value >> (64 - bits)


def _int_lists(lists: list[list[int]]) -> pa.Array:
    return pa.array(lists, pa.list_(pa.int64()))


def recipes(df: DataFrame, text: str, hash_bits: int = 64) -> DataFrame:
    """Replace ``text`` by n_code_points, text_sha256 of the normalised text, and its recipe."""

    def compute(texts: list) -> list[pa.Array]:
        chunks = normalised_chunks(texts)
        return [
            pa.array([len(t or "") for t in texts], pa.int64()),
            pa.array([hashlib.sha256(b"".join(c)).hexdigest() for c in chunks], pa.string()),
            _int_lists([[_chunk_hash(x, hash_bits) for x in c] for c in chunks]),
        ]

    outputs = "n_code_points bigint, text_sha256 string, recipe array<bigint>"
    return add_columns(df, text, outputs, compute).drop(text)


def chunk_table(df: DataFrame, text: str, hash_bits: int = 64) -> DataFrame:
    """(hash, content) of every chunk of every text; a task leaves out what it has just given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 0, CHUNK_CHARS):
                chunks = normalised_chunks(piece.column(0).to_pylist())
                contents = list(dict.fromkeys(c for row in chunks for c in row))
                hashes = [_chunk_hash(c, hash_bits) for c in contents]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes, pa.int64()), pa.array(contents, pa.binary())],
                    names=["hash", "content"],
                )

    small_batches(df.sparkSession)
    return df.select(text).mapInArrow(run, "hash bigint, content binary")


def _told_apart(df: DataFrame, text: str, clashes: DataFrame, hash_bits: int) -> DataFrame:
    """Recipes whose identifiers are (hash, ordinal of the content behind that hash)."""
    contents = chunk_table(df, text, hash_bits).join(clashes, "hash", "left_semi").distinct()
    order = Window.partitionBy("hash").orderBy("content")
    ordinals = stored(contents.withColumn("ordinal", F.row_number().over(order)), "ordinals")

    def compute(texts: list) -> list[pa.Array]:
        return [pa.array(normalised_chunks(texts), pa.list_(pa.binary()))]

    cut = add_columns(df, text, "contents array<binary>", compute)
    rows = stored(
        recipes(cut, text, hash_bits).withColumn("row", F.monotonically_increasing_id()), "rows"
    )
    parts = rows.select(
        "row", F.posexplode(F.arrays_zip("recipe", "contents")).alias("place", "part")
    ).select("row", "place", F.col("part.recipe").alias("hash"), F.col("part.contents").alias("content"))
    known = parts.join(ordinals, ["hash", "content"], "left").select(
        "row", F.struct("place", "hash", F.coalesce("ordinal", F.lit(0)).alias("ordinal")).alias("x")
    )
    lists = known.groupBy("row").agg(F.sort_array(F.collect_list("x")).alias("x"))
    ids = F.flatten(
        F.transform("x", lambda x: F.array(x["hash"], x["ordinal"].cast("bigint")))
    )
    return (
        rows.drop("recipe", "contents")
        .join(lists, "row", "left")
        .withColumn("recipe", F.coalesce(ids, F.array().cast("array<bigint>")))
        .drop("row", "x")
    )


def exact_duplicates(
    df: DataFrame, id_: str = "doc_id", text: str = "text", hash_bits: int = 64
) -> DataFrame:
    """One row for each row of ``df``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they agree after blanks and the controls 9 to 13 are
    deleted; a null text counts as empty, and all empty texts are equal. Of
    equal texts the one with the most code points stays, of those the one with
    the smallest id; a row with a null id stays only if no other row can. Rows
    that repeat the row that stays, id included, are marked as kept with it.
    Texts may have any length; other columns play no part, whatever their names.
    ``hash_bits`` shortens the chunk hashes, for tests of the case that they
    clash.
    """
    documents = df.select(F.col(id_).alias("id"), F.col(text).alias("text"))
    contents = chunk_table(documents, "text", hash_bits).distinct()
    clashes = contents.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash")
    clashes = stored(clashes, "clashes")
    if clashes.isEmpty():
        rows = recipes(documents, "text", hash_bits)
    else:
        rows = _told_apart(documents, "text", clashes, hash_bits)
    rows = stored(rows, "recipes")
    best = F.max(F.struct("n_code_points", (-F.col("id")).alias("low")))
    groups = rows.groupBy("recipe").agg(best.alias("best"), F.count("*").alias("size"))
    groups = stored(groups.filter("size > 1"), "groups")
    joined = rows.join(groups, "recipe", "left")
    keep = F.when(F.col("size") > 1, -F.col("best.low")).otherwise(F.col("id"))
    stays = F.when(
        F.col("size") > 1,
        keep.eqNullSafe(F.col("id"))
        & (F.col("best.n_code_points") == F.col("n_code_points")),
    ).otherwise(F.lit(True))
    return joined.select(
        F.col("id").alias(id_),
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        stays.alias("kept"),
        "text_sha256",
    )


def deduplicated(df: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, all columns kept.

    A row goes when every row of its id goes (null ids count as one id here).
    Rows that repeat both id and text of a row that stays are reduced to one.
    """

    def decide() -> DataFrame:
        found = exact_duplicates(df, id_, text).withColumnRenamed(id_, "id")
        by_id = found.groupBy("id").agg(
            F.max("kept").alias("stays"), (F.count("*") > 1).alias("repeats")
        )
        return by_id.filter("NOT stays OR repeats")

    by_id = settled(df.sparkSession, "decisions", decide)
    gone, again = by_id.filter("NOT stays"), by_id.filter("stays AND repeats")
    own = df[id_]
    kept = df.join(gone, own.eqNullSafe(gone["id"]), "left_anti")
    if again.isEmpty():
        return kept
    twice = kept.join(again, own.eqNullSafe(again["id"]), "left_semi").dropDuplicates([id_, text])
    return kept.join(again, own.eqNullSafe(again["id"]), "left_anti").unionByName(twice)
