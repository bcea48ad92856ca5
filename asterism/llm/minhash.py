"""Near duplicates by b-bit MinHash with an exact confirmation.

1. One Python pass turns every whole text into the set of its word shingles,
   ``bands * rows`` minima of that set, one key for each band of minima, and
   the packed low bits of all minima.
2. Texts with the same set form a class, which its smallest id stands for.
   Shingles are compared by 64-bit hashes. Small sets are equal only if they
   are by two independent ones. Large sets would have to clash in several
   shingles to be taken for equal without being near duplicates.
3. Representatives that share a band key are candidates. A bucket is not
   expanded into its pairs: all members are compared with one leader, the
   member that meets most others (in a group of edited copies, the original).
   A group that hangs together costs as many comparisons as it has members.
   Members that are still in another component than their leader are joined
   with all others of their buckets by their rarest shingles, which is exact.
4. The packed bits estimate the similarity, corrected for chance agreement;
   pairs far below the threshold go. The rest is confirmed on full sets, made
   with the second hash, in which candidates had no part.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import add_columns, packed, settled, stored
from asterism.llm.components import components
from asterism.llm.words import constants, mix, shingle_sets


SMALL = 100  # words of a text whose set is told from others by both hashes


@dataclass(frozen=True)
class Settings:
    """Five-word shingles and a similarity of 0.8, unless given otherwise.

    A pair at the threshold shares no band with a probability of
    (1 - 0.8**rows)**bands, about 1e-7. The estimate is off by more than
    ``margin`` standard deviations with a probability below 1e-6.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 5
    bits: int = 2
    margin: float = 5.0

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def words(self) -> int:
        """64-bit integers of a packed signature."""
        return -(-self.hashes * self.bits // 64)

    @property
    def agreements(self) -> int:
        """Agreeing positions below which a pair is no candidate any more."""
        chance = 0.5**self.bits
        p = self.percent / 100 + (1 - self.percent / 100) * chance
        spread = math.sqrt(p * (1 - p) / self.hashes)
        return math.floor(self.hashes * (p - self.margin * spread))


def _minima(shingles: np.ndarray, settings: Settings, seeds: np.ndarray) -> np.ndarray:
    low = np.full(settings.hashes, 0xFFFFFFFF, np.uint32)
    flip = (seeds >> np.uint64(32)).astype(np.uint32)[:, None]
    factor = (seeds.astype(np.uint32) | np.uint32(1))[:, None]
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(low, ((short[at : at + 2048] ^ flip) * factor).min(axis=1), out=low)
    return low


def _signatures(sets: list[np.ndarray], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and packed low bits of every set, one row each."""
    seeds = constants(3, settings.hashes)
    low = np.array([_minima(s, settings, seeds) for s in sets], np.uint64)
    low = low.reshape(len(sets), settings.hashes)
    keys = np.zeros((len(sets), settings.bands), np.uint64)
    for row in range(settings.rows):
        keys = mix(keys + low[:, row :: settings.rows] + np.uint64(row + 1))
    keys = mix(keys + constants(4, settings.bands))
    fine = mix(low + seeds)
    bits = np.zeros((len(sets), settings.words * 64), np.uint8)
    for bit in range(settings.bits):
        bits[:, bit : settings.hashes * settings.bits : settings.bits] = (
            fine >> np.uint64(bit)
        ) & np.uint64(1)
    return keys.view(np.int64), np.packbits(bits, axis=1, bitorder="little").view(np.int64)


def _lists(matrix: np.ndarray) -> pa.Array:
    flat = pa.array(matrix.reshape(-1), pa.int64())
    size = matrix.shape[1]
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, len(flat) + 1, size, dtype=np.int32)), flat
    )


def signatures(df: DataFrame, text: str, settings: Settings) -> DataFrame:
    """Add n_shingles, set_id, bands and sig. A text without words has no set_id and no band."""

    def compute(texts: list) -> list[pa.Array]:
        sets, others = shingle_sets(texts, settings.shingle, {0: None, 1: SMALL})
        keys, bits = _signatures(sets, settings)
        ids = [
            hashlib.blake2b(a.tobytes() + b.tobytes(), digest_size=16).digest() if len(a) else None
            for a, b in zip(sets, others, strict=True)
        ]
        return [pa.array(map(len, sets), pa.int64()), packed(ids), _lists(keys), _lists(bits)]

    outputs = "n_shingles bigint, set_id binary, bands array<bigint>, sig array<bigint>"
    return add_columns(df, text, outputs, compute, chars=1 << 19).drop(text)


def _shingles(df: DataFrame, text: str, settings: Settings) -> DataFrame:
    """The sets on which links are confirmed, made with the hash that no candidate came from."""

    def compute(texts: list) -> list[pa.Array]:
        (found,) = shingle_sets(texts, settings.shingle, {1: None})
        sets = [s.view(np.int64) for s in found]
        ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
        flat = np.concatenate([*sets, np.empty(0, np.int64)])
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]

    return add_columns(df, text, "shingles array<bigint>", compute, chars=1 << 19).drop(text)


def _agreeing(settings: Settings):
    """Number of positions at which two packed signatures agree, as a column."""
    differing = F.lit(0)
    for i in range(settings.words):
        x = F.col("sig_a")[i].bitwiseXOR(F.col("sig_b")[i])
        folded = x
        for bit in range(1, settings.bits):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, bit))
        ones = sum(1 << p for p in range(0, 64, settings.bits))
        ones -= (1 << 64) * (ones >> 63)
        differing = differing + F.bit_count(folded.bitwiseAND(F.lit(ones)))
    return F.lit(settings.hashes) - differing


def _sides(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """``column`` of the table for both ends of every pair."""
    for end in ("a", "b"):
        side = table.select(F.col("id").alias(end), F.col(column).alias(f"{column}_{end}"))
        pairs = pairs.join(side, end)
    return pairs


def _links(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, written."""
    near = _sides(pairs.distinct(), nodes, "sig").filter(
        _agreeing(settings) >= settings.agreements
    )
    near = stored(near.select("a", "b"), "near")
    both = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.size("shingles_a") + F.size("shingles_b") - both
    close = _sides(near, sets, "shingles").filter(100 * both >= settings.percent * union)
    return stored(close.select("a", "b"), "close")


def _prefix_pairs(open_: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) of different components that may be similar enough; exact.

    ``open_`` has id, its component c, and out: whether to look for its links;
    ``sets`` has id, shingles and set, which tells the sets of an id apart.
    The shingles of each set are put in order of their frequency, the rarest
    first. Two sets of m and n shingles that need an overlap of o have a common
    one among the first m - o + 1 and n - o + 1. So what an edited copy added
    fills its prefix, and neither the common text of its group nor a passage
    that very many documents share brings any two together. Sizes are part of
    the key, by classes, since o grows with both.
    """
    percent, whole = settings.percent, 100 + settings.percent
    tokens = sets.join(open_.select("id"), "id").select("id", "set", F.explode("shingles").alias("t"))
    often = tokens.groupBy("t").agg(F.count("*").alias("n")).filter("n > 1")
    counted = tokens.join(stored(often, "often"), "t", "left")
    entry = F.struct(F.coalesce("n", F.lit(1)).alias("n"), "t")
    ordered = counted.groupBy("id", "set").agg(F.sort_array(F.collect_list(entry)).alias("order"))
    ordered = ordered.withColumn("m", F.size("order"))
    first = F.slice("order", 1, (F.col("m") - F.ceil(F.col("m") * percent / 100) + 1).cast("int"))
    prefix = ordered.select("id", "m", F.posexplode(first).alias("at", "entry")).filter("entry.n > 1")
    prefix = prefix.join(open_, "id").select("id", "m", "at", F.col("entry.t").alias("t"), "c", "out")
    prefix = stored(prefix, "prefix")

    def size_class(size):
        return F.floor(F.log(size.cast("double")) / math.log(1.05)).cast("int")

    y = prefix.select(
        F.col("id").alias("y"), F.col("m").alias("n"), F.col("at").alias("at_y"), "t",
        F.col("c").alias("c_y"), F.coalesce("out", F.lit(False)).alias("out_y"),
        size_class(F.col("m")).alias("size"),
    )
    least = F.ceil(F.col("m") * percent / 100)
    most = F.least(
        F.floor(F.col("m") * 100 / percent),
        F.floor((F.col("m") - F.col("at")) * whole / percent) - F.col("m"),
    )
    x = prefix.filter("out").withColumns({"least": least, "most": most}).filter("least <= most")
    x = x.withColumn(
        "size", F.explode(F.sequence(size_class(F.col("least")), size_class(F.col("most"))))
    )
    overlap = F.ceil((F.col("m") + F.col("n")) * percent / whole)
    met = x.join(y, ["t", "size"]).filter(
        (F.col("c") != F.col("c_y"))
        & F.col("n").between(F.col("least"), F.col("most"))
        & (F.col("n") - F.col("at_y") >= overlap)
        & (F.col("m") - F.col("at") >= overlap)
        & (~F.col("out_y") | (F.col("id") < F.col("y")))
    )
    return met.select(F.least("id", "y").alias("a"), F.greatest("id", "y").alias("b"))


def _components_of(documents: DataFrame, signed: DataFrame, settings: Settings) -> DataFrame:
    """(id, component_id) of every document that has shingles."""
    known = signed.filter("id IS NOT NULL AND set_id IS NOT NULL")
    classes = stored(known.groupBy("set_id").agg(F.min("id").alias("rep")), "classes")
    members = known.select("id", "set_id").join(classes, "set_id").select("id", "rep").distinct()

    # One row for each class; the sets of a class are equal, so any row will do.
    nodes = known.join(classes.withColumnRenamed("rep", "id"), ["set_id", "id"])
    nodes = nodes.dropDuplicates(["set_id"]).select("id", "n_shingles", "bands", "sig")
    nodes = stored(nodes, "nodes")
    banded = nodes.select("id", "n_shingles", F.explode("bands").alias("key"))
    sizes = banded.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    buckets = stored(banded.join(stored(sizes, "sizes"), "key"), "buckets")
    wanted = stored(buckets.select("id").distinct(), "wanted")
    # An id that comes with several texts has several sets, told apart by their hash.
    # It is stored with them: beside an explode it would be made again for every shingle.
    sets = _shingles(documents.join(wanted, "id", "left_semi"), "text", settings).distinct()
    sets = stored(sets.withColumn("set", F.xxhash64("shingles")), "sets")

    # First every member with its bucket's leader.
    meets = buckets.groupBy("id").agg(F.sum("size").alias("meets"))
    leaders = (
        buckets.join(meets, "id")
        .groupBy("key")
        .agg(F.max(F.struct("meets", -F.col("id"))).alias("top"))
        .select("key", (-F.col("top.col2")).alias("leader"))
    )
    led = stored(buckets.join(stored(leaders, "leaders"), "key").filter("id <> leader"), "led")
    pairs = led.select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b"))
    links = _links(pairs, nodes, sets, settings)

    # Then members that are still outside their leader's component.
    found = components(links)
    of_id = found.select(F.col("node").alias("id"), F.col("component").alias("c"))
    of_leader = found.select(F.col("node").alias("leader"), F.col("component").alias("home"))
    outside = led.join(of_id, "id", "left").join(of_leader, "leader", "left")
    outside = outside.filter(F.coalesce("c", "id") != F.coalesce("home", "leader"))
    outside = stored(outside.select("key", "id", "leader"), "outside")
    if not outside.isEmpty():
        keys = outside.select("key").distinct()
        open_ = buckets.join(stored(keys, "keys"), "key", "left_semi").select("id").distinct()
        open_ = open_.join(of_id, "id", "left").select("id", F.coalesce("c", "id").alias("c"))
        open_ = open_.join(outside.select("id", F.lit(True).alias("out")).distinct(), "id", "left")
        more = _prefix_pairs(stored(open_, "open"), sets, settings)
        more = _links(more, nodes, sets, settings)
        if not more.isEmpty():
            stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
            found = components(stars.unionByName(more))

    final = found.withColumnRenamed("node", "rep")
    return (
        members.join(final, "rep", "left")
        .groupBy("id")
        .agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    )


def near_duplicates(
    df: DataFrame, id_: str = "doc_id", text: str = "text", settings: Settings | None = None
) -> DataFrame:
    """One row for each row of ``df``: its id, n_shingles, component_id and kept.

    Texts are linked when their sets of shingles have a Jaccard similarity of
    at least the threshold; component_id is the smallest id that links reach.
    Null, empty and blank texts have no shingles, link with nothing and are
    kept. Texts of fewer words than a shingle are one shingle. Rows that share
    an id count as one document: their links join. A row with a null id links
    with nothing, has no component and is kept. Other columns play no part.
    """
    settings = settings or Settings()
    documents = df.select(F.col(id_).alias("id"), F.col(text).alias("text"))
    signed = stored(signatures(documents, "text", settings), "signatures")
    labels = settled(
        df.sparkSession, "labels", lambda: _components_of(documents, signed, settings)
    )
    return (
        signed.select("id", "n_shingles")
        .join(labels, "id", "left")
        .select(
            F.col("id").alias(id_),
            "n_shingles",
            F.coalesce("component_id", "id").alias("component_id"),
            F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept"),
        )
    )


def deduplicated(
    df: DataFrame, id_: str = "doc_id", text: str = "text", settings: Settings | None = None
) -> DataFrame:
    """The rows of ``df`` whose id stands for its component, all columns kept; null ids stay."""

    def decide() -> DataFrame:
        found = near_duplicates(df, id_, text, settings)
        return found.filter("NOT kept").select(F.col(id_).alias("gone")).distinct()

    gone = settled(df.sparkSession, "gone", decide)
    return df.join(gone, df[id_] == gone["gone"], "left_anti")
