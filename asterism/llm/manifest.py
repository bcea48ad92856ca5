"""A Merkle manifest of a dataset: leaves, a tree for each source, and proofs.

Leaves are ordered inside their source; 16 consecutive nodes become one, level
by level, until one is left, the subroot. The subroots, in order of their
sources, become the root the same way.

A superblock is a subtree of three levels, 4,096 leaves. Its leaves are reduced
to one digest in a task of their own, and these digests, far fewer, are the
leaves of the tree above, so each round shrinks the tree by 4,096. Then every
superblock is cogrouped with the outer nodes it requires: the siblings on the
way from its digest to the root. That task finishes its local levels, joins
local and outer siblings to each leaf's proof, and folds the leaf up to the root.

Sizes: a group is a superblock, at most 4,096 digests, and its one outer row
with at most 15 digests a level, however many leaves a source has. Positions
come from a range partitioning and the counts of its parts, not from a window
over a source.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asterism.llm.common import stored

PATH = "array<struct<before: string, after: string>>"
WAY = f"group string, block bigint, path {PATH}, top string"


@dataclass(frozen=True)
class Shape:
    fan: int = 16
    height: int = 3  # levels of a superblock

    @property
    def block(self) -> int:
        return self.fan**self.height


def combined(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    framed = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(framed, F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(value) for value in values]), 256)


def group_name(source: Column) -> Column:
    """A text that is never null and sorts as the source does, null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def numbered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``pos``, the place of a row in its group from 0, and ``total``, the group's rows.

    Rows that agree in ``order`` are numbered in any order, and so can be split
    over tasks. Counting needs one row for each group in each part.
    """
    salted = df.withColumn("_salt", F.monotonically_increasing_id())
    keys = ["group", *order, "_salt"]
    sorted_ = salted.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_salt")
    rows = stored(sorted_.withColumn("_place", F.monotonically_increasing_id()), "ordered")
    rows = rows.withColumn("_part", F.shiftright("_place", 33))
    parts = rows.groupBy("group", "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    of_group = Window.partitionBy("group")
    before = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "group",
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(of_group).alias("total"),
    )
    placed = rows.join(stored(parts, "parts"), ["group", "_part"])
    return placed.withColumn("pos", F.col("_place") + F.col("_shift")).drop("_place", "_part", "_shift")


def levels_of(digests: list[str], total: int, shape: Shape) -> list[list[str]]:
    """The digests of a superblock and of the levels above them that its group has."""
    levels = [digests]
    while len(levels) <= shape.height and total > 1:
        below = levels[-1]
        runs = range(0, len(below), shape.fan)
        levels.append([combined("".join(below[at : at + shape.fan])) for at in runs])
        total = -(-total // shape.fan)
    return levels


def paths_of(levels: list[list[str]], shape: Shape) -> list[list[tuple[str, str]]]:
    """For every level but the last, the siblings before and after each of its nodes."""
    out = []
    for level in levels[:-1]:
        sides = []
        for at in range(len(level)):
            start = at - at % shape.fan
            sides.append(("".join(level[start:at]), "".join(level[at + 1 : start + shape.fan])))
        out.append(sides)
    return out


def fold(digest: str, path: Sequence[tuple[str, str]]) -> str:
    for before, after in path:
        digest = combined(before + digest + after)
    return digest


def _reduce(shape: Shape) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def reduce(nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        total = int(nodes["total"].iat[0])
        top = levels_of(nodes["digest"].tolist(), total, shape)[-1][0]
        blocks = -(-total // shape.block)
        row = (nodes["group"].iat[0], int(nodes["block"].iat[0]), top, blocks)
        return pd.DataFrame([row], columns=["group", "pos", "digest", "total"])

    return reduce


def _pairs(path) -> list[tuple[str, str]]:
    return [(step["before"], step["after"]) for step in path]


def _climb(shape: Shape) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The way of every node of a superblock to its group's top."""

    def climb(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        levels = levels_of(nodes["digest"].tolist(), int(nodes["total"].iat[0]), shape)
        local = paths_of(levels, shape)
        rest, top = _pairs(outer["path"].iat[0]), outer["top"].iat[0]
        paths = []
        for at in range(len(nodes)):
            own = [sides[at // shape.fan**level] for level, sides in enumerate(local)]
            paths.append([{"before": before, "after": after} for before, after in own + rest])
        out = nodes[["group", "pos"]].rename(columns={"pos": "block"})
        return out.assign(path=paths, top=top)

    return climb


def ways(nodes: DataFrame, shape: Shape) -> DataFrame:
    """(group, block, path, top): the way of each superblock of ``nodes`` to its group's top.

    ``nodes`` has group, pos, digest and total. Each call works on the digests
    of the superblocks of the call before.
    """
    blocked = nodes.select(
        "group", "pos", "digest", "total", F.floor(F.col("pos") / shape.block).alias("block")
    )
    roots = blocked.groupBy("group", "block").applyInPandas(
        _reduce(shape), "group string, pos bigint, digest string, total bigint"
    )
    roots = stored(roots, "superblocks")
    none = F.array().cast(PATH)
    alone = roots.filter("total = 1").select(
        "group", F.col("pos").alias("block"), none.alias("path"), F.col("digest").alias("top")
    )
    more = roots.filter("total > 1")
    if more.isEmpty():
        return alone
    return alone.unionByName(stored(climbed(more, ways(more, shape), shape), "ways"))


def climbed(nodes: DataFrame, outer: DataFrame, shape: Shape) -> DataFrame:
    """(group, block, path, top) of every node, ``block`` being its position."""
    blocked = nodes.withColumn("block", F.floor(F.col("pos") / shape.block))
    key = ["group", "block"]
    return blocked.groupBy(*key).cogroup(outer.groupBy(*key)).applyInPandas(_climb(shape), WAY)


PROVED = "id string, leaf string, subroot string, root string, proof string, folded string"


def _prove(shape: Shape, keep_proofs: bool) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def prove(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        leaves = leaves.sort_values("pos")
        digests = leaves["digest"].tolist()
        local = paths_of(levels_of(digests, int(leaves["total"].iat[0]), shape), shape)
        rest = _pairs(outer["path"].iat[0])
        outside = "".join(before + after for before, after in rest)
        proofs, folded = [], []
        for at, seen in enumerate(leaves["seen"]):
            own = [sides[at // shape.fan**level] for level, sides in enumerate(local)]
            proof = "".join(before + after for before, after in own) + outside
            proofs.append(proof if keep_proofs else combined(proof))
            folded.append(fold(seen, own + rest))
        return pd.DataFrame(
            {
                "id": leaves["id"],
                "leaf": digests,
                "subroot": outer["subroot"].iat[0],
                "root": outer["root"].iat[0],
                "proof": proofs,
                "folded": folded,
            }
        )

    return prove


def manifest(
    df: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_: str = "doc_id",
    source: str = "source",
    seen: dict[str, Column] | None = None,
    keep_proofs: bool = False,
    shape: Shape | None = None,
) -> DataFrame:
    """One row for each row of ``df``: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of the ``fields``, each framed by its length, so null
    and empty differ. Leaves ascend by id inside a source, a null id first,
    rows that share an id by their digest; a null source comes first of all.
    The proof lists a leaf's siblings level by level up to the root; with
    ``keep_proofs`` the column ``proof`` holds it in full instead of its digest.

    ``seen`` gives expressions that stand for some fields as someone else sees
    the rows now; ``folded_root`` is the root that those values fold to with the
    original siblings, and ``verified`` says whether it is the root. A null id
    is handled as any other value. A table of one row has its leaf as root and
    an empty proof; an empty table gives no rows. Columns outside ``fields``
    are ignored.
    """
    shape = shape or Shape()
    values = [F.col(name) for name in fields]
    now = [(seen or {}).get(name, F.col(name)) for name in fields]
    leaves = df.select(
        F.col(id_).alias("id"),
        group_name(F.col(source)).alias("group"),
        leaf(values).alias("digest"),
        leaf(now).alias("seen"),
    )
    # Written before it is sorted: sampling for the ranges must not hash the texts again.
    leaves = stored(numbered(stored(leaves, "leaves"), ["id", "digest"]), "numbered")
    inner = stored(ways(leaves, shape), "ways")

    # The tree over the subroots. There is one row for each source.
    tops = inner.select(F.col("group").alias("name"), "top").distinct()
    nodes = tops.select(F.lit("").alias("group"), "name", F.col("top").alias("digest"))
    nodes = stored(numbered(nodes, ["name"]), "subroots")
    above = climbed(nodes, ways(nodes, shape), shape)
    above = above.join(nodes.select("name", F.col("pos").alias("block")), "block")
    above = above.select(
        F.col("name").alias("group"), F.col("path").alias("rest"), F.col("top").alias("root")
    )
    outer = inner.join(stored(above, "above"), "group").select(
        "group", "block", F.concat("path", "rest").alias("path"), F.col("top").alias("subroot"), "root"
    )
    key = ["group", "block"]
    # Ids travel as text, since pandas would turn integers beside nulls into floats.
    blocked = leaves.withColumns(
        {"id": F.col("id").cast("string"), "block": F.floor(F.col("pos") / shape.block)}
    )
    proved = blocked.groupBy(*key).cogroup(outer.groupBy(*key)).applyInPandas(
        _prove(shape, keep_proofs), PROVED
    )
    return proved.select(
        F.col("id").cast(df.schema[id_].dataType).alias(id_),
        "leaf",
        "subroot",
        "root",
        F.col("proof").alias("proof" if keep_proofs else "proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
