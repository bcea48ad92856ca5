"""Mixing a corpus to target weights over a tree of its columns.

The tree's levels are columns (say domain, language, source). The token budget
runs from the root down by weight. No node gets more than its subtree, without
what has no weight, can supply in ``max_epochs`` passes; what it cannot take goes to its siblings by
weight, and only what all siblings together cannot take is left to the level
above, whose children were offered it before. A leaf then takes full seeded
epochs and, of the last one, the prefix of its documents in the order of a
seeded hash.

Only DataFrame functions are used. Because a prefix in hash order is a
comparison with one cut key for each leaf, texts are never shuffled or sorted:
they meet a table with one row for each leaf.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asterism.llm.common import settled, stored, without

NO_NAME = "(none)"  # stands for a null in a level's column
ROWS_OF_RANGE = 2000  # documents of a hash range that one window sorts, on average
EXACT = "decimal(38,0)"


def count_tokens(text: str) -> Column:
    """Words between white space; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def order_key(id_: str, seed: int, epoch: Column) -> Column:
    """Position of a document in an epoch; rows that share an id share it."""
    text_id = F.coalesce(F.col(id_).cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), text_id))


def _weights(spark, weights: Mapping[tuple[str, ...], int], depth: int) -> DataFrame:
    rows = [(*path, weight) for path, weight in weights.items() if len(path) == depth]
    columns = ", ".join(f"l{i} string" for i in range(depth))
    return spark.createDataFrame(rows, f"{columns}, weight bigint")


def budgets(
    leaves: DataFrame,
    depth: int,
    weights: Mapping[tuple[str, ...], int],
    budget: int,
    max_epochs: int,
) -> DataFrame:
    """Budget of every leaf. ``leaves`` has l0 .. l(depth-1) and supply."""
    spark = leaves.sparkSession
    parent = spark.createDataFrame([(budget,)], "parent bigint")
    nodes = None
    # The deepest level at which a leaf's path has no weight: nodes above cannot use its supply.
    shut = F.lit(0)
    for level in sorted({len(path) for path, weight in weights.items() if weight <= 0 and len(path) <= depth}):
        path = [f"l{i}" for i in range(level)]
        none_here = _weights(spark, weights, level).filter("weight <= 0")
        leaves = leaves.join(none_here.withColumnRenamed("weight", f"none{level}"), path, "left")
        shut = F.when(F.col(f"none{level}").isNotNull(), F.lit(level)).otherwise(shut)
    leaves = leaves.withColumn("shut", shut)
    for level in range(1, depth + 1):
        path = [f"l{i}" for i in range(level)]
        caps = leaves.groupBy(*path).agg(
            (F.sum(F.when(F.col("shut") <= level, F.col("supply")).otherwise(0)) * max_epochs).alias("cap")
        )
        known = caps.join(_weights(spark, weights, level), path, "left").withColumn(
            "weight", F.coalesce("weight", F.lit(1)).cast(EXACT)
        )
        above = path[:-1]
        held = known.join(parent, above) if above else known.join(F.broadcast(parent))
        # Children in the order in which they run out of supply.
        runs_out = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight").cast("double"))
        order = Window.partitionBy(*above, "parent").orderBy(
            F.coalesce(runs_out, F.lit(float("inf"))), path[-1]
        )
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        onward = order.rowsBetween(0, Window.unboundedFollowing)
        none = F.lit(0).cast(EXACT)
        held = held.withColumns(
            {
                "given": F.coalesce(F.sum(F.col("cap").cast(EXACT)).over(before), none).cast(EXACT),
                "share": F.sum("weight").over(onward).cast(EXACT),
            }
        )
        left = (F.col("parent").cast(EXACT) - F.col("given")).cast("decimal(20,0)")
        full = F.col("cap").cast("decimal(19,0)") * F.col("share").cast("decimal(19,0)") <= (
            left.cast("decimal(19,0)") * F.col("weight").cast("decimal(19,0)")
        )
        held = held.withColumn("full", full & (F.col("weight") > 0))
        siblings = Window.partitionBy(*above, "parent")
        held = held.withColumns(
            {
                "spent": F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(siblings),
                "rest": F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(siblings),
            }
        )
        held = held.withColumn(
            "own",
            F.expr(
                "CASE WHEN full THEN cap WHEN weight > 0 THEN "
                "CAST(weight AS decimal(19,0)) * CAST(parent - spent AS decimal(19,0)) "
                "DIV CAST(rest AS decimal(38,0)) ELSE 0 END"
            ).cast("bigint"),
        )
        nodes = held.select(*path, "cap", F.col("own").alias("parent"))
        parent = nodes.select(*path, "parent")
    return nodes.select(
        *[f"l{i}" for i in range(depth)], F.col("parent").alias("budget"),
    )


def plan(
    rows: DataFrame,
    depth: int,
    weights: Mapping[tuple[str, ...], int],
    budget: int | None,
    max_epochs: int,
    seed: int,
) -> DataFrame:
    """What each leaf takes: ``epochs`` whole passes, then the prefix up to ``cut``.

    ``rows`` has l0 .., id and tokens, one row for each document with tokens.
    ``cut`` is the key of the last document of the partial pass, ``cut_tokens``
    what is taken of it; both are null where there is no partial pass.
    """
    path = [f"l{i}" for i in range(depth)]
    leaves = stored(
        rows.groupBy(*path).agg(F.sum("tokens").alias("supply"), F.count("*").alias("n")), "leaves"
    )
    supply, n = leaves.agg(F.sum("supply"), F.sum("n")).first()
    budget = (supply or 0) if budget is None else budget
    shares = budgets(leaves, depth, weights, budget, max_epochs).join(leaves, path)
    shares = stored(
        shares.withColumn("epochs", F.expr("CAST(budget DIV supply AS int)")).withColumn(
            "part", F.col("budget") - F.col("epochs") * F.col("supply")
        ),
        "shares",
    )
    # The hash range in which the partial pass ends, then the document.
    digits = max(1, math.ceil(math.log(max(1, n or 0) / ROWS_OF_RANGE, 16))) if n else 1
    keyed = rows.join(shares.filter("part > 0").select(*path, "epochs", "part"), path).select(
        *path, "part", "tokens", order_key("id", seed, F.col("epochs")).alias("key")
    )
    keyed = stored(keyed.withColumn("range", F.substring("key", 1, digits)), "keyed")
    ranges = keyed.groupBy(*path, "range", "part").agg(F.sum("tokens").alias("in_range"))
    upto = Window.partitionBy(*path).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("in_range").over(upto), F.lit(0)))
    last = ranges.filter("before < part AND part <= before + in_range")
    last = stored(last.select(*path, "range", "before"), "last_range")
    within = Window.partitionBy(*path, "range").orderBy("key")
    found = keyed.join(last, [*path, "range"]).withColumns(
        {
            # Rows that share a key stand at the same place.
            "through": F.col("before") + F.sum("tokens").over(within),
            "copies": F.sum("tokens").over(Window.partitionBy(*path, "range", "key")),
        }
    )
    cut = found.filter("through >= part AND through - copies < part").groupBy(*path).agg(
        F.min("key").alias("cut"),
        F.min(F.col("part") - (F.col("through") - F.col("copies"))).alias("cut_tokens"),
    )
    return shares.join(cut, path, "left").select(
        *path, "supply", "budget", "epochs", "cut", "cut_tokens"
    )


def mix(
    df: DataFrame,
    levels: Sequence[Column | str],
    weights: Mapping[tuple[str, ...], int],
    id_: str = "doc_id",
    text: str = "text",
    budget: int | None = None,
    max_epochs: int = 4,
    seed: int = 0,
) -> DataFrame:
    """The rows of ``df`` that the mixture takes, once for each epoch that takes them.

    Adds ``epoch`` (from 0), ``n_tokens`` (words of the text) and ``n_taken``
    (less than n_tokens only for the last document of a leaf); columns of these
    names are replaced. ``weights`` maps paths from the root, such as
    ("web",) or ("web", "en"), to whole numbers; a path that is missing weighs
    1, one of weight 0 gets nothing. Without ``budget`` the mixture is as large
    as the corpus.

    A null in a level counts as the name "(none)". Null, empty and blank texts
    have no tokens and are never taken. Rows that share an id are taken
    together, at the place of the first. Equal rates of running out go by name.
    Shares are rounded down, so a node may miss as many tokens as it has
    children. An empty table gives an empty mixture.
    """
    depth = len(levels)
    names = [f"l{i}" for i in range(depth)]
    paths = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NO_NAME)).alias(n)
        for n, c in zip(names, levels, strict=True)
    ]

    def planned() -> DataFrame:
        rows = df.select(*paths, F.col(id_).alias("id"), count_tokens(text).alias("tokens"))
        rows = stored(rows.filter("tokens > 0"), "tokens")
        return plan(rows, depth, weights, budget, max_epochs, seed)

    shares = settled(df.sparkSession, "mixture", planned)

    kept = without(df, ["epoch", "n_tokens", "n_taken"])
    # Struct columns cannot clash with the names of the table's own.
    whole = df.select(F.struct(*paths).alias("at"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))
    share = shares.select(F.struct(*names).alias("at"), F.struct("epochs", "cut", "cut_tokens").alias("s"))
    offered = whole.join(share, "at").select(
        "row", "s", F.explode(F.sequence(F.lit(0), F.col("s.epochs"))).alias("epoch")
    )
    key = order_key(f"row.{id_}", seed, F.col("epoch"))
    offered = offered.withColumns({"n_tokens": count_tokens(f"row.{text}"), "key": key})
    partial = F.col("epoch") == F.col("s.epochs")
    taken = offered.filter(
        (F.col("n_tokens") > 0) & (~partial | F.coalesce(F.col("key") <= F.col("s.cut"), F.lit(False)))
    )
    last = partial & (F.col("key") == F.col("s.cut"))
    return taken.select(
        *[F.col("row")[c].alias(c) for c in kept],
        "epoch",
        "n_tokens",
        F.when(last, F.least("n_tokens", "s.cut_tokens")).otherwise(F.col("n_tokens")).alias("n_taken"),
    )
