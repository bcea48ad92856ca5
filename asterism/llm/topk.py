"""Exact top-k by inner product: the threshold algorithm over sorted lists.

Candidates are ordered by their norm and cut into blocks. In each block every
dimension has a list of the candidates sorted by their component. For a query
the lists are read from their best end in growing steps, each newly seen
candidate gets its full score, and the components at the read positions bound
the score of all unseen ones; reading ends once that bound is below the k-th
best score so far. What is not decided after two steps is read to the end, for
all queries of the task in one product.

Queries come in parts, and parts meet blocks, so a query is copied once for
``CANDIDATES`` vectors. The first block, of the largest norms, gives every query
a k-th score. The other blocks have a box, the range of each dimension: a block
whose box cannot reach the k-th score of any query of a part never moves to it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asterism.llm.common import stored

CANDIDATES = 32768  # vectors of a block, with their sorted lists
QUERIES = 16384  # queries of a part
PRODUCT = 1 << 23  # scores made at a time
DEPTHS = (64, 16)  # the steps read this part of a block's lists


def quantised(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: str) -> Column:
    """No component is null, infinite or not a number."""
    inf = F.lit(float("inf"))
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == inf),
    )
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def _best(rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to the smaller row."""
    if len(rows) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        rows, scores = rows[scores >= least], scores[scores >= least]
    order = np.lexsort((rows, -scores))[:k]
    return rows[order], scores[order]


def _box_bound(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """No vector between ``low`` and ``high`` scores higher."""
    return np.maximum(queries, 0) @ high + np.minimum(queries, 0) @ low


def block_top_k(
    keys: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    queries: np.ndarray,
    own: np.ndarray,
    k: int,
    least: np.ndarray | None = None,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, scores) of the k best candidates of a block for each query, best first.

    Ties go to the smaller id, then key. The candidate whose key is ``own`` is
    the query itself. ``least`` are scores below which candidates do not matter.
    """
    n, dims = vectors.shape
    by_id = np.lexsort((keys, ids))
    keys, vectors = keys[by_id], vectors[by_id]
    least = np.full(len(queries), -np.inf) if least is None else least
    largest = max(np.abs(vectors).max(initial=0), np.abs(queries).max(initial=0))
    if float(largest) ** 2 * max(dims, 1) < 2.0**53:  # then float64 products are exact
        vectors, queries = vectors.astype(np.float64), queries.astype(np.float64)
    found: list = [None] * len(queries)
    none = (np.empty(0, np.int64), np.empty(0, queries.dtype))

    def leave(query: int, rows: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        others = keys[rows] != own[query]
        return _best(rows[others], scores[others], k)

    open_ = np.arange(len(queries))
    if n and dims:
        reach = _box_bound(queries, vectors.min(0), vectors.max(0))
        for query in open_[reach < least]:
            found[query] = none
        open_ = open_[reach >= least]
        order = np.argsort(vectors, axis=0, kind="stable")  # one list per column
        for part in DEPTHS:
            depth = n // part
            if not depth or not len(open_):
                continue
            # What the unseen ones have at most: the components at the read positions.
            last = np.take_along_axis(vectors, order[[n - depth, depth - 1]], 0)
            bound = _box_bound(queries[open_], last[1], last[0])
            near = ~np.isfinite(least[open_]) | (bound <= 2 * np.maximum(least[open_], 0))
            for query, most in zip(open_[near], bound[near], strict=True):
                rising, falling = np.flatnonzero(queries[query] > 0), np.flatnonzero(queries[query] < 0)
                seen = np.zeros(n, bool)
                seen[order[n - depth :, rising]] = True
                seen[order[:depth, falling]] = True
                rows = np.flatnonzero(seen)
                rows, scores = leave(query, rows, vectors[rows] @ queries[query])
                if most < least[query] or (len(rows) == k and scores[-1] > most):
                    found[query] = rows, scores
            open_ = np.array([query for query in open_ if found[query] is None], np.int64)
    step = max(1, PRODUCT // max(n, 1))
    everything = np.arange(n)
    for at in range(0, len(open_), step):
        some = open_[at : at + step]
        for query, scores in zip(some, queries[some] @ vectors.T, strict=True):
            found[query] = leave(query, everything, scores)
    return [(by_id[rows], scores.astype(np.int64)) for rows, scores in found]


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dims).astype(np.int64)


def _boxes(block: pa.Table) -> pa.Table:
    dims = block.column("dims")[0].as_py()
    vectors = _matrix(block.column("vector"), dims)
    row = {"block": block.column("block")[0].as_py(), "dims": dims}
    row |= {"low": vectors.min(0).tolist(), "high": vectors.max(0).tolist()}
    kinds = [("block", pa.int32()), ("dims", pa.int32()), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64()))]
    return pa.Table.from_pylist([row], pa.schema(kinds))


def _met(part: pa.Table, boxes: pa.Table) -> pa.Table:
    """The blocks whose box reaches the k-th score of some query of a part."""
    pairs = []
    if part.num_rows and boxes.num_rows:
        dims = part.column("dims")[0].as_py()
        queries = _matrix(part.column("vector"), dims).astype(np.float64)
        least = part.column("least").to_numpy().astype(float)
        for box in boxes.to_pylist():
            low, high = np.array(box["low"], float), np.array(box["high"], float)
            # Beyond 2**53 a sum of doubles may be off by its last bits.
            bound = _box_bound(queries, low, high) * (1 + 1e-9) if dims else np.zeros(len(queries))
            if (bound + 1 >= least).any():
                pairs.append({"part": part.column("part")[0].as_py(), "block": box["block"]})
    return pa.Table.from_pylist(pairs, pa.schema([("part", pa.int32()), ("block", pa.int32())]))


FOUND = "query bigint, key bigint, id bigint, score bigint"


def _searched(pairs: DataFrame, blocks: DataFrame, parts: DataFrame, k: int) -> DataFrame:
    """(query, key, id, score): the k best of each block for each query of the parts it meets."""

    def search(block: pa.Table, part: pa.Table) -> pa.Table:
        found: dict[str, list] = {"query": [], "key": [], "id": [], "score": []}
        if block.num_rows and part.num_rows:
            dims = block.column("dims")[0].as_py()
            keys, ids = block.column("key").to_numpy(), block.column("id").to_numpy()
            own = part.column("key").to_numpy()
            best = block_top_k(
                keys, ids, _matrix(block.column("vector"), dims), _matrix(part.column("vector"), dims),
                own, k, part.column("least").to_numpy().astype(float),
            )
            places = np.concatenate([rows for rows, _ in best])
            found["query"] = np.repeat(own, [len(rows) for rows, _ in best])
            found["key"], found["id"] = keys[places], ids[places]
            found["score"] = np.concatenate([scores for _, scores in best])
        return pa.table({name: pa.array(values, pa.int64()) for name, values in found.items()})

    key = ["block", "part", "dims"]
    # Few pairs of numbers: as many as there are tasks to do.
    left = blocks.join(pairs, "block").groupBy(*key)
    right = parts.join(pairs, "part").groupBy(*key)
    return left.cogroup(right).applyInArrow(search, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("id"), F.col("key")]
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column | str, k: int) -> DataFrame:
    """The k best candidates of every query by integer inner product.

    ``vectors`` has columns id and vector (array of bigint without nulls); the
    rows for which ``is_query`` holds are queries, all rows are candidates.
    Returns query_id, rank from 1, id and score; ties go to the smaller id. Only
    the query's own row is no candidate: rows that repeat its id or vector are,
    and each row of an id is a query of its own. Fewer rows come back where
    there are fewer candidates. Vectors are compared with those of their own
    length only; vectors without components score 0. Rows with a null id or
    vector take no part; an empty table gives no rows. Other columns are ignored.
    """
    flag = F.expr(is_query) if isinstance(is_query, str) else is_query
    rows = vectors.select("id", "vector", F.coalesce(flag, F.lit(False)).alias("is_query"))
    rows = rows.filter("id IS NOT NULL AND vector IS NOT NULL").withColumns(
        {
            "dims": F.size("vector"),
            "norm": F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x),
            "key": F.monotonically_increasing_id(),
        }
    )
    rows = stored(rows, "vectors")
    n, n_queries = rows.agg(F.count("*"), F.sum(F.col("is_query").cast("bigint"))).first()
    n_blocks, n_parts = (max(1, math.ceil((x or 0) / size)) for x, size in ((n, CANDIDATES), (n_queries, QUERIES)))

    # Largest norms first in each length; a range partition is a block.
    sized = rows.repartitionByRange(n_blocks, "dims", F.col("norm").desc(), "key")
    blocks = stored(sized.select("key", "id", "vector", "dims", F.spark_partition_id().alias("block")), "blocks")
    part = F.pmod(F.xxhash64("key"), F.lit(n_parts)).cast("int").alias("part")
    queries = stored(rows.filter("is_query").select("key", "id", "vector", "dims", part), "queries")
    unknown = F.lit(float("-inf")).alias("least")

    first = blocks.groupBy("dims").agg(F.min("block").alias("block"))
    asked = queries.select("part", "dims").distinct()
    begun = stored(asked.join(first, "dims").select("part", "block").distinct(), "begun")
    found = stored(_searched(begun, blocks, queries.select("*", unknown), k), "found")

    kth = _ranked(found, k).filter(F.col("rank") == k).select(F.col("query").alias("key"), F.col("score").cast("double").alias("least"))
    known = queries.join(kth, "key", "left").withColumn("least", F.coalesce("least", unknown))
    known = stored(known, "known")
    boxes = blocks.groupBy("block", "dims").applyInArrow(
        _boxes, "block int, dims int, low array<bigint>, high array<bigint>"
    )
    boxes = stored(boxes, "boxes")
    # Each part sees the boxes, one row for each block.
    seen = boxes.join(asked, "dims")
    met = known.groupBy("part", "dims").cogroup(seen.groupBy("part", "dims")).applyInArrow(_met, "part int, block int")
    rest = stored(met.distinct().join(begun, ["part", "block"], "left_anti"), "rest")
    more = found
    if not rest.isEmpty():
        more = found.unionByName(stored(_searched(rest, blocks, known, k), "more"))
    names = queries.select(F.col("key").alias("query"), F.col("id").alias("query_id"))
    return _ranked(more, k).join(names, "query").select("query_id", "rank", "id", "score")
