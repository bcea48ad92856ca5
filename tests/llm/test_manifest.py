"""The Merkle manifest against a plain model."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from asterism.llm import manifest as mf

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lower(text):
    return text and text.translate({c: c + 32 for c in range(65, 91)})


def tree(nodes, fan):
    """Top, and for each node the (before, after) of every level."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            start = at - at % fan
            paths[i].append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + fan])))
            where[i] = at // fan
        nodes = [h("".join(nodes[at : at + fan])) for at in range(0, len(nodes), fan)]
    return nodes[0] if nodes else None, paths


def model(rows, fan=16):
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    subs, out = {}, []
    for source, found in sources.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs[source] = (*tree([leaf(r) for r in found], fan), found)
    order = sorted(subs, key=lambda s: (s is not None, (s or "").encode()))
    root, above = tree([subs[s][0] for s in order], fan)
    for source, rest in zip(order, above, strict=True):
        top, paths, found = subs[source]
        for row, path in zip(found, paths, strict=True):
            path = path + rest
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf((*row[:4], lower(row[4])) if bad else row)
            for before, after in path:
                node = h(before + node + after)
            proof = h("".join(b + a for b, a in path))
            out.append((row[0], leaf(row), top, root, proof, node, node == root))
    return sorted(out, key=str)


def judged(spark, rows, shape, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).repartition(3)
    bad = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    seen = {"text": F.when(bad, F.translate("text", *CASES)).otherwise(F.col("text"))}
    return sorted(map(tuple, mf.manifest(df, seen=seen, shape=shape).collect()), key=str)


CASES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def some_rows(n):
    rows = [(i * 7 - 20, f"s{i % 4}" if i % 9 else "s0", "en", i, f"Text {i} É") for i in range(n)]
    rows += [(2**60 + 1, None, None, None, None), (2**60 + 2, None, "", 0, ""), (None, "s0", "en", 1, "No Id")]
    rows += [(None, "s0", "en", 1, "No Id"), (3, "ünï", "en", 2, "X"), (3, "ünï", "de", 2, "Y"), (3, "", "-", 2, "Z")]
    return rows + rows[:5]


@pytest.mark.parametrize("fan, height", [(2, 1), (2, 3), (3, 2), (16, 3)])
def test_by_a_plain_model(spark, fan, height):
    """Small shapes have many superblocks and several rounds."""
    rows = some_rows(60)
    assert judged(spark, rows, mf.Shape(fan, height)) == model(rows, fan)


def test_many_sources_and_one_hot_one(spark):
    rows = [(i, f"only{i}", "en", 1, "T") for i in range(50)] + [(i, "hot", "en", 1, "T") for i in range(100)]
    assert judged(spark, rows, mf.Shape(3, 1)) == model(rows, 3)


def test_edge_tables(spark):
    """Empty, one row, equal rows, a long text, other columns with the operator's names."""
    assert judged(spark, [], mf.Shape()) == []
    one = [(5, "s", "en", 1, "Aa")]
    (row,) = judged(spark, one, mf.Shape())
    assert row[1] == row[2] == row[3] == leaf(one[0]) and row[4] == h("")
    same = [(1, "s", "en", 1, "A b")] * 40
    assert judged(spark, same, mf.Shape(2, 1)) == model(same, 2)
    rows = [(i, "s", "en", 3, "Long word " * 300_000) for i in range(3)]
    more = [(*r, "x", 1, "y", 2.0) for r in rows]
    extra = SCHEMA + ", leaf string, pos int, `group` string, ROOT double"
    assert judged(spark, more, mf.Shape(), extra) == model(rows)


def test_proofs_in_full(spark):
    df = spark.createDataFrame(some_rows(20), SCHEMA)
    full = mf.manifest(df, keep_proofs=True, shape=mf.Shape(2, 2)).collect()
    short = mf.manifest(df, shape=mf.Shape(2, 2)).collect()
    assert sorted(h(r.proof) for r in full) == sorted(r.proof_sha256 for r in short)
    assert all(r.verified for r in full)
