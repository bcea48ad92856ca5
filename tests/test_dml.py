import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from asterism.operators.dml import (
    insert_ignore,
    last_per_key,
    materialize,
    merge,
    upsert_sequential,
    upsert_set,
    with_defaults,
)

POSTS = "id int, title string, n int"
DIM = "user_key int, user_id int, email string, valid_from string, updated_at string"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def dim_upsert(spark, target, batch, **options):
    return upsert_set(
        target, batch, "user_id", update=["email"], stamp={"updated_at": F.lit("now")},
        defaults={"valid_from": F.lit("now"), "updated_at": F.lit("now")},
        schema=frame(spark, [], DIM).schema, serial="user_key", **options,
    )


def test_sequential_last_row_wins_whole(spark, rows):
    batch = frame(spark, [(1, "a", 1, 0), (2, "b", 2, 1), (1, None, 3, 2)], POSTS + ", seq int")
    schema = batch.drop("seq").schema
    assert rows(upsert_sequential(None, batch, "id", "seq", schema=schema)) == [
        (1, None, 3), (2, "b", 2),
    ]
    target = frame(spark, [(1, "old", 9), (5, "kept", 5)], POSTS)
    assert rows(upsert_sequential(target, batch, "id", "seq")) == [
        (1, None, 3), (2, "b", 2), (5, "kept", 5),
    ]


def test_sequential_stamps_and_defaults(spark, rows):
    target = frame(spark, [(1, "x", "then"), (2, "y", "then")], "id int, t string, at string")
    batch = frame(spark, [(1, "z", 0), (3, "w", 1)], "id int, t string, seq int")
    now = {"at": F.lit("now")}
    assert rows(upsert_sequential(target, batch, "id", "seq", stamp=now, defaults=now)) == [
        (1, "z", "now"), (2, "y", "then"), (3, "w", "now"),
    ]


def test_null_key_fails(spark):
    target = frame(spark, [(1, "a", 1)], POSTS)
    batch = frame(spark, [(None, "a", 1), (2, "b", 1)], POSTS)
    seq = batch.withColumn("seq", F.lit(1))
    for write in (
        lambda t: upsert_sequential(t, seq, "id", "seq", schema=target.schema),
        lambda t: upsert_set(t, batch, "id", update=["title", "n"], schema=target.schema),
        lambda t: insert_ignore(t, batch, "id", schema=target.schema),
        lambda t: merge(t, batch, "id", update=["title"], schema=target.schema),
    ):
        for existing in (None, target):
            with pytest.raises(Exception, match="null value in key column 'id'"):
                write(existing).collect()
    with pytest.raises(Exception, match="null value in key column"):
        dim_upsert(spark, None, frame(spark, [(None, "e")], "user_id int, email string")).collect()


def readings(df):
    """Ways to read a frame that leave out most of it."""
    return [df.count, *[df.select(name).collect for name in df.columns]]


def fails_however_read(write, match):
    """The write fails at once, or whichever of its columns is read, or none."""
    with pytest.raises(Exception, match=match):
        df = write()
        for read in readings(df):
            with pytest.raises(Exception, match=match):
                read()
        raise AssertionError(match)


def test_failures_do_not_depend_on_the_columns_read(spark):
    target = frame(spark, [(1, "a", 1)], POSTS)
    nulls = frame(spark, [(None, "a", 1), (2, "b", 1)], POSTS)
    repeated = frame(spark, [(1, "a", 1), (1, "b", 2)], POSTS)
    fresh = frame(spark, [(5, "a", 1), (5, "b", 2)], POSTS)
    options = {"schema": target.schema}
    for existing in (None, target):
        for write in (
            lambda t: upsert_sequential(t, nulls.withColumn("s", F.lit(1)), "id", "s", **options),
            lambda t: upsert_set(t, nulls, "id", update=["title", "n"], **options),
            lambda t: insert_ignore(t, nulls, "id", **options),
            lambda t: merge(t, nulls, "id", update=["title"], **options),
        ):
            fails_however_read(lambda: write(existing), "null value in key column 'id'")  # noqa: B023
        for batch in (repeated, fresh):
            fails_however_read(
                lambda: upsert_set(existing, batch, "id", update=["title"], **options),  # noqa: B023
                "batch repeats id",
            )
    fails_however_read(lambda: merge(target, repeated, "id", update=["title"]), "batch repeats id")


def test_plans_do_not_sort_to_aggregate(spark):
    target = frame(spark, [(1, "a", 1)], POSTS)
    batch = frame(spark, [(1, "b", 2), (3, "c", 3)], POSTS)
    for df in (
        upsert_set(target, batch, "id", update=["title", "n"], distinct=True),
        upsert_set(target, batch, "id", update=["title", "n"]),
        merge(target, batch, "id", update=["title", "n"]),
    ):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_set_upsert_updates_in_place(spark, rows):
    target = frame(spark, [(7, 1, "old", "then", "then"), (9, 2, "kept", "then", "then")], DIM)
    batch = frame(spark, [(1, "new"), (3, "c"), (4, None)], "user_id int, email string")
    assert rows(dim_upsert(spark, target, batch)) == [
        (7, 1, "new", "then", "now"),
        (9, 2, "kept", "then", "then"),
        (10, 3, "c", "now", "now"),
        (11, 4, None, "now", "now"),
    ]


def test_null_in_batch_overwrites(spark, rows):
    target = frame(spark, [(1, "123", 1)], POSTS)
    batch = frame(spark, [(1, None)], "id int, title string")
    assert rows(upsert_set(target, batch, "id", update=["title"])) == [(1, None, 1)]
    assert rows(merge(target, batch, "id", update=["title"])) == [(1, None, 1)]


@pytest.mark.parametrize("key", [1, 3])
def test_set_upsert_repeated_key_fails(spark, key):
    target = frame(spark, [(7, 1, "old", "then", "then")], DIM)
    batch = frame(spark, [(key, "a"), (key, "a")], "user_id int, email string")
    for existing in (None, target):
        with pytest.raises(Exception, match=f"batch repeats user_id = {key}"):
            dim_upsert(spark, existing, batch).collect()


def test_set_upsert_of_distinct_rows(spark, rows):
    batch = frame(spark, [(1, None), (1, None), (2, "b"), (2, "b")], "user_id int, email string")
    assert rows(dim_upsert(spark, None, batch, distinct=True), "user_key", "user_id", "email") == [
        (1, 1, None), (2, 2, "b"),
    ]
    for other in ("c", None):
        differing = batch.union(frame(spark, [(2, other)], batch.schema))
        with pytest.raises(Exception, match="batch repeats user_id = 2"):
            dim_upsert(spark, None, differing, distinct=True).collect()


def test_insert_ignore(spark, rows):
    target = frame(spark, [(1, "old", 1), (5, "only here", 5)], POSTS)
    batch = frame(spark, [(1, "new", 2), (2, "b", 1), (2, "b", 1), (3, "c", 9), (3, "d", 9)], POSTS)
    found = rows(insert_ignore(target, batch, "id"))
    assert [row[0] for row in found] == [1, 2, 3, 5]
    assert found[0] == (1, "old", 1) and found[2] in [(3, "c", 9), (3, "d", 9)]
    assert [row[0] for row in rows(insert_ignore(None, batch, "id", schema=target.schema))] == [1, 2, 3]


FACT = "post_key int, post_id int, price int, created_at string, updated_at string"


def fact_merge(spark, target, batch, **options):
    now = F.lit("now")
    return merge(
        target, batch, "post_id", update=["price"], stamp={"updated_at": now},
        defaults={"created_at": now, "updated_at": now},
        schema=frame(spark, [], FACT).schema, serial="post_key", **options,
    )


def test_merge_updates_inserts_keeps(spark, rows):
    target = frame(
        spark, [(1, 10, 1, "then", "then"), (2, 20, 2, "then", "then"), (3, 20, 3, "then", "then")],
        FACT,
    )
    batch = frame(spark, [(20, 5), (30, 6), (25, 7)], "post_id int, price int")
    for unique in (False, True):
        found = rows(fact_merge(spark, target, batch, unique=unique))
        assert found[:3] == [
            (1, 10, 1, "then", "then"), (2, 20, 5, "then", "now"), (3, 20, 5, "then", "now"),
        ]
        assert sorted(row[0] for row in found[3:]) == [4, 5]
        assert sorted(row[1:] for row in found[3:]) == [(25, 7, "now", "now"), (30, 6, "now", "now")]
        if unique:
            assert found[3][1] == 25  # numbered in key order


def test_merge_repeated_key(spark, rows):
    target = frame(spark, [(1, 10, 1, "then", "then")], FACT)
    batch = frame(spark, [(10, 5), (10, 6)], "post_id int, price int")
    with pytest.raises(Exception, match="batch repeats post_id = 10"):
        fact_merge(spark, target, batch).collect()
    batch = frame(spark, [(30, 5), (30, 5), (30, 6)], "post_id int, price int")
    found = rows(fact_merge(spark, target, batch))
    assert [row[0] for row in found] == [1, 2, 3, 4]
    assert sorted(row[1:3] for row in found) == [(10, 1), (30, 5), (30, 5), (30, 6)]


def test_merge_batch_holding_one_hot_key(spark):
    """A third of the batch is copies of one unmatched row."""
    target = spark.range(5_000).selectExpr("cast(id as int) post_id", "1 price")
    cold = spark.range(4_000, 14_000).selectExpr("cast(id as int) post_id", "2 price")
    hot = spark.range(5_000).selectExpr("-1 post_id", "3 price")
    schema = "post_key int, post_id int, price int"
    found = merge(
        None, cold.union(hot), "post_id", serial="post_key", schema=frame(spark, [], schema).schema
    )
    assert found.agg(F.countDistinct("post_key"), F.min("post_key"), F.max("post_key")).first() == (
        15_000, 1, 15_000,
    )
    merged = merge(target, cold.union(hot), "post_id", update=["price"])
    counts = {row.price: row["count"] for row in merged.groupBy("price").count().collect()}
    assert counts == {1: 4_000, 2: 10_000, 3: 5_000}


def test_merge_into_target_holding_one_hot_key(spark):
    """A third of the target shares the key of one batch row."""
    target = spark.range(15_000).selectExpr("if(id % 3 = 0, -1, cast(id as int)) post_id", "1 price")
    batch = spark.range(14_000, 16_000).selectExpr("cast(id as int) post_id", "2 price")
    batch = batch.union(spark.sql("SELECT -1 post_id, 3 price"))
    merged = merge(target, batch, "post_id", update=["price"], unique=True)
    counts = {row.price: row["count"] for row in merged.groupBy("price").count().collect()}
    updated = sum(1 for i in range(14_000, 15_000) if i % 3)
    inserted = 1_000 + sum(1 for i in range(14_000, 15_000) if i % 3 == 0)
    assert counts == {1: 10_000 - updated, 2: updated + inserted, 3: 5_000}


def test_last_per_key_with_hot_key(spark):
    feed = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) k", "id seq", "cast(id as string) v")
    last = last_per_key(feed, "k", "seq")
    assert last.count() == 20_001
    assert last.filter("k = 0").first().v == "29997"


def test_with_defaults(spark):
    batch = frame(spark, [(1, None)], "id int, n int")
    schema = frame(spark, [], "id bigint, n int, at string, flag boolean").schema
    found = with_defaults(batch, schema, {"n": F.lit(5), "at": F.lit("now")})
    assert found.first() == (1, None, "now", None)
    assert found.schema.simpleString() == schema.simpleString()


def test_materialize(spark, rows):
    batch = frame(spark, [(1, "a", None)], POSTS)
    stored = materialize(batch)
    assert rows(stored) == [(1, "a", None)]
    assert stored.inputFiles()


KEYED = st.lists(
    st.tuples(st.integers(0, 6), st.one_of(st.none(), st.sampled_from("abc"))), max_size=12
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(KEYED, KEYED)
def test_sequential_upsert_invariants(spark, old, new):
    """Against a dictionary written row by row."""
    expected = dict(old)
    target = frame(spark, list(expected.items()), "id int, v string")
    batch = frame(spark, [(*row, i) for i, row in enumerate(new)], "id int, v string, seq int")
    once = upsert_sequential(target, batch, "id", "seq")
    expected.update(new)
    found = [tuple(row) for row in once.collect()]
    assert dict(found) == expected and len(found) == len(expected)
    again = upsert_sequential(once, batch, "id", "seq")
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(KEYED, KEYED)
def test_merge_invariants(spark, old, new):
    """Against the rule spelled out: fail, update in place, insert all, keep the rest."""
    target = frame(spark, old, "id int, v string")
    batch = frame(spark, new, "id int, v string")
    known, keys = {key for key, _ in old}, [key for key, _ in new]
    if any(key in known and keys.count(key) > 1 for key in keys):
        with pytest.raises(Exception, match="batch repeats id"):
            merge(target, batch, "id", update=["v"]).collect()
        return
    merged = merge(target, batch, "id", update=["v"])
    changed = dict(new)
    expected = [(key, changed.get(key, value)) for key, value in old]
    expected += [row for row in new if row[0] not in known]
    assert sorted(map(str, merged.collect())) == sorted(
        f"Row(id={key}, v={value!r})" for key, value in expected
    )


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(KEYED, KEYED)
def test_insert_ignore_invariants(spark, old, new):
    existing = dict(old)
    target = frame(spark, list(existing.items()), "id int, v string")
    once = insert_ignore(target, frame(spark, new, "id int, v string"), "id")
    found = [tuple(row) for row in once.collect()]
    assert len(found) == len({key for key, _ in found}) == len(existing.keys() | dict(new).keys())
    assert all(row in (existing.items() if row[0] in existing else new) for row in found)


def test_merge_of_narrow_rows_is_dealt_to_small_tasks(spark, tmp_path):
    """Compressed rows are a tenth of what they take in a sort, so tasks are cut by few bytes."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": "64",
    }
    n, saved = 3_000_000, {key: spark.conf.get(key, None) for key in settings}
    spark.range(n).selectExpr("id k", "rand(1) v").write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    target = spark.range(-1_000, 1_000).selectExpr("id k", "0D v")
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = merge(target, batch, "k", update=["v"], unique=True, unique_target=True)
        task = F.spark_partition_id().alias("task")
        # The sum keeps the values in the shuffle.
        tasks = found.groupBy(task).agg(F.count("*").alias("n"), F.sum("v")).toPandas()["n"]
    finally:
        for key, value in saved.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert tasks.sum() == n + 1_000 and tasks.max() < n * 0.6
