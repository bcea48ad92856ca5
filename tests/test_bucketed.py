"""MERGE into a bucketed table: results, and a plan that does not shuffle the target."""

import uuid

import pytest
from pyspark.sql import functions as F

from asterism.operators.bucketed import buckets_of, merge_bucketed, merged, write_bucketed
from asterism.operators.checks import ConstraintViolation
from asterism.operators.dml import merge


@pytest.fixture
def entry(spark, tmp_path):
    """Names of tables that are dropped afterwards; files stay in the test's folder."""
    made = []

    def name():
        made.append(f"t_{uuid.uuid4().hex}")
        return made[-1], str(tmp_path / made[-1])

    yield name
    for one in made:
        spark.sql(f"DROP TABLE IF EXISTS {one}")


def target_rows(spark, n=2000):
    return spark.range(n).selectExpr("id", "concat('v', id) AS v", "'old' AS w", "0 AS loads")


def batch_rows(spark):
    rows = [(i, f"new{i}") for i in range(0, 4000, 7)] + [(5000, None)]
    return spark.createDataFrame(rows, "id bigint, v string")


OPTIONS = {"update": ["v"], "stamp": {"w": "hit"}, "defaults": {"w": "made", "loads": 1}}


def options():
    return {k: {n: F.lit(v) for n, v in o.items()} if k != "update" else o for k, o in OPTIONS.items()}


def test_merge_matches_the_general_one(spark, entry, rows):
    (one, place), (two, other) = entry(), entry()
    write_bucketed(target_rows(spark), one, place, "id", 8)
    assert buckets_of(spark, one, "id") == 8
    merge_bucketed(spark, one, batch_rows(spark), "id", two, other, **options())
    general = merge(target_rows(spark), batch_rows(spark), "id", unique_target=True, **options())
    assert rows(spark.table(two)) == rows(general.select("id", "v", "w", "loads"))
    assert buckets_of(spark, two, "id") == 8
    # The outcome is a target like the first: again, nothing changes but the stamp.
    (three, third) = entry()
    merge_bucketed(spark, two, batch_rows(spark), "id", three, third, **options())
    assert rows(spark.table(three), "id", "v") == rows(spark.table(two), "id", "v")


def test_the_target_is_not_shuffled(spark, entry, tmp_path):
    one, place = entry()
    write_bucketed(target_rows(spark), one, place, "id", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        plan = merged(spark.table(one), batch_rows(spark), "id", **options())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    # The one exchange is above the batch.
    left, right = plan.split("Exchange")
    assert "Bucketed: true" in left and "Bucketed: true" not in right


def test_files_are_one_for_each_bucket(spark, entry, tmp_path):
    (one, place), (two, other) = entry(), entry()
    write_bucketed(target_rows(spark), one, place, "id", 8)
    merge_bucketed(spark, one, batch_rows(spark), "id", two, other, **options())
    files = [p for p in (tmp_path / two).iterdir() if p.name.startswith("part-")]
    assert len(files) == 8


def test_bad_batches_and_tables(spark, entry):
    one, place = entry()
    write_bucketed(target_rows(spark), one, place, "id", 4)
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id bigint, v string")
    with pytest.raises(ConstraintViolation, match="repeats id"):
        merge_bucketed(spark, one, twice, "id", *entry(), **options())
    null = spark.createDataFrame([(None, "a")], "id bigint, v string")
    with pytest.raises(Exception, match="null value in key"):
        merge_bucketed(spark, one, null, "id", *entry(), **options())
    with pytest.raises(ValueError, match="not bucketed by v"):
        merge_bucketed(spark, one, twice, "v", *entry(), update=["id"])
