"""Joins on a key that holds a third of the rows are split at run time."""

import pytest
from pyspark.sql import functions as F

from asterism.operators.checks import fk_orphans
from asterism.operators.dml import distinct_keys, merge
from asterism.plans.facts import lookup_keys

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
N = 300_000


@pytest.fixture(autouse=True)
def small_partitions(spark):
    saved = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def skewed(spark, tmp_path):
    """Rows read back from several files; every third has key 1."""
    path = str(tmp_path / "skewed")
    rows = spark.range(N).selectExpr(
        "cast(id as int) post_id", "if(id % 3 = 0, 1, cast(id % 50000 + 2 as int)) k", "uuid() v"
    )
    rows.repartition(12).write.parquet(path)
    return spark.read.parquet(path)


def run_and_plan(df):
    """Execute once; the number of rows and the final plan."""
    rows = len(df.toArrow())
    return rows, df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_lookup_of_a_hot_user(spark, skewed):
    users = spark.range(60_000).selectExpr("cast(id as int) user_id", "cast(id + 5 as int) user_key")
    rows, plan = run_and_plan(lookup_keys(skewed.withColumnRenamed("k", "user_id"), users))
    assert rows == N and "skew=true" in plan


def test_foreign_key_check(spark, skewed):
    parents = spark.range(2, 60_000).selectExpr("cast(id as int) k")
    rows, plan = run_and_plan(fk_orphans(skewed, "k", parents, "k"))
    assert rows == N // 3 and "skew=true" in plan


def test_merge_of_a_hot_unmatched_key(spark, skewed):
    target = spark.range(60_000, 120_000).selectExpr("cast(id as int) k", "'t' v")
    rows, plan = run_and_plan(merge(target, skewed.select("k", "v"), "k", update=["v"]))
    assert rows == N + target.count() and "skew=true" in plan


def test_merge_into_a_hot_target_key(spark, skewed):
    batch = spark.range(1, 100_000).select(F.col("id").cast("int").alias("k"), F.lit("new").alias("v"))
    merged = merge(skewed.select("k", "v"), batch, "k", update=["v"], unique=True)
    rows, plan = run_and_plan(merged)
    assert rows == N + batch.count() - skewed.select("k").distinct().count() and "skew=true" in plan


def test_merge_of_repeated_keys_into_a_hot_target_key(spark, skewed):
    target = skewed.select("k", "v")
    batch = spark.range(1, 100_000).selectExpr("cast(id as int) k", "'new' v")
    unmatched = spark.range(1_000).selectExpr("-1 k", "'copy' v")
    rows, plan = run_and_plan(merge(target, batch.union(unmatched), "k", update=["v"]))
    known = target.select("k").distinct().count()
    assert rows == N + batch.count() - known + 1_000 and "skew=true" in plan


def test_foreign_key_check_against_a_feed(spark, skewed):
    """Neither the child's nor the feed's hot key ends up in one task."""
    feed = distinct_keys(skewed.filter("k > 1 or post_id % 2 = 0"), "k")
    rows, plan = run_and_plan(fk_orphans(skewed, "k", feed.filter("k <> 1"), "k"))
    assert rows == N // 3 and "skew=true" in plan
