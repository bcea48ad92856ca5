"""JSON columns as VARIANT: read by path, compared by value, parsed once."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from asterism.functions.variant import absent, canonical, same_value, variant_text, variant_value
from asterism.plans.dimensions import populate_dim_users
from asterism.plans.staging import load_posts, load_users
from asterism.sources.records import read_records

NOW = datetime(2024, 1, 1)

EQUAL = [
    ('{"b":1,"a":[1, 2]}', '{ "a" : [1,2], "b" : 1 }'), ('{"a":1,"a":2}', '{"a":2}'), ("1.0", "1"), ("1.50", "1.5"),
    ("[1.00,2]", "[1,2.0]"), ("100", "1e2"), ('"1.0"', '"1.0"'), ("null", " null"), ('{"a":{"y":0.10,"x":-3.0}}', '{"a":{"x":-3,"y":0.1}}'),
]
DIFFERENT = [
    ('"1.0"', '"1"'), ('{"a":"1.0,"}', '{"a":"1,"}'), ("[1,2]", "[2,1]"), ("1", '"1"'), ("null", "0"), ("{}", "[]"),
    ('{"a":null}', "{}"), ("10", "1"), ("1.01", "1.1"), ('{"a":"x\\\\"}', '{"a":"x"}'), ('"a\\"1.0,"', '"a\\"1,"'),
]


def test_values_are_compared_as_values(spark):
    for pairs, same in ((EQUAL, True), (DIFFERENT, False)):
        df = spark.createDataFrame(pairs, "a string, b string").select(F.parse_json("a").alias("a"), F.parse_json("b").alias("b"))
        got = df.select(same_value(F.col("a"), F.col("b")).alias("same"), canonical(F.col("a")), canonical(F.col("b"))).collect()
        assert [tuple(r) for r in got if r.same != same] == []


def test_texts_and_values(spark):
    record = {"s": "x", "n": 5, "b": True, "o": {"k": [1]}, "z": None, "it's": "q", "é.x": "y"}
    df = spark.createDataFrame([(json.dumps(record),)], "r string").select(F.parse_json("r").alias("r"))
    texts = df.select(*[variant_text(F.col("r"), k).alias(k) for k in "snboz"]).first()
    assert tuple(texts) == ("x", "5", "true", '{"k":[1]}', None)
    assert df.select(absent("r", ["s", "z", "gone", "é.x"]).alias("a")).first().a == ["gone"]
    null = df.select(F.is_variant_null(variant_value(F.col("r"), "z")), variant_value(F.col("r"), "gone").isNull()).first()
    assert tuple(null) == (True, True)


def landed(spark, path, records, **options):
    path.mkdir(exist_ok=True)
    (path / "0.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))
    return read_records(spark, str(path), **options)


USERS = [
    {"id": 1, "name": "n", "username": "u", "email": "e", "phone": None, "address": {"city": "Q", "n": 1.0}, "company": None},
    {"id": 2, "name": 5, "username": "u", "email": "e", "phone": 7, "website": "w"},
    {"id": 1, "name": "m", "username": "v", "email": "e", "address": {"n": 1, "city": "R"}, "extra": [1, {"a": None}]},
]


def test_staging_with_variants(spark, tmp_path):
    """The same rows as with text columns, and every record parsed once."""
    texts = load_users(landed(spark, tmp_path / "in", USERS), NOW)
    staged = load_users(landed(spark, tmp_path / "in", USERS, variant=True), NOW)
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson(") == 1 and "from_json" not in plan and "json_object_keys" not in plan
    plain = ["id", "name", "username", "email", "phone", "website"]
    as_json = ["address", "company", "raw_data"]
    staged.write.parquet(str(tmp_path / "staged"))
    stored = spark.read.parquet(str(tmp_path / "staged"))
    got = stored.select(*plain, *[canonical(F.col(c)).alias(c) for c in as_json]).orderBy("id").collect()
    want = texts.select(*plain, *[canonical(F.parse_json(c)).alias(c) for c in as_json]).orderBy("id").collect()
    assert got == want and len(got) == 2
    both = [populate_dim_users(s, NOW).orderBy("user_id").collect() for s in (texts, stored)]
    assert both[0] == both[1] and both[0][0].city == "R"


@pytest.mark.parametrize("bad", ['{"id":1,"userId":1,"title":"t"}', '{"id":"x","userId":1,"title":"t","body":"b"}',
                                 '{"id":1,"userId":1,"title":"t","body":"b"} x', '{"id":1}{"id":2}', "[]", "5", '{"id":1'])
def test_bad_records_fail_as_variants_too(spark, tmp_path, bad):
    good = {"id": 9, "userId": 1, "title": "t", "body": "b"}
    for read in (lambda df: df.count(), lambda df: df.select("title").collect()):
        with pytest.raises(Exception, match="(?i)malformed|required key|holds no int"):
            read(load_posts(landed(spark, tmp_path / "in", [good, bad], variant=True), NOW))


def test_upsert_over_a_variant_target(spark, tmp_path):
    first = load_users(landed(spark, tmp_path / "a", USERS[:2], variant=True), NOW)
    first.write.parquet(str(tmp_path / "t"))
    second = load_users(landed(spark, tmp_path / "b", USERS[2:], variant=True), NOW, spark.read.parquet(str(tmp_path / "t")))
    got = second.select("id", variant_text(F.col("address"), "city").alias("city")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "R"), (2, None)]
