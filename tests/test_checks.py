import pytest

from asterism.operators.audit import counted, row_counts
from asterism.operators.checks import (
    ConstraintViolation,
    assign_varchars,
    enforce,
    fk_orphans,
    not_null_violations,
    unique_violations,
    varchar_violations,
)


def test_unique(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "a int, b int")
    assert rows(unique_violations(df, ["a", "b"])) == [(1, 1, 2)]  # NULLs may repeat
    assert unique_violations(df.distinct(), ["a", "b"]).isEmpty()


def test_not_null(spark, rows):
    df = spark.createDataFrame([(1, 1), (None, 2), (3, None)], "a int, b int")
    assert rows(not_null_violations(df, ["a", "b"])) == [(None, 2), (3, None)]
    assert rows(not_null_violations(df, ["a"])) == [(None, 2)]


def test_foreign_key(spark, rows):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (11,), (10,)], "k int")
    assert rows(fk_orphans(child, "fk", parent, "k"), "id", "fk") == [(2, 99)]


def test_varchar(spark, rows):
    long, padded = "x" * 101, "y" * 100 + "  "
    df = spark.createDataFrame([(1, long), (2, padded), (3, None), (4, "ok ")], "id int, name string")
    assert rows(varchar_violations(df, {"name": 100}), "id") == [(1,)]
    fitted = assign_varchars(df.filter("id > 1"), {"name": 100})
    assert rows(fitted) == [(2, "y" * 100), (3, None), (4, "ok ")]
    broken = assign_varchars(df, {"name": 100})
    for read in (broken.collect, broken.count, broken.select("id").collect):
        with pytest.raises(Exception, match="too long for 'name'"):
            read()


def test_modes(spark):
    bad, good = spark.range(3), spark.range(0)
    assert enforce(bad, "rule", "report").count() == 3
    assert enforce(good, "rule").count() == 0
    with pytest.raises(ConstraintViolation, match="rule"):
        enforce(bad, "rule")
    with pytest.raises(ValueError):
        enforce(bad, "rule", "ignore")


def test_counts(spark, rows):
    assert rows(row_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]
    df, seen = counted(spark.range(100), "rows")
    assert df.filter("id < 3").count() == 3
    assert seen.get["rows"] == 100
