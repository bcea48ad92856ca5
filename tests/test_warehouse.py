import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from asterism.warehouse import Warehouse


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def test_refresh_replaces(spark, warehouse):
    assert warehouse.current() == {} and warehouse.read_or_none("t") is None
    assert warehouse.refresh("t", spark.range(3)).count() == 3
    assert warehouse.refresh("t", spark.range(5)).count() == 5


def test_refresh_from_its_own_contents(spark, warehouse):
    warehouse.refresh("t", spark.range(3))
    doubled = warehouse.read("t").union(warehouse.read("t"))
    assert warehouse.refresh("t", doubled).count() == 6


def test_failed_write_changes_nothing(spark, warehouse):
    warehouse.refresh("t", spark.range(3))
    failing = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        warehouse.refresh("t", failing)
    assert warehouse.read("t").count() == 3


def test_tables_are_published_together(spark, warehouse):
    saved = {name: warehouse.save(name, spark.range(n)) for n, name in enumerate("abc", 1)}
    assert warehouse.current() == {}
    warehouse.publish(saved)
    assert [warehouse.read(name).count() for name in "abc"] == [1, 2, 3]


def test_order_does_not_hang_on_clocks(spark, warehouse, monkeypatch):
    """The second writer's clock is behind; its publication still is the current one and stays."""
    warehouse.refresh("t", spark.range(3))
    now = time.time_ns()
    monkeypatch.setattr(time, "time_ns", lambda: now - 10**12)
    monkeypatch.setattr(time, "time", lambda: now / 1e9 - 1000)
    late = Warehouse(spark, warehouse.root)
    assert late.refresh("t", spark.range(5)).count() == 5
    assert len(late.history()) == 2
    late.drop_superseded()
    assert warehouse.read("t").count() == 5
    assert [f"t/{v}" for v in versions(warehouse)] == [warehouse.current()["t"]]


def test_two_writers_at_once(spark, warehouse, monkeypatch):
    """The one whose row is not the last is told, and its version can be discarded."""
    warehouse.refresh("t", spark.range(3))
    a, b = Warehouse(spark, warehouse.root), Warehouse(spark, warehouse.root)
    saved = [w.save("t", spark.range(n)) for w, n in ((a, 5), (b, 7))]
    known, real = a._publications(), Warehouse._publications
    answers = iter([known])
    monkeypatch.setattr(a, "_publications", lambda: next(answers, None) or real(a))
    b.publish({"t": saved[1]})
    if saved[0] > saved[1]:
        a.publish({"t": saved[0]})
        assert warehouse.read("t").count() == 5
        return
    with pytest.raises(RuntimeError, match="another writer"):
        a.publish({"t": saved[0]})
    a.discard()
    warehouse.drop_superseded()
    assert warehouse.read("t").count() == 7


def versions(warehouse, name="t"):
    return sorted(path.name for path in Path(warehouse.root, name).iterdir())


def test_superseded_versions_are_dropped(spark, warehouse):
    warehouse.refresh("t", spark.range(3))
    reader = warehouse.read("t")
    warehouse.refresh("t", spark.range(5))
    assert reader.count() == 3
    warehouse.drop_superseded()
    assert [f"t/{v}" for v in versions(warehouse)] == [warehouse.current()["t"]]
    assert warehouse.read("t").count() == 5


def test_foreign_folders_stay(spark, warehouse):
    warehouse.refresh("t", spark.range(3))
    warehouse.refresh("t", spark.range(5))
    foreign = [Path(warehouse.root, *p) for p in (("landing", "v-2024"), ("t", "v-mine"))]
    for folder in foreign:
        folder.mkdir(parents=True)
    warehouse.drop_superseded()
    assert all(folder.exists() for folder in foreign)
    assert len(versions(warehouse)) == 2


def test_nothing_is_deleted_without_a_record(spark, warehouse, caplog):
    """Also after a crash between writing and publishing."""
    warehouse.save("t", spark.range(7))
    caplog.set_level("INFO")
    Warehouse(spark, warehouse.root).drop_superseded()
    assert len(versions(warehouse)) == 1 and "nothing is deleted" in caplog.text
    warehouse.refresh("t", spark.range(3))
    Warehouse(spark, warehouse.root).drop_superseded()
    assert len(versions(warehouse)) == 2 and warehouse.read("t").count() == 3


def test_unreadable_record_stops_everything(spark, warehouse):
    warehouse.refresh("t", spark.range(3))
    warehouse.refresh("t", spark.range(5))
    (Path(warehouse.root) / "publications" / "part-torn.json").write_text('{"version":')
    for use in (warehouse.drop_superseded, warehouse.current, lambda: warehouse.read("t")):
        with pytest.raises(ValueError, match="cannot be read"):
            use()
    assert len(versions(warehouse)) == 2


def test_discard_deletes_own_unpublished_versions(spark, warehouse):
    warehouse.refresh("t", spark.range(3))
    warehouse.save("t", spark.range(7))
    warehouse.discard()
    assert [f"t/{v}" for v in versions(warehouse)] == [warehouse.current()["t"]]


def test_bucketed_save_writes_a_file_for_each_bucket(spark, warehouse):
    rows = spark.range(1000, numPartitions=6)
    folder, entry = warehouse.save_bucketed("t", rows, "id", 16)
    try:
        files = [p for p in Path(warehouse.root, folder).iterdir() if p.name.startswith("part-")]
        assert len(files) <= 16 and warehouse.open(folder).count() == 1000
    finally:
        spark.sql(f"DROP TABLE {entry}")


def test_views(spark, warehouse):
    warehouse.refresh("users", spark.range(10))
    assert warehouse.create_views() == ["users"]
    assert spark.sql("SELECT * FROM users").count() == 10
