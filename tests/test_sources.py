import json
from datetime import date

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from asterism.functions.json import json_text, parse_fields, record_schema
from asterism.operators.dml import last_per_key
from asterism.sources import arrays
from asterism.sources.calendar import date_series
from asterism.sources.records import read_records, read_typed


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines), encoding="utf-8")


def test_lines(spark, tmp_path):
    write(tmp_path / "in" / "a.json", '{"id":1,"x":null} ', "", ' {"id":2,"id":3}')
    found = read_records(spark, str(tmp_path / "in")).select("record").collect()
    assert [row[0] for row in found] == ['{"id":1,"x":null}', '{"id":2,"id":3}']


def test_array_files(spark, tmp_path):
    write(tmp_path / "in" / "a.json", '[{"id":1},', '{"id":2}]')
    write(tmp_path / "in" / "b.json", '[{"id":1}, {"id":4}]')
    write(tmp_path / "in" / "c.json", "[]")
    found = read_records(spark, str(tmp_path / "in"), "array").orderBy("arrival")
    ids = [row[0] for row in found.select(json_text("record", "id").cast("int")).collect()]
    assert ids == [1, 2, 1, 4]


def test_unknown_layout(spark, tmp_path):
    with pytest.raises(ValueError):
        read_records(spark, str(tmp_path), "csv")


def test_payload_order_across_splits(spark, tmp_path):
    """Many small splits, read by tasks in any order: the last record still wins."""
    n, keys = 20_000, 7
    for part in range(2):
        lines = [json.dumps({"id": i % keys, "n": part * n + i}) for i in range(n)]
        write(tmp_path / "in" / f"{part}.json", *lines)
    saved = {
        key: spark.conf.get(key)
        for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    }
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        records = read_records(spark, str(tmp_path / "in"))
        batch = records.select(
            json_text("record", "id").cast("int").alias("id"),
            json_text("record", "n").cast("int").alias("n"),
            "arrival",
        )
        assert batch.rdd.getNumPartitions() > 8
        ordered = [row.n for row in batch.repartition(5).orderBy("arrival").collect()]
        assert ordered == list(range(2 * n))
        last = {row.id: row.n for row in last_per_key(batch, "id", "arrival").collect()}
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)
    assert last == {i % keys: n + i for i in range(n)}


MALFORMED = [
    ("lines", '{"id":1}\n{"id":'),
    ("lines", '{"id":1} x'),
    ("lines", "{id}"),
    ("lines", '[{"id":1}]'),
    ("lines", "null"),
    ("lines", "5"),
    ("lines", '{"id":1}{"id":2}'),
    ("lines", '{"id":1},{"id":2}'),
    ("lines", '{"id":1},"end":true,"x":{"id":2}'),
    ("lines", '{"id":3} trailing }'),
    ("lines", '{"id":3}} trailing }'),
    ("lines", '{"id":3}],[{"id":4}'),
    ("array", '[{"id":1},'),
    ("array", '{"id":1}'),
    ("array", "[5]"),
    ("array", '[{"id":5}][{"id":6}]'),
    ("array", '[{"id":5}],[{"id":6}]'),
    ("array", '[{"id":5}],"b":[{"id":6}]'),
    ("array", '[{"id":5}] garbage'),
    ("array", '[{"id":5}]} x'),
    ("array", '[{"id":5]}'),
    ("array", ""),
]


@pytest.mark.parametrize("layout, text", MALFORMED)
def test_malformed_fails(spark, tmp_path, layout, text):
    """However much is read of the records; nothing after a record is dropped."""
    write(tmp_path / "in" / "a.json", text)
    for read in (
        lambda records: records.select(parse_fields("record", ["id"])).collect(),
        lambda records: records.count(),
        lambda records: records.select("arrival").collect(),
    ):
        with pytest.raises(Exception, match="(?i)malformed"):
            read(read_records(spark, str(tmp_path / "in"), layout))


@pytest.mark.parametrize("end", ["", "\t", " \t", "\r"])
def test_blanks_around_records(spark, tmp_path, end):
    write(tmp_path / "in" / "a.json", '\t{"id":1}' + end, end, '{"id":2}' + end)
    found = read_records(spark, str(tmp_path / "in")).orderBy("arrival").select("record").collect()
    assert [row[0] for row in found] == ['{"id":1}', '{"id":2}']
    write(tmp_path / "array" / "a.json", '\n[{"id":1}]' + end + "\n")
    assert read_records(spark, str(tmp_path / "array"), "array").count() == 1


# Places where a split may begin: strings with brackets, quotes and escapes, nesting, blanks.
RECORDS = [
    {"id": 1, "t": 'quote " and bracket } and [ in {text'},
    {"id": 2, "t": "back\\slash \\\\", "n": {"a": {"b": [{"c": "}"}, {}]}}},
    {"id": 3, "t": '\\"}', "empty": {}, "list": [[], [{}]]},
    {"id": 4, "t": "", "long": "}{" * 150},
    {"id": 5, "t": "é😀}", '}"{': None},
]


def cut_by_hand(text, split):
    """The records of one file as the tasks of its splits cut them, without Spark."""
    data = text.encode()
    pieces, at = [], 0
    while at < len(data):  # a split holds the pieces that begin in it
        end = data.find(b"}", at)
        stop = end if end >= 0 else len(data)
        home = 0 if at == 0 else (at - 1) // split * split
        pieces.append((home, len(pieces), data[at:stop].decode()))
        at = stop + 1
    rows = [
        {"file": "f", "split": s, "size": len(data), "row": n, "bytes": len(v.encode()), "value": v} for s, n, v in pieces
    ]

    def batch(rows):
        return pa.RecordBatch.from_pylist(rows)

    tasks = [batch([r for r in rows if r["split"] == s]) for s in sorted({r["split"] for r in rows})]
    effects = pa.Table.from_batches([out for task in tasks for out in arrays._effects(iter([task]))])
    starts = {row["split"]: row for row in arrays._starts(effects).to_pylist()}
    cuts = []
    for task in tasks:
        known = [{**starts[r["split"]], **r} for r in task.to_pylist()]
        # In batches of two, as a split may come in several.
        batches = [batch(known[at : at + 2]) for at in range(0, len(known), 2)]
        cuts += [row for out in arrays._cuts(iter(batches)) for row in out.to_pylist()]
    records, held = [], ""
    for cut in cuts:
        assert (cut["part"] in ("whole", "head")) == (not held)
        held += cut["record"]
        if cut["part"] in ("whole", "tail"):
            records.append(held)
            held = ""
    assert not held
    return records


@pytest.mark.parametrize("indent, ascii_", [(None, True), (2, False)])
def test_records_are_cut_wherever_splits_begin(indent, ascii_):
    text = json.dumps(RECORDS * 3, indent=indent, ensure_ascii=ascii_)
    for split in [*range(1, 90), 333, 10**6]:
        assert list(map(json.loads, cut_by_hand(text, split))) == RECORDS * 3
    assert cut_by_hand(" [ ]\n", 2) == []


MALFORMED_ARRAYS = [
    '[{"id":5}]}',
    '[{"id":5}{"id":6}]',
    '[{"id":5},,{"id":6}]',
    '[,{"id":5}]',
    '[{"id":5},]',
    '[{"id":5},6]',
    '[{"id":5},[{"id":6}]]',
    '[{"id":5},{"id":6]',
    '[{"id":5',
    '[{"id":"5}]',
    "   ",
    "]",
]


@pytest.mark.parametrize("split", [1, 3, 16, 10**6])
def test_malformed_arrays_fail_wherever_splits_begin(split):
    whole = json.dumps(RECORDS[:3], indent=1)
    texts = [t for layout, t in MALFORMED if layout == "array" and t not in ("", '[{"id":5]}')]
    for text in [*MALFORMED_ARRAYS, *texts, *(whole[:-n] for n in range(1, len(whole), 5))]:
        with pytest.raises(ValueError, match="malformed"):
            cut_by_hand(text, split)


def test_array_files_are_split(spark, tmp_path):
    """Over several files and many small splits, in order; parts of a record come together."""
    bodies = {name: [dict(r, file=name) for r in RECORDS * n] for name, n in (("a", 3), ("b", 1), ("c", 0))}
    for name, records in bodies.items():
        write(tmp_path / "in" / f"{name}.json", json.dumps(records, indent=2, ensure_ascii=False))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    saved = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "150")
    spark.conf.set(names[1], "1")
    try:
        found = read_records(spark, str(tmp_path / "in"), "array")
        assert found.rdd.getNumPartitions() > 8
        got = [json.loads(row.record) for row in found.orderBy("arrival").collect()]
        places = found.select("arrival").distinct().count()
    finally:
        for name, value in saved.items():
            spark.conf.set(name, value)
    assert got == [record for records in bodies.values() for record in records]
    assert places == len(got)


def test_written_arrays_are_read_back(spark, tmp_path):
    rows = [(i, None if i % 3 else 'x"}\n{[') for i in range(50)]
    df = spark.createDataFrame(rows, "id int, t string").repartition(4).union(spark.createDataFrame([], "id int, t string"))
    arrays.write_arrays(df, str(tmp_path / "out"))
    for file in (tmp_path / "out").glob("part-*"):
        assert isinstance(json.loads(file.read_text()), list)
    found = read_typed(spark, str(tmp_path / "out"), "id int, t string", "array")
    assert sorted(map(tuple, found.collect())) == rows


def test_fields_come_from_one_parse(spark, tmp_path):
    write(tmp_path / "in" / "a.json", '{"id":1,"t":"x","n":{"b":[1]}}')
    fields = record_schema(["id", "t"], ["n"])
    found = read_records(spark, str(tmp_path / "in"), fields=fields)
    row = found.select("fields.id", "fields.t", F.to_json("fields.n").alias("n")).first()
    assert tuple(row) == ("1", "x", '{"b":[1]}')
    for frame in (found, found.select("fields.id"), found.select("record"), read_typed(spark, str(tmp_path / "in"), "id int, t string")):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def test_parsed_texts(spark):
    texts = ['"x"', '"{x"', "5", "true", "null", '""', '"é\\n"', '{"a": 1}']
    records = [(i, '{"t":' + text + "}") for i, text in enumerate(texts)]
    frame = spark.createDataFrame(records, "i int, record string")
    found = frame.select("i", parse_fields("record", ["t"]).alias("f")).orderBy("i").select("f.t")
    assert [row.t for row in found.collect()] == [
        "x", "{x", "5", "true", None, "", "é\n", '{"a":1}',
    ]


def test_typed(spark, tmp_path):
    write(tmp_path / "in" / "a.json", '{"id":1,"address":{"city":"Q"}}', '{"id":2}')
    found = read_typed(spark, str(tmp_path / "in"), "id int, address string").orderBy("id").collect()
    assert [tuple(row) for row in found] == [(1, '{"city":"Q"}'), (2, None)]
    write(tmp_path / "bad" / "a.json", '{"id":"x"}')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_typed(spark, str(tmp_path / "bad"), "id int").collect()


def test_date_series(spark):
    bounds = spark.createDataFrame([(date(2024, 2, 28), date(2024, 3, 1))], "a date, b date")
    days = [row.d for row in date_series(bounds, "a", "b").orderBy("d").collect()]
    assert days == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
