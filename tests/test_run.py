import json
import re
from dataclasses import replace
from datetime import date, datetime
from pathlib import Path
from random import Random

import pytest

from asterism.__main__ import main
from asterism.operators.checks import ConstraintViolation, table_violations
from asterism.operators import dml
from asterism.plans import facts
from asterism.plans.facts import fact_source
from asterism.plans.run import run
from asterism.schemas import star_schema
from asterism.session import configure
from asterism.warehouse import Warehouse

DAY_1, DAY_2 = datetime(2024, 1, 1), datetime(2024, 5, 2, 3, 4, 5)


def post(id, user, title="t", body="a b", **more):
    return {"id": id, "userId": user, "title": title, "body": body, **more}


def user(id, **more):
    return {"id": id, "name": f"n{id}", "username": f"u{id}", "email": f"e{id}", **more}


def comment(id, post_id, **more):
    return {"id": id, "postId": post_id, "name": "n", "email": "e", "body": "b", **more}


POSTS = [
    post(1, 1, "first"), post(2, 9, "orphan"), post(3, 2, body=""), post(1, 1, None, "a  b "),
    post(4, 2, extra={"deep": [1]}),
]
USERS = [
    user(2, phone="123", address={"city": "Q", "geo": {"lat": "1"}}),
    user(1, phone=None, website="w", address=None, company={"name": "C"}),
]
COMMENTS = [comment(1, 1), comment(2, 1), comment(3, None), comment(4, 77), comment(5, 4)]


class Place:
    def __init__(self, spark, base):
        self.spark, self.landing, self.root = spark, base / "landing", str(base / "wh")
        self.warehouse = Warehouse(spark, self.root)

    def land(self, posts=POSTS, users=USERS, comments=COMMENTS, day="a", layout="lines"):
        for name, records in (("posts", posts), ("users", users), ("comments", comments)):
            folder = self.landing / day / name
            folder.mkdir(parents=True, exist_ok=True)
            lines = [json.dumps(record) for record in records]
            text = "\n".join(lines) if layout == "lines" else "[" + ",\n".join(lines) + "]"
            (folder / "0.json").write_text(text)

    def run(self, run_ts=DAY_1, day="a", **options):
        return run(self.spark, str(self.landing / day), self.root, run_ts, **options)

    def rows(self, table, *columns):
        found = self.warehouse.read(table).select(*columns).orderBy(columns[0]).collect()
        return [tuple(row) for row in found]


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path)


def test_variant_staging_gives_the_same_warehouse(place, spark, tmp_path):
    place.land()
    place.run(verify=True)
    other = Place(spark, tmp_path / "other")
    other.land()
    for _ in range(2):  # the second time over VARIANT tables
        other.run(variant=True, verify=True, refresh=not other.warehouse.current())
    for table, *columns in (
        ("dim_users", "user_key", "user_id", "city", "company_name", "phone"),
        ("fact_posts", "post_id", "user_key", "title", "body", "comment_count"),
    ):
        assert place.rows(table, *columns) == other.rows(table, *columns)
    assert dict(other.warehouse.read("staging_users").dtypes)["address"] == "variant"


@pytest.mark.parametrize("layout", ["lines", "array"])
def test_end_to_end(place, layout):
    place.land(layout=layout)
    assert place.run(layout=layout) == {"posts_count": 5, "users_count": 2, "comments_count": 5}

    posts = {row[0]: row for row in place.rows("staging_posts", "id", "title", "body", "raw_data")}
    assert posts[1][1:3] == (None, "a  b ")
    assert json.loads(posts[4][3]) == POSTS[4]
    assert json.loads(posts[1][3]) == POSTS[3]
    assert place.rows("staging_users", "id", "phone", "website", "address", "company") == [
        (1, None, "w", "null", '{"name":"C"}'),
        (2, "123", "", '{"city":"Q","geo":{"lat":"1"}}', "{}"),
    ]
    assert place.rows("staging_comments", "id", "post_id", "loaded_at")[2] == (3, None, DAY_1)

    assert place.rows("dim_users", "user_key", "user_id", "username", "phone", "city", "company_name") == [
        (1, 1, "u1", None, None, "C"),
        (2, 2, "u2", "123", "Q", None),
    ]
    assert place.rows("dim_users", "valid_from", "valid_to", "is_current", "updated_at") == [
        (DAY_1, None, True, DAY_1)
    ] * 2
    assert place.warehouse.read("dim_dates").count() == 2192
    assert place.rows(
        "fact_posts", "post_key", "post_id", "user_key", "date_key", "title", "body_length",
        "word_count", "comment_count", "created_at", "updated_at",
    ) == [
        (1, 1, 1, 20240101, None, 5, 4, 2, DAY_1, DAY_1),
        (2, 3, 2, 20240101, "t", 0, None, 0, DAY_1, DAY_1),
        (3, 4, 2, 20240101, "t", 3, 2, 1, DAY_1, DAY_1),
    ]


def test_schemas(place):
    place.land()
    place.run()
    assert place.warehouse.read("fact_posts").schema.simpleString() == (
        "struct<post_key:int,post_id:int,user_key:int,date_key:int,title:string,body:string,"
        "body_length:int,word_count:int,comment_count:int,created_at:timestamp_ntz,"
        "updated_at:timestamp_ntz>"
    )
    assert place.warehouse.read("dim_users").schema.simpleString() == (
        "struct<user_key:int,user_id:int,username:string,name:string,email:string,phone:string,"
        "website:string,city:string,company_name:string,valid_from:timestamp_ntz,"
        "valid_to:timestamp_ntz,is_current:boolean,updated_at:timestamp_ntz>"
    )


def test_wide_ids(place):
    big = 2**40
    place.land([post(big, 1)], USERS, [comment(big, big)])
    place.run(id_type="bigint")
    assert place.rows("fact_posts", "post_key", "post_id", "comment_count") == [(1, big, 1)]
    with pytest.raises(Exception, match="holds no int"):
        place.run(id_type="int")


def test_every_run_starts_from_empty_tables(place):
    place.land()
    place.run()
    place.land([post(9, 5)], [user(5)], [], day="b")
    place.run(DAY_2, day="b")
    assert place.rows("fact_posts", "post_key", "post_id", "user_key", "comment_count") == [(1, 9, 1, 0)]
    assert place.rows("staging_users", "id") == [(5,)]


def test_run_over_existing_tables(place):
    place.land()
    place.run()
    place.land(
        [post(4, 1, "moved"), post(8, 6)], [user(1, phone="9"), user(6)], [comment(6, 8), comment(5, 8)],
        day="b",
    )
    place.run(DAY_2, day="b", refresh=False)
    assert place.rows("dim_users", "user_key", "user_id", "phone", "website", "valid_from") == [
        (1, 1, "9", "", DAY_1), (2, 2, "123", "", DAY_1), (3, 6, "", "", DAY_2),
    ]
    assert place.rows(
        "fact_posts", "post_key", "post_id", "user_key", "date_key", "title", "comment_count",
        "created_at", "updated_at",
    ) == [
        (1, 1, 1, 20240101, None, 2, DAY_1, DAY_2),
        (2, 3, 2, 20240101, "t", 0, DAY_1, DAY_2),
        (3, 4, 1, 20240502, "moved", 0, DAY_1, DAY_2),
        (4, 8, 3, 20240502, "t", 2, DAY_2, DAY_2),
    ]
    assert place.warehouse.read("dim_dates").count() == 2192


def test_default_run_ts_is_now(place):
    place.land()
    place.run(None, calendar=(date(2024, 1, 1), date(2100, 1, 1)))
    (created,) = {row[0] for row in place.rows("fact_posts", "created_at")}
    assert abs((datetime.now() - created).total_seconds()) < 24 * 3600


def without(record, key):
    return {name: value for name, value in record.items() if name != key}


@pytest.mark.parametrize(
    "broken",
    [
        {"posts": [without(post(1, 1), "body")]},
        {"users": [without(user(1), "email")]},
        {"comments": [without(comment(1, 1), "postId")]},
        {"posts": [post(None, 1)]},
        {"users": [user(1) | {"username": "x" * 101}]},
    ],
)
def test_bad_records_publish_nothing(place, broken):
    place.land()
    place.run()
    before = place.warehouse.current()
    place.land(**broken, day="b")
    with pytest.raises(Exception, match="required key|null value in key|too long"):
        place.run(DAY_2, day="b")
    assert place.warehouse.current() == before
    assert place.warehouse.read("fact_posts").count() == 3


def test_missing_collection_publishes_nothing(place):
    place.land()
    (place.landing / "a" / "comments" / "0.json").unlink()
    (place.landing / "a" / "comments").rmdir()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        place.run()
    assert place.warehouse.current() == {}


def test_run_after_the_calendar_ends_fails(place):
    place.land()
    with pytest.raises(ConstraintViolation, match="date_key"):
        place.run(datetime(2026, 1, 1))
    assert place.warehouse.current() == {}
    place.run(datetime(2026, 1, 1), calendar=(date(2020, 1, 1), date(2026, 12, 31)))
    assert place.rows("fact_posts", "post_id", "date_key")[0] == (1, 20260101)


def test_command_line(place, capsys):
    place.land()
    main([str(place.landing / "a"), place.root, "--run-ts", "2024-05-01", "--verify"])
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["posts_count"] == 5
    assert {row[0] for row in place.rows("fact_posts", "date_key")} == {20240501}


def test_bucketed_posts(place, spark):
    place.land()
    place.run()
    columns = ("post_key", "post_id", "user_key", "body", "word_count", "comment_count")
    plain = place.rows("fact_posts", *columns)
    place.run(DAY_2, buckets=4)
    assert place.rows("fact_posts", *columns) == plain
    assert place.rows("staging_posts", "id") == [(1,), (2,), (3,), (4,)]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("asterism_")]


def test_bucketed_texts_are_not_shuffled_again(place, spark):
    place.land()
    place.run()
    posts, users, comments = (
        place.warehouse.read(name) for name in ("staging_posts", "dim_users", "staging_comments")
    )
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for limit in limits:
        spark.conf.set(limit, "-1")
    _, entry = place.warehouse.save_bucketed("staging_posts", posts, "id", 4)
    try:
        def wide_shuffles(staged):
            source = fact_source(staged, users, comments)
            plan = source._jdf.queryExecution().executedPlan().toString()
            # What stands below an exchange follows it, down to its scan.
            below = [part.split("FileScan", 1)[-1].splitlines()[0] for part in plan.split("Exchange")[1:]]
            return sum("body" in scan for scan in below)

        assert wide_shuffles(posts) == 1
        assert wide_shuffles(spark.table(entry)) == 0
    finally:
        spark.sql(f"DROP TABLE {entry}")
        for limit in limits:
            spark.conf.unset(limit)


@pytest.mark.parametrize("buckets", [None, 4])
def test_staged_rows_are_written_once(place, spark, monkeypatch, buckets):
    """A second day stores the records of known ids once, and keeps the rows of the others."""
    place.land()
    place.run(buckets=buckets)
    before = place.rows("staging_posts", "id", "user_id", "title", "body", "raw_data", "loaded_at")
    place.land(
        posts=[post(3, 1, "early"), post(5, 1, None, "new"), post(3, 2, "late", "x y")],
        users=[user(2, name="other"), user(3)], comments=[comment(1, 3), comment(9, 5)], day="b",
    )
    written, materialize = [], dml.materialize
    monkeypatch.setattr(dml, "materialize", lambda df: written.append(df.columns) or materialize(df))
    counts = place.run(DAY_2, day="b", refresh=False, buckets=buckets, verify=True)
    assert not written
    assert counts == {"posts_count": 3, "users_count": 2, "comments_count": 2}
    after = place.rows("staging_posts", "id", "user_id", "title", "body", "raw_data", "loaded_at")
    assert [row for row in after if row[0] not in (3, 5)] == [row for row in before if row[0] != 3]
    assert [row[:4] for row in after if row[0] in (3, 5)] == [(3, 2, "late", "x y"), (5, 1, None, "new")]
    assert {row[5] for row in after if row[0] in (3, 5)} == {DAY_2}
    assert place.rows("staging_users", "id", "name") == [(1, "n1"), (2, "other"), (3, "n3")]
    comments = place.rows("staging_comments", "id", "post_id")
    assert comments == [(1, 3), (2, 1), (3, None), (4, 77), (5, 4), (9, 5)]
    facts = place.rows("fact_posts", "post_key", "post_id", "title", "comment_count")
    assert facts == [(1, 1, None, 1), (2, 3, "late", 1), (3, 4, "t", 1), (4, 5, None, 1)]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("asterism_")]


def test_former_texts_in_the_same_buckets_are_not_shuffled(place, spark, monkeypatch):
    place.land()
    place.run(buckets=4)
    plans, add = [], Warehouse.add_bucketed

    def added(self, entry, df, column, buckets):
        dealt = df.repartition(buckets, column)
        plans.append(dealt._jdf.queryExecution().executedPlan().toString())
        add(self, entry, df, column, buckets)

    monkeypatch.setattr(Warehouse, "add_bucketed", added)
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {key: spark.conf.get(key, None) for key in (*limits, "spark.sql.shuffle.partitions")}
    for key, value in zip(saved, ("-1", "-1", "4"), strict=True):
        spark.conf.set(key, value)
    try:
        place.run(DAY_2, refresh=False, buckets=4)
        place.run(DAY_2, refresh=False, buckets=3)
    finally:
        for key, value in saved.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "Exchange" not in plans[0] and "Exchange" in plans[1]
    assert place.rows("staging_posts", "id") == [(1,), (2,), (3,), (4,)]


def test_bucketed_day_without_posts(place):
    place.land(posts=[])
    place.run(buckets=4, verify=True)
    assert place.rows("staging_posts", "id") == place.rows("fact_posts", "post_id") == []
    place.land(day="b")
    place.run(DAY_2, day="b", refresh=False, buckets=4)
    assert place.rows("fact_posts", "post_key", "post_id") == [(1, 1), (2, 3), (3, 4)]
    folders = [p for p in Path(place.root, "staging_posts").iterdir() if p.is_dir()]
    assert len(folders) == 2


def test_second_day_with_wider_ids(place):
    place.land()
    place.run()
    place.land(posts=[post(3, 2, "late"), post(2**40, 2)], day="b")
    place.run(DAY_2, day="b", refresh=False, id_type="bigint")
    assert place.rows("staging_posts", "id", "title") == [
        (1, None), (2, "orphan"), (3, "late"), (4, "t"), (2**40, "t"),
    ]


def test_scratch_is_released(place, spark):
    place.land()
    place.run()
    place.run(DAY_2, refresh=False)
    assert not [p for p in Path(place.root).rglob("*.parquet") if "_scratch" in p.parts]
    assert place.warehouse.read("fact_posts").count() == 3


@pytest.mark.parametrize("existing", [False, True])
def test_fact_load_reads_each_table_once(place, spark, monkeypatch, existing):
    """The lookups on ids once, when they are written; then the texts once."""
    place.land()
    place.run()
    read = place.warehouse.read
    posts, users, comments, fact = map(
        read, ("staging_posts", "dim_users", "staging_comments", "fact_posts")
    )
    plans = []

    def scans(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        columns = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
        return sorted(sorted(re.sub(r"#\d+L?", "", found).split(",")) for found in columns)

    def written(df):
        plans.append(scans(df))
        return materialize(df)

    materialize = facts.materialize
    monkeypatch.setattr(facts, "materialize", written)
    loaded = facts.populate_fact_posts(posts, users, comments, DAY_2, fact if existing else None)
    posts_ids, comments_ids, users_ids = ["id", "user_id"], ["post_id"], ["user_id", "user_key"]
    assert plans == [[posts_ids, comments_ids, users_ids]]
    later = scans(loaded)
    assert posts_ids not in later and users_ids not in later
    assert [found for found in later if "body" in found and "post_key" not in found] == [
        ["body", "id", "loaded_at", "title"]
    ]
    assert loaded.count() == 3


def test_settings_of_the_session_stay(spark):
    tuned = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(tuned, None)
    spark.conf.set(tuned, "256m")
    try:
        assert configure(spark).conf.get(tuned) == "256m"
    finally:
        spark.conf.set(tuned, before)


def test_declared_rules(place):
    place.land()
    place.run()
    tables = star_schema()
    stored = {name: place.warehouse.read(name) for name in tables}
    for name, table in tables.items():
        for rule, violations in table_violations(stored[name], table, stored).items():
            assert violations.isEmpty(), rule
    fact = stored["fact_posts"]
    broken = fact.union(fact.filter("post_id = 1")).selectExpr(
        "post_key", "nullif(post_id, 4) post_id", "user_key + 1 user_key", "date_key"
    )
    found = table_violations(broken, tables["fact_posts"], stored)
    assert {rule: rows.count() for rule, rows in found.items()} == {
        "fact_posts.post_key has to be unique": 1,
        "fact_posts.post_key has to be not null": 0,
        "fact_posts.post_id has to be not null": 1,
        "fact_posts.user_key has to be in dim_users": 2,
        "fact_posts.date_key has to be in dim_dates": 0,
    }


def test_verify_stops_the_run(place, monkeypatch):
    place.land()
    tables = star_schema()
    narrow = replace(tables["staging_posts"], unique=("user_id",))
    monkeypatch.setattr("asterism.plans.run.star_schema", lambda id_type: {**tables, "staging_posts": narrow})
    place.run()
    before = place.warehouse.current()
    with pytest.raises(ConstraintViolation, match="staging_posts.user_id has to be unique"):
        place.run(verify=True)
    assert place.warehouse.current() == before


@pytest.mark.parametrize("seed", [1, 2])
def test_two_random_days(place, seed):
    """Against dictionaries filled record by record, on fresh and on existing tables."""
    draw = Random(seed)

    def day():
        return (
            [post(draw.randint(1, 60), draw.randint(1, 12), f"t{i}", " ".join("x" * draw.randint(0, 4)))
             for i in range(90)],
            [user(key, phone=draw.choice(["1", None])) for key in draw.sample(range(1, 12), 7)],
            [comment(draw.randint(1, 300), draw.choice([None, *range(1, 70)])) for _ in range(200)],
        )

    posts, users, comments, keys, fact = {}, {}, {}, {}, {}
    for name, run_ts, refresh in (("a", DAY_1, True), ("b", DAY_2, False)):
        new_posts, new_users, new_comments = day()
        place.land(new_posts, new_users, new_comments, day=name)
        place.run(run_ts, day=name, refresh=refresh, verify=True)
        posts |= {row["id"]: (row, run_ts) for row in new_posts}
        users |= {row["id"]: row for row in new_users}
        comments |= {row["id"]: row for row in new_comments}
        for key in sorted(row["id"] for row in new_users):
            keys.setdefault(key, len(keys) + 1)
        # A post whose user is unknown by now keeps the fact it had.
        fact |= {
            row["id"]: (
                row["id"], keys[row["userId"]], int(loaded.strftime("%Y%m%d")), row["title"],
                len(row["body"]), len(row["body"].split(" ")) if row["body"] else None,
                sum(other["postId"] == row["id"] for other in comments.values()),
            )
            for row, loaded in posts.values() if row["userId"] in users
        }
        assert place.rows(
            "fact_posts", "post_id", "user_key", "date_key", "title", "body_length", "word_count",
            "comment_count",
        ) == sorted(fact.values())
        assert place.rows("dim_users", "user_id", "user_key", "phone") == sorted(
            (key, keys[key], row["phone"]) for key, row in users.items()
        )
