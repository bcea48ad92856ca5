"""Records into staging rows: what fails, whichever columns are read, and how often a record is parsed."""

import json
import sys
from datetime import datetime

import pytest

import __spark_entry__ as contract
from asterism.plans.staging import COMMENTS, POSTS, USERS, load_comments, load_posts, load_users
from asterism.sources.records import read_records

NOW = datetime(2024, 1, 1)
GOOD = {"id": 1, "userId": 2, "title": "t", "body": "b"}


def landed(spark, path, *records, collection=POSTS):
    path.mkdir(exist_ok=True)
    (path / "0.json").write_text("\n".join(map(json.dumps, records)))
    return read_records(spark, str(path), fields=collection.fields)


@pytest.mark.parametrize(
    "bad, message",
    [
        ({"id": 2, "userId": "abc", "title": "t", "body": "b"}, "key 'userId' holds no int: abc"),
        ({"id": 2.5, "userId": 1, "title": "t", "body": "b"}, "key 'id' holds no int: 2.5"),
        ({"id": 2, "userId": 1, "title": "t"}, "record without required key body"),
        ({"userId": 1, "title": "t", "body": "b"}, "record without required key id"),
    ],
)
def test_bad_records_fail_whatever_is_read(spark, tmp_path, bad, message):
    rows = load_posts(landed(spark, tmp_path / "in", GOOD, bad), NOW)
    for read in [rows.count, *[rows.select(name).collect for name in rows.columns], rows.select("id", "title").collect]:
        with pytest.raises(Exception, match=message):
            read()


def test_fields_may_be_parsed_later(spark, tmp_path):
    read = landed(spark, tmp_path / "in", GOOD)
    both = [load_posts(records, NOW).collect() for records in (read, read.drop("fields"))]
    assert both[0] == both[1] and both[0][0].title == "t"


@pytest.mark.parametrize("collection, load", [(POSTS, load_posts), (USERS, load_users), (COMMENTS, load_comments)])
def test_records_are_parsed_once(spark, tmp_path, collection, load):
    rows = load(landed(spark, tmp_path / "in", GOOD, collection=collection), NOW)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_own_queries_stay_without_the_libraries_of_the_others(monkeypatch):
    for name in [n for n in sys.modules if n.startswith("asterism.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    for name in ("public_tokenizers", "tiktoken", "ahocorasick", "sentencepiece", "zstandard"):
        monkeypatch.setitem(sys.modules, name, None)
    assert set(contract._QUERIES) == set(contract.queries())
    assert set(contract._ORACLES) == set(contract.oracle_sql())
