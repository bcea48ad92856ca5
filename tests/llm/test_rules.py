"""Quality rules against plain counts, and the compression bands."""

import base64
import random
import re

import numpy as np
import pytest

from asterism.llm import queries, rules, words

SF = "/root/testdata/sf0.01"


def counts(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(found) - 7):
        windows.setdefault(tuple(found[i : i + 8]), []).append(i)
    again = {j for places in windows.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(found) < 20 or 100 * len(again) > 30 * len(found)
    return (
        len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(again), failed,
    )


def some_texts():
    rng = random.Random(1)
    some = ["a", "b", "the", "é😀", "#", "<b>", "x|y", " ", "word."]
    texts = [None, "", " \t\n", "one", "a b c d e f g h a b c d e f g h", "x\nx\n \n \nx y", "\n\n"]
    for n in (3, 16, 40, 200):
        for kinds in (1, 3, 9):
            gaps = [" ", " ", "\n", "\t", "\r\n", "  "]
            texts.append("".join(rng.choice(some[:kinds]) + rng.choice(gaps) for _ in range(n)))
    base = " ".join(f"w{rng.randint(0, 300)}" for _ in range(50))
    return texts + [base + " middle " + base, base + " " + base[:-1], base]


@pytest.mark.parametrize("size", [1, 1 << 20])
def test_counts_by_a_plain_model(spark, monkeypatch, size):
    """Also where a text is split slice by slice."""
    monkeypatch.setattr(words, "SLICE", size)
    texts = some_texts()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, ratio string, N_Words int")
    got = {r.doc_id: tuple(r)[1:7] for r in rules.judge(df).collect()}
    assert got == {i: counts(t) for i, t in enumerate(texts)}


def test_all_documents_by_a_plain_model(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op13_quality_rules(spark, SF).collect()
    assert {r.doc_id: tuple(r)[1:7] for r in got} == {i: counts(t) for i, t in texts.items()}
    settings = rules.Settings()
    for r in got:
        passes = rules.compression((texts[r.doc_id] or "").encode(), settings)[2]
        assert r.kept == (not r.base_failed and passes)


def test_good_documents_stay_and_repetitive_ones_go(spark):
    got = queries.op13_quality_rules(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").join(got, "doc_id").filter("NOT base_failed")
    good = labels.filter("quality = 1")
    assert good.count() > 100 and good.filter("NOT kept").isEmpty()
    assert got.filter("NOT base_failed AND NOT kept").count() > 0
    assert got.filter("NOT kept AND n_bytes >= 128 AND ratio BETWEEN 0.40 AND 0.55 AND NOT base_failed").isEmpty()


def test_bands():
    settings, rng = rules.Settings(), random.Random(2)
    noise = base64.b85encode(rng.randbytes(40_000)).decode()
    made = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 9))) for _ in range(4000)]
    prose = " ".join(rng.choices(made, weights=[1 / (i + 1) for i in range(4000)], k=12_000))
    for size in (300, 1000, 3000, 10_000, 40_000):
        assert rules.compression(prose[:size].encode(), settings)[2]
        # In a few hundred bytes no code table pays, so noise does not stand out yet.
        assert size < 1000 or not rules.compression(noise[:size].encode(), settings)[2]
        assert not rules.compression((prose[:40] * 2000)[:size].encode(), settings)[2]
    # Good as a whole, but half of its chunks are not.
    ratio, share, passes = rules.compression((prose[:20_000] + "spam spam " * 2000).encode(), settings)
    assert 0.15 < ratio < 0.4 and 0.4 < share < 0.6 and not passes
    assert rules.compression(b"", settings) == (None, 0.0, True)
    assert rules.compression(b"x", settings)[2]


def test_long_and_empty_tables(spark):
    long = "word other. " * 500_000
    df = spark.createDataFrame([(1, long), (1, long), (None, "x")], "doc_id bigint, text string")
    rows = rules.judge(df).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_repeat_words, r.kept) for r in rows) == [
        (0, 1, 0, False), (1, 1_000_000, 1_000_000, False), (1, 1_000_000, 1_000_000, False),
    ]
    assert rules.judge(df.limit(0)).collect() == []


def test_repeated_words_across_texts_do_not_count():
    numbers = np.array([1, 2, 3, 4, 5, 6, 7, 8] * 2)
    assert rules.repeated_words(numbers, np.repeat([0, 1], 8), 2).tolist() == [0, 0]
    assert rules.repeated_words(numbers, np.zeros(16, np.int64), 1).tolist() == [16]
