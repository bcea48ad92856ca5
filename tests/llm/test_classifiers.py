"""Quality votes and toxicity grades: held-out accuracy, and cases at the edges."""

import math
import random
import zlib

import numpy as np
import pytest

from asterism.llm import queries, quality, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id AS id", "text")
    return documents, spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_of_held_out_rows(spark, tables):
    documents, labels = tables
    held_out = "crc32(CAST(CAST(id AS STRING) AS BINARY)) % 3 = 1"
    known = labels.selectExpr("doc_id AS id", "quality AS label")
    model = quality.train(documents, known.filter(f"NOT {held_out}"))
    assert len(model.labels) <= 2 * quality.Settings().per_class
    test = documents.join(known.filter(held_out), "id")
    rows = quality.score(test, model).collect()
    assert len(rows) > 1000
    right = [(r.score >= 0.5) == (r.label == 1) for r in rows]
    assert np.mean(right) > 0.98
    assert np.mean([x for x, r in zip(right, rows, strict=True) if r.label == 0]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_votes_are_exact_cosines(spark):
    """Scores by brute force over all labelled vectors."""
    rng = random.Random(1)
    good = [" ".join(rng.choices(["the", "of", "in", "and", "was"], k=9)) for _ in range(30)]
    bad = [" ".join(rng.choices(["!!", "%%%", "|"], k=9)) for _ in range(30)]
    settings = quality.Settings(neighbours=5, dims=8)
    model = quality.fit(
        quality.features(good + bad, settings.buckets), np.array([1.0] * 30 + [0.0] * 30), settings
    )
    texts = ["the of !!", "", "| | |", None]
    vectors = model.embed(*quality.features(texts, settings.buckets))
    expected = []
    for vector in vectors:
        near = sorted(((float(v @ vector), y) for v, y in zip(model.vectors, model.labels, strict=True)), reverse=True)[:5]
        weights = [max(s, 1e-6) for s, _ in near]  # both classes have as many rows
        expected.append(sum(w * y for w, (_, y) in zip(weights, near, strict=True)) / sum(weights))
    assert model.score(texts) == pytest.approx(expected, abs=1e-4)
    assert model.score(texts)[1] == model.score(texts)[3]


def test_quality_at_the_edges(spark):
    documents = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (3, "word " * 50_000, "c"), (3, "again", "d"), (None, "x", "e")],
        "id bigint, text string, SCORE string",
    )
    none = spark.createDataFrame([], "id bigint, label int")
    scored = quality.score(documents, quality.train(documents, none))
    assert scored.columns == ["id", "text", "score"]
    assert [r.score for r in scored.collect()] == [0.5] * 5
    labels = spark.createDataFrame([(1, 0), (2, None), (3, 1), (3, 0), (99, 1), (None, 1)], "id bigint, label int")
    model = quality.train(documents, labels)
    assert sorted(model.labels) == [0, 1]
    assert all(0 <= r.score <= 1 for r in quality.score(documents, model).collect())
    assert quality.score(documents.limit(0), model).collect() == []


def test_toxicity_of_other_rows(spark, tables):
    documents, labels = tables
    known = labels.selectExpr("doc_id AS id", "toxic AS grade")
    model = toxicity.train(documents, known.filter("id % 3 <> 0"))
    assert len(model.words) <= toxicity.Settings().words
    assert list(model.thresholds) == sorted(model.thresholds)
    other = known.filter("id % 3 = 0").withColumnRenamed("grade", "marked")
    rows = toxicity.severity(documents, model).join(other, "id").collect()
    marked = [r for r in rows if r.marked == 1]
    clean = [r for r in rows if r.marked == 0]
    assert np.mean([r.toxic for r in marked]) > 0.9
    assert np.mean([r.toxic for r in clean]) < 0.03
    assert {r.grade for r in marked} >= {1, 2}
    # The expected severity orders the grades.
    means = [np.mean([r.severity for r in rows if r.grade == g]) for g in (0, 1, 2)]
    assert means == sorted(means)


def test_severity_orders_what_others_found(spark, tables):
    """Two models learned from disjoint labels, with grades of their own, agree on the order
    of marked rows that neither has seen."""
    documents, labels = tables
    known = labels.selectExpr("doc_id AS id", "toxic AS grade")
    models = [toxicity.train(documents, known.filter(f"id % 3 = {part}")) for part in (0, 1)]
    unseen = documents.join(known.filter("id % 3 = 2 AND grade = 1"), "id").select("id", "text")
    found = []
    for model in models:
        rows = toxicity.severity(unseen, model).select("id", "severity").collect()
        found.append([r.severity for r in sorted(rows)])
    ranks = [np.argsort(np.argsort(values)) for values in found]
    assert len(ranks[0]) > 50 and np.corrcoef(ranks)[0, 1] > 0.5


def test_half_of_the_rows_grade_the_others(spark):
    """Every text holds a word of its own besides; it must not grade that text."""
    rows = [(i, f"vile{'x' * (i % 7)} " * (1 + i % 4) + f"own{i} and the rest", 1) for i in range(60)]
    rows += [(100 + i, f"plain words here and the rest {i}", 0) for i in range(60)]
    documents = spark.createDataFrame(rows, "id bigint, text string, grade int")
    model = toxicity.train(documents.select("id", "text"), documents.select("id", "grade"))
    assert len(model.thresholds) == toxicity.Settings().severities
    got = {r.id: r for r in toxicity.severity(documents, model).collect()}
    assert all(got[i].toxic == (i < 100) for i in got)
    means = [np.mean([got[i].severity for i in range(60) if i % 4 == n]) for n in (0, 3)]
    assert means[0] < means[1]


def test_op8_by_brute_force(spark):
    """The query's result from the model's words, weights and thresholds alone."""
    sf = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    model = queries.toxicity_model(documents, spark.read.parquet(f"{sf}/labels.parquet"))
    weights = dict(zip(model.words, model.weights, strict=True))
    got = {r.doc_id: r for r in queries.op8_toxicity(spark, sf).collect()}
    assert len(got) == documents.count()
    for row in documents.collect():
        counts = {}
        for word in (row.text or "").lower().split():
            for feature in toxicity.features_of(word):
                counts[feature] = counts.get(feature, 0) + 1
        eta = sum(w * math.log1p(counts.get(word, 0)) for word, w in weights.items())
        above = [1 / (1 + math.exp(t - eta)) for t in model.thresholds]
        assert got[row.doc_id].severity == pytest.approx(sum(above), abs=1e-9)
        chances = np.diff([1 - p for p in [1.0, *above, 0.0]])
        best = sorted(chances)[-2:]
        assert got[row.doc_id].grade == int(np.argmax(chances)) or best[1] - best[0] < 1e-9
        odds = eta - model.thresholds[0]
        assert got[row.doc_id].toxic == (odds >= model.cut) or abs(odds - model.cut) < 1e-9


def test_equally_near_neighbours():
    """Those of the smaller ids vote, whatever their number."""
    cosines = np.array([[0.5, 0.9, 0.5, 0.5, 0.1], [0.3, 0.3, 0.3, 0.3, 0.3], [0.1, 0.2, 0.3, 0.4, 0.5]])
    assert [sorted(row) for row in quality._nearest(cosines, 2).tolist()] == [[0, 1], [0, 1], [3, 4]]
    assert sorted(quality._nearest(cosines, 5)[0].tolist()) == [0, 1, 2, 3, 4]


def test_op2_without_an_id(spark, tmp_path):
    rows = [(1, "one"), (None, "none"), (4, "four"), (3, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(1, 1), (None, 0), (4, 0), (3, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op2_quality(spark, str(tmp_path)).collect()
    want = [(i, i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in rows]
    assert sorted(map(str, ((r.doc_id, r.held_out) for r in got))) == sorted(map(str, want))


def test_toxicity_of_a_long_text(spark):
    documents = spark.createDataFrame([(1, "fine words"), (2, "vile " * 3), (3, "fine " * 400_000 + "vile")], "id int, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "id int, grade int")
    got = {r.id: r for r in toxicity.severity(documents, toxicity.train(documents, labels)).collect()}
    assert got[2].severity > got[1].severity and 0 <= got[3].severity


def test_ordinal_fit_by_brute_force():
    """The gradient of the fit vanishes: no small step lowers the loss."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 2))
    noise = rng.logistic(size=400)
    grades = np.digitize(x @ [1.5, -1.0] + noise, [0.0, 2.0])
    penalty = 1e-4

    def loss(weights, thresholds):
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        with np.errstate(over="ignore"):
            below = 1 / (1 + np.exp((x @ weights)[:, None] - edges))
        p = below[range(400), grades + 1] - below[range(400), grades]
        return -np.log(p).mean() + penalty * (weights**2).sum()

    weights, thresholds = toxicity.fit_ordinal(x, grades, penalty, 3000)
    best = loss(weights, thresholds)
    for step in np.eye(4) * 0.02:
        for sign in (1, -1):
            assert loss(weights + sign * step[:2], thresholds + sign * step[2:]) > best
    assert weights == pytest.approx([1.5, -1.0], abs=0.5)


def test_severity_is_the_sum_of_probabilities():
    model = toxicity.Model(("bad", "worse"), np.array([2.0, 5.0]), np.array([1.0, 4.0]))
    above = model.above(["Bad, (worse) bad", "", None], model.index())
    eta = 2 * np.log1p(2) + 5 * np.log1p(1)
    assert above[0] == pytest.approx(1 / (1 + np.exp(np.array([1.0, 4.0]) - eta)))
    assert list(above[1]) == list(above[2])


def test_toxicity_at_the_edges(spark):
    documents = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (3, "idiot " * 20_000, "c"), (3, "idiot", "d"), (None, "idiot", "e")],
        "id bigint, text string, Toxic string",
    )
    columns = "id bigint, grade int"
    for labels in ([], [(1, 0), (2, 0)], [(2, None), (77, 1)]):
        model = toxicity.train(documents, spark.createDataFrame(labels, columns))
        judged = toxicity.severity(documents, model)
        assert judged.columns == ["id", "text", "severity", "grade", "toxic"]
        rows = judged.collect()
        assert [(r.severity, r.toxic) for r in rows] == [(0.0, False)] * 5
    only_bad = toxicity.train(documents, spark.createDataFrame([(3, 1)], columns))
    assert all(r.toxic for r in toxicity.severity(documents, only_bad).collect())
    both = toxicity.train(documents, spark.createDataFrame([(1, 0), (2, 0), (3, 1), (None, 1)], columns))
    assert toxicity.severity(documents, both).count() == 5
    assert toxicity.severity(documents.limit(0), both).collect() == []
