"""Top-k search, mixing, license scans and URL filters against brute force."""

import itertools
import math
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from asterism.llm import licenses, mixing, oracles, queries, topk, urls

# --- top-k -----------------------------------------------------------------


def brute_top_k(vectors, is_query, k):
    """(query id, rank, id, score); each row but the query's own is a candidate."""
    out = []
    for q, (qid, query) in enumerate(vectors):
        if is_query(qid):
            scored = sorted(
                (-sum(a * b for a, b in zip(query, v, strict=True)), i)
                for c, (i, v) in enumerate(vectors)
                if c != q and len(v) == len(query)
            )
            out += [(qid, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block, spread", [(4096, 0), (37, 0), (37, 1)])
def test_top_k(spark, monkeypatch, block, spread):
    """Repeated rows are candidates of their own; with a spread of norms whole blocks are passed over."""
    monkeypatch.setattr(topk, "CANDIDATES", block)
    monkeypatch.setattr(topk, "QUERIES", 20)
    monkeypatch.setattr(topk, "PRODUCT", 1000)
    rng = random.Random(6)
    vectors = [(i, [rng.randint(-5, 5) * (1 + spread * i) for _ in range(4)]) for i in range(400)]
    vectors += [(1000 + i, [3, 0, 0, -3]) for i in range(60)]  # ties
    vectors += [(2000 + i, [1, 2]) for i in range(3)] + [(3000, []), (3010, []), (3020, [0, 0, 0, 0])]
    vectors += [(10, [2, 2, 2, 2]), (2**53 + 10, [10**12, -(10**12), 1, 3])] + vectors[:25]
    schema = "id bigint, vector array<bigint>, score string"
    df = spark.createDataFrame([(*v, "clash") for v in vectors] + [(None, [1], ""), (5000, None, "")], schema)
    got = topk.top_k(df, "id % 10 = 0", 7).collect()
    assert sorted(map(tuple, got)) == brute_top_k(vectors, lambda i: i % 10 == 0, 7)


def test_top_k_few_and_none(spark):
    df = spark.createDataFrame([(1, [1]), (2, [2])], "id bigint, vector array<bigint>")
    assert [tuple(r) for r in topk.top_k(df, "id = 1", 5).collect()] == [(1, 1, 2, 2)]
    assert topk.top_k(df.limit(0), "id = 1", 5).collect() == []
    assert topk.top_k(df, F.lit(False), 5).collect() == []
    assert topk.top_k(df, F.lit(None).cast("boolean"), 5).collect() == []


def test_top_k_leaves_out_the_own_row_only(spark):
    rows = [(2, [1, 1]), (2, [1, 1]), (3, [1, 1])]
    df = spark.createDataFrame(rows, "id bigint, vector array<bigint>")
    got = sorted(map(tuple, topk.top_k(df, "id = 2", 4).collect()))
    assert got == [(2, 1, 2, 2), (2, 1, 2, 2), (2, 2, 3, 2), (2, 2, 3, 2)]


def test_top_k_by_sql(spark, tmp_path):
    """Repeated ids and rows, nulls and lengths: the registered query and its SQL agree."""
    rng = random.Random(7)
    rows = [(i % 150, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(400)]
    rows += rows[:20] + [(100, [1.0]), (200, [0.5]), (300, None), (400, [1.0, None, 2.0]), (500, [float("nan")] * 3)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op5_top_k(spark, str(tmp_path)).collect()
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(map(tuple, got)) == sorted(connection.execute(queries.TOP_K).fetchall())


def test_threshold_stops_early():
    """On skewed lists the bound ends the reading before all candidates are scored."""
    rng = np.random.default_rng(1)
    vectors = np.zeros((2000, 3), np.int64)
    vectors[:, 0] = rng.integers(0, 10, 2000)
    vectors[:20, 0] = 1000
    ids = np.arange(2000)
    reads = []

    class Counting(np.ndarray):
        def __matmul__(self, other):
            reads.append(len(self))
            return np.asarray(self) @ other

        def __rmatmul__(self, other):
            reads.append(len(self.T))
            return other @ np.asarray(self)

    query, own = np.array([[1, 1, 1]]), np.array([-1])
    (found,) = topk.block_top_k(ids, ids, vectors.view(Counting), query, own, 5)
    assert found[0].tolist() == [0, 1, 2, 3, 4]
    assert 0 < sum(reads) < 200
    # Nothing of the block can reach a score that is known to be beaten.
    (found,) = topk.block_top_k(ids, ids, vectors, query, own, 5, np.array([1001.0]))
    assert len(found[0]) == 0


def test_quantised_and_usable(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.0001]), (2, [nan]), (3, [inf, 1.0]), (4, [None]), (5, None), (6, [])]
    df = spark.createDataFrame(rows, "id bigint, e array<float>")
    got = df.filter(topk.usable("e")).select("id", topk.quantised("e", 1024).alias("v")).collect()
    assert {r.id: r.v for r in got} == {1: [512, -1], 6: []}


# --- mixing ----------------------------------------------------------------


def brute_budgets(leaves, weights, budget, epochs, depth, path=()):
    """Water-filling from the root with whole numbers."""
    if len(path) == depth:
        return {path: budget}
    children = sorted({leaf[: len(path) + 1] for leaf in leaves if leaf[: len(path)] == path})
    cap = {c: epochs * sum(s for leaf, s in leaves.items() if leaf[: len(c)] == c) for c in children}
    weight = {c: weights.get(c, 1) for c in children}
    open_ = [c for c in children if weight[c]]
    given = dict.fromkeys(children, 0)
    left = budget
    while True:
        total = sum(weight[c] for c in open_)
        full = [c for c in open_ if cap[c] * total <= left * weight[c]]
        if not full:
            break
        for c in full:
            given[c] = cap[c]
            open_.remove(c)
            left -= cap[c]
    total = sum(weight[c] for c in open_)
    for c in open_:
        given[c] = weight[c] * left // total
    out = {}
    for c in children:
        out |= brute_budgets(leaves, weights, given[c], epochs, depth, c)
    return out


def brute_mix(rows, weights, budget, epochs, seed):
    from hashlib import md5

    leaves = {}
    for _, path, n in rows:
        if n:
            leaves[path] = leaves.get(path, 0) + n
    budget = sum(leaves.values()) if budget is None else budget
    out = []
    for path, share in brute_budgets(leaves, weights, budget, epochs, 2).items():
        left = share
        for epoch in range(epochs + 1):
            key = lambda r, e=epoch: md5(f"{seed}:{e}:{r[0]}".encode()).hexdigest()
            for row in sorted((r for r in rows if r[1] == path and r[2]), key=key):
                if left <= 0:
                    break
                out.append((row[0], epoch, row[2], min(row[2], left)))
                left -= row[2]
    return sorted(out)


@pytest.mark.parametrize("budget", [None, 0, 37, 900, 10**6])
def test_mix(spark, monkeypatch, budget):
    monkeypatch.setattr(mixing, "ROWS_OF_RANGE", 3)
    rng = random.Random(8)
    rows = []
    for i in range(200):
        path = (rng.choice("abc"), rng.choice(["x", "y", None]))
        rows.append((i, path, rng.choice([0, 1, 5, 9])))
    rows += [(900, ("big", "z"), 3000), (901, (None, "z"), 2)]
    weights = {("a",): 5, ("b",): 0, ("a", "x"): 3, ("big",): 2}
    named = [(i, tuple(p or mixing.NO_NAME for p in path), n) for i, path, n in rows]
    df = spark.createDataFrame(
        [(i, "w " * n if n or i % 2 else None, *path, 5) for i, path, n in rows],
        "doc_id bigint, text string, d string, Lang string, Epoch int",
    )
    got = mixing.mix(df, ["d", "Lang"], weights, budget=budget, max_epochs=3, seed=4)
    assert got.columns == ["doc_id", "text", "d", "Lang", "epoch", "n_tokens", "n_taken"]
    taken = sorted((r.doc_id, r.epoch, r.n_tokens, r.n_taken) for r in got.collect())
    assert taken == brute_mix(named, weights, budget, 3, 4)


def test_mix_offers_siblings_what_no_weight_leaves(spark):
    """The supply below a node of weight 0 is no supply of the nodes above it."""
    rows = [(1, "a", "x", "r", 90), (2, "a", "x", "s", 4), (3, "a", "y", "r", 6), (4, "b", "x", "r", 80), (5, "c", "x", "r", 30)]
    df = spark.createDataFrame(
        [(i, *path, "w " * n) for i, *path, n in rows], "doc_id bigint, d string, l string, s string, text string"
    )
    weights = {("a",): 8, ("b",): 1, ("c",): 0, ("a", "x", "r"): 0, ("a", "y"): 0}
    got = mixing.mix(df, ["d", "l", "s"], weights, budget=60, max_epochs=1)
    assert sorted((r.doc_id, r.n_taken) for r in got.collect()) == [(2, 4), (4, 56)]


def test_mix_by_sql_with_no_weight(spark):
    """Query and SQL agree where nodes at several levels have no weight."""
    weights = {**queries.MIX_WEIGHTS, ("forum",): 0, ("web", "de"): 0, ("reference", "en", "src3"): 0}
    path = "/root/testdata/sf0.001/documents.parquet"
    mixed = mixing.mix(
        spark.read.parquet(path), [queries.domain(), "lang", "source"], weights,
        max_epochs=queries.MIX_EPOCHS, seed=queries.MIX_SEED,
    )
    got = mixed.select("doc_id", "lang", "source", "epoch", "n_tokens", "n_taken").collect()
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    sql = oracles.mixing(queries.DOMAIN, weights, queries.MIX_EPOCHS, queries.MIX_SEED)
    assert sorted(map(tuple, got)) == sorted(connection.execute(sql).fetchall())
    assert got and not any(r.source.startswith("src1") and len(r.source) > 4 for r in got)  # the forums


def test_mix_of_a_long_text(spark):
    df = spark.createDataFrame([(1, "w " * 500_000, "x"), (2, "a b", "y")], "doc_id bigint, text string, l string")
    got = mixing.mix(df, ["l"], {("x",): 3, ("y",): 1}, budget=100_000, max_epochs=1)
    assert sorted((r.doc_id, r.n_tokens, r.n_taken) for r in got.collect()) == [(1, 500_000, 99_998), (2, 2, 2)]


def test_mix_repeated_ids_and_empty(spark):
    df = spark.createDataFrame([(1, "a b", "x")] * 3 + [(None, "c", "x")], "doc_id bigint, text string, l string")
    got = mixing.mix(df, ["l"], {}, max_epochs=2)
    assert sorted((r.doc_id or 0, r.epoch) for r in got.collect()) == [(0, 0), (1, 0), (1, 0), (1, 0)]
    assert mixing.mix(df.limit(0), ["l"], {}).collect() == []


# --- licenses --------------------------------------------------------------


WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute_scan(text, threshold=0.8, telling=()):
    text = ascii_lower(text or "")
    words = WORDS.findall(text)
    starts, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        starts += found
        labels |= {label} if found else set()
    best, more = 0.0, set()
    run = max(len(t.split()) for _, t in licenses.TEMPLATES)
    for start in range(0, len(words), run):
        block = words[start : start + 2 * run]
        have = set(block)
        for label, template in licenses.TEMPLATES:
            need = set(template.split())
            tells = [one for one in telling if licenses.stands(*one, template.split())]
            told = all(licenses.stands(*one, block) for one in tells)
            if told and len(have & need) >= math.ceil(threshold * len(need) - 1e-9):
                more.add(label)
                best = max(best, len(have & need) / len(need))
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(labels)), ",".join(sorted(labels | more)), 1.0 if starts else best,
    )


def license_texts():
    rng = random.Random(10)
    texts = [None, "", "\n", "MIT License", "x MIT\nlicense y mit license", "submit license", "mitlicense",
             "Apache-License, apache license", "CC BY-NC 4.0", "Licensed under CC BY-NC 4.0.", "ﬁ mit license é",
             "\u212a mit \u00a0license", "GNU General Public License cc  by", "😀 cc by 😀 " * 3, "mit license " * 3000]
    pool = [t for _, text in licenses.TEMPLATES for t in text.split()] + ["zebra", "ähm", "MIT", "\n", "-"]
    texts += [" ".join(rng.choices(pool, k=rng.randint(1, 60))) for _ in range(150)]
    for _, template in licenses.TEMPLATES:
        for _ in range(12):
            words = template.split()
            rng.shuffle(words)
            gone = rng.randint(0, max(1, len(words) // 3))
            texts.append("before it\n" + "; ".join(words[gone:]).title() + "\nafter it")
    return texts


@pytest.mark.parametrize("telling", [(), licenses.TELLING])
def test_licenses(spark, telling):
    texts = license_texts()
    rows = [(i, t, "clash", 1.0) for i, t in enumerate(texts)] + [(3, "MIT License", "clash", 1.0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, labels string, Score double")
    got = licenses.scan(df, telling=telling)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = got.collect()
    assert len(got) == len(rows)
    # Rows that share an id have labels of their own.
    want = [(i, *brute_scan(t, telling=telling)) for i, t, *_ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert licenses.scan(df.limit(0)).collect() == []
    assert any(row.labels != row.base_labels for row in got)


def test_licenses_near_misses(spark):
    """Neighbours of a template are not taken for it when its telling words are asked for."""
    gnu = "You can redistribute it and/or modify it under the terms of the GNU {}General Public License."
    cases = [
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
        ("Licensed under CC BY-SA 4.0.", "cc-by,cc-by-sa"),
        ("Licensed under CC BY-NC-SA 4.0.", "cc-by"),
        ("Licensed under CC BY 4.0.", "cc-by"),
        ("Released under the BSD License.", ""),
        ("Released under the MIT License.", "mit"),
        ("Released under the MIT/X11 license.", "mit"),
        ("Released under the BSD license, mit Quelltext", ""),
        ("Licensed under the Mozilla Public License, Version 2.0.", ""),
        ("Licensed under the Apache License, Version 2.0.", "apache"),
        ("This program is free software: y" + gnu.format("")[1:], "gpl"),
        ("This program is free software: y" + gnu.format("Lesser ")[1:], "lgpl"),
        ("This program is free software: y" + gnu.format("Affero ")[1:], "agpl"),
        (gnu.format("Lesser ") + " " + gnu.format("").replace("You", "this program is free software, you"), "gpl,lgpl"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", ""),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
        ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of this software", ""),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ]
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "doc_id bigint, text string")
    got = {row.doc_id: row.labels for row in licenses.scan(df).collect()}
    for i, (text, labels) in enumerate(cases):
        assert got[i] == labels, text


def test_telling_words_by_pattern_and_by_list(spark):
    rng = random.Random(11)
    pool = ["gnu", "lesser", "library", "mit", "the", "license", "under", "nc", "sa", "by", "person", "or", "organization"]
    lists = [rng.choices(pool, k=rng.randint(0, 8)) for _ in range(300)]
    df = spark.createDataFrame([(" ".join(words),) for words in lists], "block string")
    patterns = [licenses.telling_place(*one) for one in licenses.TELLING]
    got = [r.told for r in df.select(licenses._told("block", patterns).alias("told")).collect()]
    assert got == [[i for i, one in enumerate(licenses.TELLING) if licenses.stands(*one, words)] for words in lists]


def test_licenses_in_sql(spark):
    """Query and SQL agree on near misses, wrapped notices and rows that share an id."""
    texts = license_texts() + ["Licensed under CC\nBY-NC 4.0.", "GNU Lesser\nGeneral Public License " * 40]
    texts += ["Permission is hereby granted, free of\ncharge, to any person obtaining a copy of\nthis software"]
    rows = [(i // 2, t) for i, t in enumerate(texts)]
    ours = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    connection = duckdb.connect()
    documents = pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    connection.register("documents", documents)
    sql = oracles.licenses(licenses.PHRASES, licenses.TEMPLATES, 0.8, licenses.TELLING)
    assert sorted(map(str, map(tuple, ours))) == sorted(map(str, connection.execute(sql).fetchall()))


def test_licenses_long_text(spark):
    """A line of a great many words, with a notice in its middle; and as many lines."""
    words = ["released", "under", "zebra", "the", "license"] * 40_000
    text = " ".join(words) + " Permission is hereby granted free of charge to any person obtaining a copy " + " ".join(words)
    rows = [(1, text), (2, "MIT License\n" * 100_000)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.labels, r.n_base) for r in got) == [(1, "mit", 0), (2, "mit", 100_000)]


def test_licenses_over_line_breaks(spark):
    """Every template, wrapped at any place, with and without much text around it."""
    cases = []
    for label, template in licenses.TEMPLATES:
        words = template.split()
        for width in (1, 2, 3, 5, 8):
            notice = "\n".join(" * " + " ".join(words[i : i + width]) for i in range(0, len(words), width))
            cases += [(label, notice), (label, "zebra\r\n\r\n" * (7 * width + len(words)) + notice + "\nzebra" * 90)]
    cases.append(("bsd", "Redistribution and use in source and binary forms, with or without\nmodification, are permitted"))
    df = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(cases)], "doc_id bigint, text string")
    got = {row.doc_id: row for row in licenses.scan(df).collect()}
    for i, (label, text) in enumerate(cases):
        assert label in got[i].labels.split(","), text
        assert got[i].score == 1.0
    scattered = [(0, "\n".join(f"{w} " + "zebra " * 60 for w in licenses.TEMPLATES[7][1].split()))]
    df = spark.createDataFrame(scattered, "doc_id bigint, text string")
    assert [row.labels for row in licenses.scan(df).collect()] == [""]
    text = "Released\nunder the Apache\nLicense.\nEine Zeile mit Text."
    apart = spark.createDataFrame([(0, text)], "doc_id bigint, text string")
    assert [row.labels for row in licenses.scan(apart).collect()] == ["apache"]


# --- URLs ------------------------------------------------------------------


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return ascii_lower(host), path


def brute_rule(host, path):
    fits = [
        r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.name), default=None)


URLS = [None, "", "no scheme", "http://", "://net/", "http://Net/x", "http://a.NET", "http://a.net/", "http://anet/",
        "https://example.net/en/1", "https://m.example.net/en", "https://example.com/de/x?y", "http://example.com?/de/",
        "http://x.org/fr/a#b", "http://org/fr/", "http://x.org#/fr/", "a://b://net/", "http://h/\n/q", "ftp://é.net/ü"]


def test_base_rules(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id bigint, url string, Host string")
    none = spark.createDataFrame([], "url string, bad boolean")
    got = urls.judge(df, none).collect()
    assert len(got) == len(URLS)
    for row in got:
        host, path = brute_url(URLS[row.page_id])
        rule = brute_rule(host, path)
        assert (row.host, row.path) == (host, path)
        assert row.rule == (rule.name if rule else None)
        assert row.verdict == (rule.verdict if rule else "allow")


def test_mined_rules_by_brute_force(spark):
    """All combinations of tokens, counted one by one."""
    rng = random.Random(12)
    sites = ["good.example.com", "spam.example.com", "mixed.example.org"]
    links = []
    for i in range(300):
        site = rng.choice(sites)
        folder = rng.choice(["a", "b"])
        bad = site.startswith("spam") and rng.random() < 0.9 or site.startswith("mixed") and folder == "b"
        links.append((f"{rng.choice(['http', 'https'])}://{site}/{folder}/{i}", bad))
    labelled = spark.createDataFrame(links + [(None, True), ("http://x/", None)], "url string, bad boolean")
    pages = spark.createDataFrame(
        [(i, u) for i, (u, _) in enumerate(links)] + [(0, links[0][0]), (None, links[1][0])], "page_id bigint, url string"
    )
    sets = [set(r.tokens) for r in urls.described(labelled.filter("url IS NOT NULL"), "url").collect()]
    bad = [b for _, b in links] + [False]
    counts = {}
    for tokens, mark in zip(sets, bad, strict=True):
        for n in range(1, len(tokens) + 1):
            for words in itertools.combinations(sorted(tokens), n):
                total, marked = counts.get(words, (0, 0))
                counts[words] = (total + 1, marked + mark)
    least = 1.25 * sum(bad) / len(bad)
    rules = {w: m / t for w, (t, m) in counts.items() if m >= 20 and m / t >= least}
    got = urls.judge(pages, labelled, rules=()).collect()
    assert len(got) == 302
    for row in got:
        # The last row has no id; its URL is the second.
        mine = [c for w, c in rules.items() if set(w) <= sets[1 if row.page_id is None else row.page_id]]
        assert row.verdict == ("block" if mine else "allow")
        assert row.confidence == (pytest.approx(max(mine)) if mine else None)
    assert {r.verdict for r in got} == {"allow", "block"}


def test_tokens(spark):
    df = spark.createDataFrame([(u,) for u in URLS + ["https://M.a.co.uk//x1/de/y2z/34.html?b=1&a&b=2&=3#f", "s://h"]], "url string")
    got = [r.tokens for r in urls.described(df, "url").collect()]
    assert got[-2] == sorted(
        ["scheme:https", "host:m.a.co.uk", "host:a.co.uk", "host:co.uk", "host:uk", "folder:x#", "folder:de",
         "folder:y#z", "last:#.html", "key:a", "key:b", "fragment", "folders:4"]
    )
    assert got[-1] == ["folders:0", "host:h", "scheme:s"]
    assert got[:4] == [[]] * 4


def test_urls_by_sql(spark):
    """Query and SQL on URLs at the edges, repeated page ids, and labels of all kinds."""
    rng = random.Random(13)
    pages = [(i, u) for i, u in enumerate(URLS)] + [(3, "http://a.b.net/x/5"), (None, "http://a.b.net/x/5")]
    for i in range(150):
        host = rng.choice(["a.example.com", "b.example.com", "www.b.example.com", "x.org"])
        folders = rng.choice(["", "en/", "en/blog/", "de/3/blog/"])
        pages.append((100 + i, f"http://{host}/{folders}{i}{rng.choice(['', '.html', '/', '?q=1&r', '#t'])}"))
    pages += [(900, "http://x.org/en/1234567890123456789012"), (901, "http://x.org/en/123456789012345678"), (902, "http://x.org/7x8")]
    labels = [(i, rng.randint(0, 1), rng.choice([0, 0, 1, None])) for i in range(150)]
    labels += [(123456789012345678, 0, 1), (3, None, None), (3, 0, 0)]
    frames = {
        "pages": spark.createDataFrame(pages, "page_id bigint, url string"),
        "labels": spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    }
    got = urls.judge(
        frames["pages"], queries.with_labels(frames["pages"], frames["labels"]), min_count=8, min_lift=1.1
    ).collect()
    assert any(r.mined for r in got) and len(got) == len(pages)
    connection = duckdb.connect()
    connection.register("pages", pa.table({"page_id": [i for i, _ in pages], "url": [u for _, u in pages]}))
    kinds = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])
    connection.register("labels", pa.Table.from_pylist([dict(zip(kinds.names, r, strict=True)) for r in labels], kinds))
    sql = oracles.urls(urls.RULES, 0.001, 8, 1.1, queries.NUMBER)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, connection.execute(sql).fetchall()))


def test_urls_with_very_many_tokens(spark):
    """Folders that always come together are one token, so that they do not multiply."""
    deep = "http://x.example.com/" + "/".join(f"f{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(300))
    links = [(f"{deep}/{i}", True) for i in range(30)] + [(f"http://y.org/{i}", i % 9 == 0) for i in range(90)]
    labelled = spark.createDataFrame(links, "url string, bad boolean")
    pages = spark.createDataFrame([(1, links[0][0]), (2, "http://y.org/5"), (3, "http://z.org/" + "a/" * 50_000)], "page_id int, url string")
    got = {r.page_id: r for r in urls.judge(pages, labelled, rules=()).collect()}
    assert [got[i].verdict for i in (1, 2, 3)] == ["block", "allow", "allow"]
    assert got[1].confidence == 1.0


def test_urls_empty_tables(spark):
    none = spark.createDataFrame([], "url string, bad boolean")
    pages = spark.createDataFrame([], "page_id bigint, url string, rule string")
    labelled = spark.createDataFrame([("http://x.org/1", True)] * 30, "url string, bad boolean")
    assert urls.judge(pages, none).collect() == urls.judge(pages, labelled).collect() == []
    page = spark.createDataFrame([(1, "http://x.org/1")], "page_id bigint, url string")
    # All are bad: no URL is worse than the others.
    assert [r.verdict for r in urls.judge(page, labelled, rules=()).collect()] == ["allow"]
