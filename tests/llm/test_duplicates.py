"""Exact and near duplicates, and components, against brute force."""

import hashlib
import random
import re
from pathlib import Path

import pytest

from asterism.llm import components, exact_dedup, minhash, words
from asterism.session import scratch_root

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, keep_id string, `Group_Size` int"


def documents(spark, rows):
    """With extra columns that clash with the operators' own."""
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def exact(rows):
    groups = {}
    for id_, text in rows:
        groups.setdefault(SPACE.sub("", text or ""), []).append((id_, len(text or "")))
    out = []
    for id_, text in rows:
        norm = SPACE.sub("", text or "")
        group = groups[norm]
        best = min(group, key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        out.append(
            (
                id_,
                best[0],
                len(group),
                (id_, len(text or "")) == best,
                hashlib.sha256(norm.encode()).hexdigest(),
            )
        )
    return out


def edge_rows():
    rng = random.Random(5)
    words = ["ab", "é", "😀", "long" * 40, "x"]
    rows = []
    for i in range(60):
        text = " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 300, 4000])))
        rows.append((i, text))
        if i % 3 == 0:
            rows.append((100 + i, text.replace(" ", rng.choice(["\n", "  ", "\t", ""]))))
    rows += [(200, None), (201, ""), (202, " \n\r\x0b"), (203, "\xa0"), (204, "\xa0 ")]
    rows += [(None, "ab ab"), (205, "abab"), (None, "only without id"), (206, "twice"), (206, "twice")]
    return rows


@pytest.mark.parametrize("bits", [64, 3])
def test_exact(spark, bits):
    """Also when chunk hashes of three bits stand for many contents each."""
    rows = edge_rows()
    got = exact_dedup.exact_duplicates(documents(spark, rows), hash_bits=bits)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, exact(rows)))


def test_exact_one_large_group(spark):
    rows = [(i, "the same text") for i in range(3000)] + [(9000, "another")]
    got = exact_dedup.exact_duplicates(documents(spark, rows)).collect()
    assert sum(r.kept for r in got) == 2
    assert {r.keep_id for r in got} == {0, 9000}


def test_deduplicated_rows(spark):
    df = documents(spark, edge_rows())
    kept = exact_dedup.deduplicated(df)
    assert kept.columns == df.columns
    left = [SPACE.sub("", r.text or "") for r in kept.collect() if r.doc_id is not None]
    assert len(left) == len(set(left))
    expected = {SPACE.sub("", t or "") for _, t in edge_rows()}
    assert {SPACE.sub("", r.text or "") for r in kept.collect()} == expected


@pytest.mark.parametrize("run", [exact_dedup.exact_duplicates, minhash.near_duplicates])
def test_empty_table(spark, run):
    assert run(documents(spark, [])).collect() == []


def test_exact_long_texts(spark):
    """Texts of many chunks, equal but for blanks, or but for one character near the end."""
    rng = random.Random(7)
    long = "".join(rng.choices("abcdefgh \n", k=2_000_000))
    rows = [(1, long), (2, long.replace(" ", "\t\t")), (3, long[:-9] + "X" + long[-9:]), (4, long[:1_000_000])]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(documents(spark, rows)).collect()}
    assert got == {1: (2, 2, False), 2: (2, 2, True), 3: (3, 1, True), 4: (4, 1, True)}


def test_cuts_follow_content():
    """A shift in front of a long text changes no chunk but the first ones."""
    rng = random.Random(1)
    text = "".join(rng.choices("abcdefghij", k=200_000))
    a, b = exact_dedup.normalised_chunks([text, "zz" + text])
    assert "".join(c.decode() for c in a) == text
    assert max(map(len, a)) <= exact_dedup.LONGEST
    assert len(set(a) & set(b)) > 0.9 * len(a)


# --- near duplicates -------------------------------------------------------


def shingles(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near(rows, width, percent=80):
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (a, s) in enumerate(sets):
        for b, t in sets[:n]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {(i, len(s), find(i), find(i) == i) for i, s in sets}


def near_rows(rng):
    """Originals with edited copies, chains, shared passages, and texts at the edges."""
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    rows, n = [], 0
    for group in range(12):
        base = rng.choices(vocabulary, k=rng.choice([3, 12, 60, 200]))
        for _ in range(12):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 12))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if group % 3 == 0:
                words += passage
            rows.append((n, rng.choice([" ", "\n", "  "]).join(words)))
            n += 1
            base = words if group % 4 == 1 else base
    rows += [(900, None), (901, ""), (902, "  "), (903, "one"), (904, "ONE"), (905, "one two")]
    return rows


@pytest.mark.parametrize("width", [2, 5])
@pytest.mark.parametrize("seed", [1, 2])
def test_near(spark, width, seed):
    rows = near_rows(random.Random(seed))
    settings = minhash.Settings(shingle=width)
    got = {tuple(r) for r in minhash.near_duplicates(documents(spark, rows), settings=settings).collect()}
    assert got == near(rows, width)


def test_near_star_group(spark):
    """Copies that resemble the original, but hardly one another, and no smaller id leads."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(2000)]
    base = rng.choices(vocabulary, k=400)
    rows = []
    for i in range(150):
        words = list(base)
        for at in rng.sample(range(400), 20):
            words[at] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    rows.append((5000, " ".join(base)))
    got = {tuple(r) for r in minhash.near_duplicates(documents(spark, rows), settings=minhash.Settings(2)).collect()}
    assert got == near(rows, 2)


def test_near_repeated_and_null_ids(spark):
    rows = [(7, "a b c"), (7, "a b c"), (None, "a b c"), (8, "A  B\tC"), (None, None)]
    got = sorted(map(str, map(tuple, minhash.near_duplicates(documents(spark, rows)).collect())))
    expected = [(7, 1, 7, True), (7, 1, 7, True), (None, 1, None, True), (8, 1, 7, False), (None, 0, None, True)]
    assert got == sorted(map(str, expected))


def test_near_words_made_to_collide(spark):
    """Thue-Morse words and their complements agree in every polynomial modulo 2**64."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    x, y = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    rows = [(1, f"{x} {x}"), (2, f"{y} {y}"), (3, f"{x} {y} {x}"), (4, f"{y} {x} {y}"), (5, f"{x} {x} {y} {y} {x}")]
    for width in (2, 5):
        settings = minhash.Settings(shingle=width)
        got = {tuple(r) for r in minhash.near_duplicates(documents(spark, rows), settings=settings).collect()}
        assert got == near(rows, width)
    (one,), (two,) = words.shingle_sets([f"{x} {x} {y}"], 1, {0: None, 1: None})
    assert len(one) == len(two) == 2 and not set(one.tolist()) & set(two.tolist())
    ((short, long),) = words.shingle_sets(["a b", "a b c"], 2, {1: 2})
    assert len(short) == 1 and len(long) == 0


def test_near_ids_with_several_texts(spark):
    """Each text of an id has links of its own; the id joins them."""
    rows = near_rows(random.Random(5))[:80]
    rows = [(i // 2, t) for i, t in rows]
    settings = minhash.Settings(shingle=2)
    got = sorted(map(tuple, minhash.near_duplicates(documents(spark, rows), settings=settings).collect()))
    label = {i: find for i, _, find, _ in near(rows, 2)}
    sizes = sorted((i, len(shingles(t, 2)), label[i], label[i] == i) for i, t in rows)
    assert got == sizes


def test_near_long_texts(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200_000)]
    other = base[:190_000] + ["x" * 100_000] + base[190_000:]
    rows = [(1, " ".join(base)), (2, "\n".join(other)), (3, " ".join(base[:100_000]))]
    got = {tuple(r) for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert got == near(rows, 5)
    assert {(r[0], r[2]) for r in got} == {(1, 1), (2, 1), (3, 3)}


def test_words_of_a_text_split_slice_by_slice(monkeypatch):
    texts = ["a  b\tC\n d ", "", None, "e", " f\x0bg"]
    whole = words.word_digests(texts)
    monkeypatch.setattr(words, "SLICE", 1)
    for a, b in zip(whole, words.word_digests(texts), strict=True):
        assert a.tolist() == b.tolist()
    assert whole[1].tolist() == [4, 0, 0, 1, 2]


def test_estimate_spares_links():
    """The packed bits of a pair at the threshold stay above the cut."""
    settings = minhash.Settings()
    assert settings.agreements < settings.hashes * 0.85
    assert settings.agreements > settings.hashes * 0.6


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(1000, i) for i in range(1001, 2500)] + [(i, i + 1) for i in range(3000, 3040)]
    links += [(None, 4), (5, None)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {tuple(r) for r in components.components(df).collect()}
    assert got == {(x, find(x)) for x in parent}
    assert components.components(df.limit(0)).count() == 0


def test_scratch_tables_are_released(spark):
    """What stays below the shared folder is what the result reads."""
    before = set(Path(scratch_root(spark)).iterdir()) if Path(scratch_root(spark)).exists() else set()
    found = minhash.near_duplicates(documents(spark, [(1, "a b c"), (2, "a b c"), (3, "d")]))
    left = {p.name.rsplit("-", 1)[0] for p in set(Path(scratch_root(spark)).iterdir()) - before}
    assert left == {"signatures", "labels"}
    assert found.count() == 3
