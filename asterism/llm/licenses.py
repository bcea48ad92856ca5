"""License scans: phrases, and an exact set-similarity join with notice templates.

Words are runs of ASCII letters (A-Z lower-cased), digits and characters beyond
ASCII. A text block is a window of words that any run as long as the longest
template falls into, whatever lines the words stand in: a notice may be wrapped,
and a long line is no bag of words. A block matches a template when it holds at
least ``threshold`` of the template's distinct words, and the words that tell
the template from its neighbours. The words are ordered by
their frequency in the whole corpus, the rarest first; of ``n`` words of which
``o`` are needed, one of the first ``n - o + 1`` has to be in the block (prefix
filter), the block needs ``o`` words (length filter), and the words left behind
the first common one have to suffice (positional filter). What remains is
compared in full. Words outside all templates cannot match, so the order is
needed, and counted, only for those inside.

Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import stored

# Phrases of the base rules.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Openings of common license notices, as words.
TEMPLATES = (
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
)

# Words that tell a template from its neighbours, and what may not follow them.
# Those that stand in a template have to stand in a block as well.
TELLING = (
    ("gnu", ("lesser", "affero", "library", "free")),
    ("lesser", ()),
    ("affero", ()),
    ("apache", ()),
    ("mit license|the mit|under mit", ()),  # mit alone is a German word
    ("mozilla", ()),
    ("nc", ("sa", "nd")),
    ("by sa", ()),
    ("attribution", ("noncommercial", "non", "sharealike", "share", "noderivatives", "noderivs", "no")),
    ("person", ("or organization",)),
)

Telling = Sequence[tuple[str, Sequence[str]]]

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def n_words(text: Column) -> Column:
    """Pieces between gaps, less the empty ones at the ends."""
    pieces = F.split(text, f"{GAP}++", -1)
    ends = (F.element_at(pieces, 1) == "").cast("int") + (F.element_at(pieces, -1) == "").cast("int")
    return F.greatest(F.size(pieces) - ends, F.lit(0)).cast("bigint")


def _tree(words: Sequence[str]) -> str:
    """Pattern of all words that reads common beginnings once."""
    heads: dict[str, list[str]] = {}
    for word in words:
        if word:
            heads.setdefault(word[0], []).append(word[1:])
    branches = [head + _tree(rest) for head, rest in sorted(heads.items())]
    if not branches:
        return ""
    body = "(?:" + "|".join(branches) + ")"
    return f"{body}?+" if "" in words else body


def known_words(text: Column, vocabulary: Sequence[str]) -> Column:
    """The distinct words of a text that are in the vocabulary, lower-cased."""
    pattern = f"(?i){GAP}({_tree(vocabulary)})(?!{WORD})"
    found = F.regexp_extract_all(F.concat(F.lit(" "), text), F.lit(pattern), F.lit(1))
    return F.array_distinct(F.transform(found, F.lower))


def place(phrase: str) -> str:
    """Pattern of a phrase's words standing consecutively; (?i) folds ASCII letters only."""
    return f"(?i)(?<!{WORD})" + f"{GAP}+".join(phrase.split()) + f"(?!{WORD})"


def telling_place(phrase: str, not_before: Sequence[str]) -> str:
    """Pattern of a phrase, or of one of several, that none of ``not_before`` follows."""
    others = "|".join(f"{GAP}+".join(other.split()) for other in not_before)
    some = "|".join(place(one) for one in phrase.split("|"))
    return f"(?i)(?:{some})" + (f"(?!{GAP}+(?:{others})(?!{WORD}))" if others else "")


def _any(texts: str, pattern: str) -> Column:
    return F.exists(texts, lambda text: text.rlike(pattern))


def _told(text: str, patterns: Sequence[str]) -> Column:
    """Numbers of the patterns that stand in a text."""
    found = [F.when(F.col(text).rlike(p), F.lit(i)) for i, p in enumerate(patterns)]
    return F.array_compact(F.array(*found).cast("array<int>"))


def phrase_columns(text: Column, phrases: Mapping[str, str]) -> dict[str, Column]:
    """n_words, n_base, first_word, last_word and the array base of labels."""
    anywhere = "|".join(place(p) for p in phrases)
    # A cheap test that every match passes comes first.
    rarest = sorted({max(p.split(), key=len) for p in phrases})
    lowered = F.lower(text)
    possible = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(w)) for w in rarest])
    pieces = F.split(text, anywhere, -1)
    found = F.regexp_extract_all(text, F.lit(anywhere), F.lit(0))
    matches = F.when(possible, found).otherwise(F.array().cast("array<string>"))
    some = F.size("matches") > 0
    last = F.element_at("matches", -1)
    return {
        "matches": matches,
        "n_words": n_words(text),
        "n_base": F.size("matches").cast("bigint"),
        "first_word": F.when(some, n_words(F.element_at(pieces, 1))),
        "last_word": F.when(
            some, F.col("n_words") - n_words(F.element_at(pieces, -1)) - n_words(last)
        ),
        "base": F.array_compact(
            F.array(*[F.when(_any("matches", place(p)), F.lit(x)) for p, x in phrases.items()])
        ),
    }


def windows(text: Column, run: int) -> Column:
    """The different windows of words; each run of ``run`` words lies in one of them."""

    def cut(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(run))
        return F.transform(starts, lambda at: F.array_join(F.slice(words, at + 1, 2 * run), " "))

    # An array of one, so that the words are split once for all windows.
    words = F.filter(F.split(text, f"{GAP}++", -1), lambda word: word != "")
    return F.array_distinct(F.flatten(F.transform(F.array(words), cut)))


def run_of(templates: Sequence[tuple[str, str]]) -> int:
    """Words of the longest template."""
    return max((len(text.split()) for _, text in templates), default=1)


def stands(phrase: str, not_before: Sequence[str], words: Sequence[str]) -> bool:
    """Whether a phrase, or one of several, stands in a list of words with none of
    ``not_before`` behind it."""

    def at(i: int, part: str) -> bool:
        return list(words[i : i + len(part.split())]) == part.split()

    return any(
        at(i, one) and not any(at(i + len(one.split()), other) for other in not_before)
        for one in phrase.split("|")
        for i in range(len(words))
    )


def musts(templates: Sequence[tuple[str, str]], telling: Telling) -> list[list[int]]:
    """Numbers of the telling phrases that stand in each template, and so have to in its blocks."""
    return [[i for i, one in enumerate(telling) if stands(*one, text.split())] for _, text in templates]


def similar_blocks(
    documents: DataFrame,
    templates: Sequence[tuple[str, str]],
    threshold: float,
    telling: Telling = (),
) -> DataFrame:
    """(id, label, containment) of every block that holds enough of a template's words,
    and those of ``telling`` that stand in it.

    ``documents`` has id and text. Templates without words match nothing.
    """
    spark = documents.sparkSession
    worded = [(label, text) for label, text in templates if text.split()]
    sets = [(label, list(dict.fromkeys(text.split()))) for label, text in worded]
    vocabulary = sorted({word for _, words in sets for word in words})
    if not vocabulary:
        return documents.select("id", F.lit("").alias("label"), F.lit(0.0).alias("containment")).limit(0)
    needed = [math.ceil(threshold * len(words) - 1e-9) for _, words in sets]
    known = known_words(F.col("text"), vocabulary)
    counts = documents.select(F.explode(known).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    # One row for each word of the templates at most.
    frequency = {row["word"]: row["n"] for row in counts.collect()}
    order = sorted(vocabulary, key=lambda word: (frequency.get(word, 0), word))
    rank = {word: i for i, word in enumerate(order)}

    tells = [telling_place(*one) for one in telling]
    rows, index, prefix = [], [], set()
    for template, ((label, words), need, must) in enumerate(
        zip(sets, needed, musts(worded, telling), strict=True)
    ):
        words = sorted(words, key=rank.__getitem__)
        rows.append((template, label, words, len(words), need, must))
        for position, word in enumerate(words[: len(words) - need + 1]):
            index.append((word, template, position))
            prefix.add(word)
    table = spark.createDataFrame(
        rows, "template int, label string, t array<string>, size int, need int, must array<int>"
    )
    postings = spark.createDataFrame(index, "word string, template int, position int")

    ranks = F.create_map(*[F.lit(x) for word in order for x in (word, rank[word])])
    few = F.array(*[F.lit(word) for word in sorted(prefix)])

    def enough(hits: Column) -> Column:
        held = [
            F.size(F.array_intersect(hits, F.array(*map(F.lit, words)))) >= need
            for (_, words), need in zip(sets, needed, strict=True)
        ]
        return F.arrays_overlap(hits, few) & reduce(lambda a, b: a | b, held)

    # A text without enough of a template's words has no block with them. The
    # array of one is there so that the words are looked for once.
    possible = documents.filter(F.exists(F.array(known), enough))
    blocks = possible.select("id", F.explode(windows(F.col("text"), run_of(worded))).alias("block"))
    blocks = blocks.select("id", "block", known_words(F.col("block"), vocabulary).alias("hits"))
    blocks = blocks.filter(F.exists(F.array("hits"), enough))
    in_order = F.array_sort("hits", lambda x, y: ranks[x] - ranks[y])
    blocks = blocks.select("id", in_order.alias("hits"), _told("block", tells).alias("told")).distinct()
    # The template tables have a fixed size: that of the parameter.
    places = blocks.select("id", "hits", "told", F.posexplode("hits").alias("at", "word"))
    candidates = places.join(F.broadcast(postings), "word").join(F.broadcast(table), "template")
    left = F.least(F.col("size") - F.col("position") - 1, F.size("hits") - F.col("at") - 1)
    # ``position`` common words at most stand before this one in the template.
    possible_overlap = F.least("position", "at") + 1 + left
    candidates = candidates.filter(F.size("hits") >= F.col("need")).filter(
        possible_overlap >= F.col("need")
    )
    overlap = F.size(F.array_intersect("hits", "t"))
    candidates = candidates.filter(F.size(F.array_except("must", "told")) == 0)
    return candidates.filter(overlap >= F.col("need")).select(
        "id", "label", (overlap / F.col("size")).alias("containment")
    )


def scan(
    df: DataFrame,
    id_: str = "doc_id",
    text: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = 0.8,
    telling: Telling = TELLING,
) -> DataFrame:
    """One row for each row of ``df``: id, n_words, n_base, first_word, last_word,
    base_labels, labels, score.

    ``n_base`` counts all places of the phrases, ``first_word`` and
    ``last_word`` are the smallest and largest word at which one starts.
    ``labels`` adds the templates found; ``score`` is 1 with a phrase, else the
    largest containment that reached the threshold, else 0. A block has to hold
    a template's telling words too, so that a near miss is not taken for it;
    templates of one's own may need others than ``TELLING``, or none. Null and
    empty texts have no words and no labels. Rows that share an id, null ids
    too, are scanned one by one. Other columns are ignored.
    """
    # The labels hang on the text, so rows that share an id are told apart by it.
    known = F.coalesce(F.col(text), F.lit(""))
    key = F.struct(F.col(id_).alias("own"), F.xxhash64(known).alias("mark"))
    documents = df.select(key.alias("id"), known.alias("text"))
    columns = phrase_columns(F.col("text"), phrases)
    based = documents
    for name, column in columns.items():
        based = based.withColumn(name, column)
    based = based.drop("text", "matches")
    found = similar_blocks(documents, templates, threshold, telling)
    found = found.groupBy("id").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best")
    )
    found = stored(found, "licenses").withColumnRenamed("id", "found_id")
    joined = based.join(found, F.col("id").eqNullSafe(F.col("found_id")), "left")
    none = F.array().cast("array<string>")

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    return joined.select(
        F.col("id.own").alias(id_),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        listed(F.col("base")).alias("base_labels"),
        listed(F.concat("base", F.coalesce("more", none))).alias("labels"),
        score.alias("score"),
    )
