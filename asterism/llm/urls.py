"""URL filters: fixed host and path rules, then association rules mined from labels.

URLs become sets of tokens: the scheme, every suffix of the host, every folder,
the shape of the last piece, every query key. Spark's FP-growth mines the
combinations that go along with a bad label. Rules are pruned that are rare, or
whose confidence is not above the share of bad URLs by a factor: labels are more
or less frequent in a corpus, so no fixed confidence would do. Tokens that
always come together, such as the folders of one deep path, are mined as one;
else every part of them would be a combination of its own.

A rule is indexed under the one token of its combination that fewest URLs have,
so a URL meets only the rules of its own tokens, and the rest of the combination
is compared then. URLs of the same tokens are matched once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import settled, stored

BAD = "label:block"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The base rules.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def nothing() -> Column:
    return F.array().cast("array<string>")


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or #."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Scheme, host suffixes, folders, shape of the last piece, query keys, fragment, and the
    number of folders, each once. Numbers in folders and the last piece become #."""
    pieces = F.filter(F.split(path, "/"), lambda p: p != "")
    shapes = F.transform(pieces, lambda p: F.regexp_replace(p, "[0-9]+", "#"))
    depth = F.size(pieces)
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda kv: F.split(kv, "=")[0])
    labels = F.split(host, r"\.")
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))

    def named(kind: str, values: Column) -> Column:
        held = F.filter(values, lambda value: value != "")
        return F.transform(held, lambda value: F.concat(F.lit(kind + ":"), value))

    every = F.concat(
        named("scheme", F.array(F.regexp_extract(url, r"(?s)^(.*?)://", 1))),
        named("host", suffixes),
        named("folder", F.slice(shapes, 1, F.greatest(depth - 1, F.lit(0)))),
        named("last", F.slice(shapes, F.greatest(depth, F.lit(1)), 1)),
        named("key", keys),
        F.when(F.contains(url, F.lit("#")), F.array(F.lit("fragment"))).otherwise(nothing()),
        F.array(F.concat(F.lit("folders:"), depth.cast("string"))),
    )
    return F.array_sort(F.array_distinct(every))


def described(df: DataFrame, url: str) -> DataFrame:
    """``df`` with host, path and tokens of its URLs."""
    parts = df.withColumn("url", F.coalesce(F.col(url), F.lit(""))).withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}
    )
    tokens = tokens_of(F.col("url"), F.col("host"), F.col("path"))
    return parts.withColumn("tokens", F.when(F.col("host") != "", tokens).otherwise(nothing()))


def base_rule(rules: Sequence[Rule], field: str) -> Column:
    """Name or verdict of the longest rule that fits host and path; null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        inside = (F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit("." + rule.host))
        fits = inside & F.startswith(F.col("path"), F.lit(rule.path))
        out = F.when(fits, F.lit(getattr(rule, field))).otherwise(out)
    return out


def _as_one(baskets: DataFrame, least: float) -> DataFrame:
    """(id, words): frequent tokens, those that come in the same baskets replaced by the first.

    Tokens with the same number of baskets and the same two 64-bit sums of
    their ids come in the same ones.
    """
    places = baskets.select("id", F.explode("tokens").alias("token"))
    sums = [F.bit_xor(F.xxhash64(F.lit(seed), "id")).alias(f"sum{seed}") for seed in (1, 2)]
    frequent = places.groupBy("token").agg(F.count("*").alias("n"), *sums).filter(F.col("n") >= least)
    frequent = stored(frequent, "tokens")
    same = ["n", "sum1", "sum2"]
    first = frequent.groupBy(*same).agg(F.min("token").alias("token"))
    kept = places.join(first.select("token"), "token")
    return kept.groupBy("id").agg(F.array_sort(F.collect_list("token")).alias("words"))


def mine(labelled: DataFrame, min_support: float, min_count: int, min_lift: float) -> DataFrame:
    """(rule, words, confidence, support): combinations that go along with a bad label.

    ``labelled`` has tokens and bad. A rule's confidence is at least
    ``min_lift`` times the share of bad URLs; at least ``min_support`` of the
    URLs, and ``min_count``, are bad and have its words.
    """
    spark = labelled.sparkSession
    empty = "rule string, words array<string>, confidence double, support double"
    numbered = labelled.select(F.monotonically_increasing_id().alias("id"), "tokens", "bad")
    baskets = stored(numbered, "baskets")
    rows, bad = baskets.agg(F.count("*"), F.coalesce(F.sum(F.col("bad").cast("int")), F.lit(0))).first()
    least = max(min_support, min_count / max(rows, 1))
    confidence = min_lift * (bad / max(rows, 1))
    if rows < min_count or not bad or confidence > 1:
        return spark.createDataFrame([], empty)
    words = stored(_as_one(baskets, least * rows * (1 - 1e-12)), "words")
    marks = F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(nothing())
    items = baskets.join(words, "id", "left").select(F.concat(F.coalesce("words", nothing()), marks).alias("items"))
    growth = FPGrowth(itemsCol="items", minSupport=least, minConfidence=confidence)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    model = growth.setNumPartitions(partitions).fit(stored(items, "items"))
    rules = model.associationRules.filter(F.col("consequent") == F.array(F.lit(BAD)))
    words = F.array_sort("antecedent")
    return rules.select(F.array_join(words, " ").alias("rule"), words.alias("words"), "confidence", "support")


def matched(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined, confidence): the best rule of every set of tokens that one matches."""
    counts = sets.select(F.explode("tokens").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    words = rules.select("rule", F.explode("words").alias("word")).join(counts, "word")
    rarest = words.groupBy("rule").agg(F.min(F.struct("n", "word")).alias("x"))
    index = stored(
        rules.join(rarest.select("rule", F.col("x.word").alias("word")), "rule"), "rule_index"
    )
    places = sets.select("tokens", F.explode("tokens").alias("word"))
    hits = places.join(index, "word").filter(F.size(F.array_except("words", "tokens")) == 0)
    best = hits.groupBy("tokens").agg(F.max(F.struct("confidence", "support", "rule")).alias("best"))
    return best.select(
        "tokens", F.col("best.rule").alias("mined"), F.col("best.confidence").alias("confidence")
    )


def judge(
    df: DataFrame,
    labelled: DataFrame,
    id_: str = "page_id",
    url: str = "url",
    rules: Sequence[Rule] = RULES,
    min_support: float = 0.001,
    min_count: int = 20,
    min_lift: float = 1.25,
) -> DataFrame:
    """One row for each row of ``df``: id, host, path, rule, verdict, mined, confidence.

    ``labelled`` has url and bad (boolean). A mined rule holds for at least
    ``min_support`` of the labelled URLs and for ``min_count`` of them, all bad,
    and bad ones are ``min_lift`` times as frequent among the URLs it fits as
    among all. ``rule`` is the longest base rule that fits, ``mined`` the most
    confident mined rule that matches (ties: more support, then the later
    name); without a base rule a mined one blocks, and all else is allowed. A
    null URL, or one without ``://``, has an empty host and path and no tokens,
    and is allowed. Labels that are null count as good. Without labels, or
    without a bad one, nothing is mined. Rows are judged one by one, also those
    that share an id or have none; an empty table gives no rows. URLs may have
    any number of tokens. Other columns are ignored.
    """
    known = described(labelled.select("url", F.coalesce("bad", F.lit(False)).alias("bad")), "url")
    pages = described(df.select(F.col(id_).alias("id"), F.col(url).alias("url")), "url")
    pages = stored(pages.drop("url"), "pages")

    def best_rules() -> DataFrame:
        mined = mine(known.filter("host <> ''"), min_support, min_count, min_lift)
        return matched(stored(pages.select("tokens").distinct(), "sets"), stored(mined, "rules"))

    best = settled(df.sparkSession, "matches", best_rules)
    method = F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return pages.join(best, "tokens", "left").select(
        F.col("id").alias(id_),
        "host",
        "path",
        base_rule(rules, "name").alias("rule"),
        F.coalesce(base_rule(rules, "verdict"), method).alias("verdict"),
        "mined",
        "confidence",
    )
