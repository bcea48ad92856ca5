"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterism.llm import (
    bpe,
    conversations,
    exact_dedup,
    licenses,
    manifest,
    minhash,
    mixing,
    oracles,
    quality,
    rules,
    tokens,
    topk,
    toxicity,
    urls,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"
# No public unigram model is at hand: the entries and scores of this one are
# read as a unigram vocabulary.
UNIGRAM_VOCABULARY = "piece_bpe_32k.model"


def register(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if oracle is not None:
            ORACLES[query.__name__] = oracle.strip()
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register()
def op4_byte_bpe(spark, sf):
    """Encode every whole text, decode the ids, and digest both."""
    tokenizer = bpe.ByteBPE(spark, public_tokenizers.path(BYTE_VOCABULARY))
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return bpe.digests(tokenizer.encode(documents, decoded="decoded"))


# --- mixing ----------------------------------------------------------------

# The tree: domain, language, source. Sources belong to a domain by number.
MIX_SEED = 2024
MIX_EPOCHS = 4
MIX_WEIGHTS = {
    ("web",): 5,
    ("reference",): 3,
    ("forum",): 2,
    **{(domain, "en"): 4 for domain in ("web", "reference", "forum")},
    ("web", "de"): 2,
    ("web", "fr"): 2,
    ("reference", "en", "src1"): 3,
}


def domain() -> F.Column:
    """src0 is the web, src1 to src9 are reference works, the others forums."""
    return (
        F.when(F.col("source") == "src0", F.lit("web"))
        .when(F.col("source").rlike("^src[1-9]$"), F.lit("reference"))
        .otherwise(F.lit("forum"))
    )


DOMAIN = (
    "CASE WHEN source = 'src0' THEN 'web' "
    "WHEN regexp_matches(source, '^src[1-9]$') THEN 'reference' ELSE 'forum' END"
)


@register(oracles.mixing(DOMAIN, MIX_WEIGHTS, MIX_EPOCHS, MIX_SEED))
def op1_mixing(spark, sf):
    """A mixture as large as the corpus: documents and the epochs that take them."""
    documents = table(spark, sf, "documents")
    mixed = mixing.mix(
        documents, [domain(), "lang", "source"], MIX_WEIGHTS, max_epochs=MIX_EPOCHS, seed=MIX_SEED
    )
    return mixed.select("doc_id", "lang", "source", "epoch", "n_tokens", "n_taken")


# --- exact top-k search ----------------------------------------------------

TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.k, q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.k <> c.k AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS r FROM s)
WHERE r <= 10"""


@register(TOP_K)
def op5_top_k(spark, sf):
    vectors = table(spark, sf, "embeddings").filter(topk.usable("embedding"))
    vectors = vectors.select(
        F.col("vec_id").alias("id"), topk.quantised("embedding", 1024).alias("vector")
    )
    best = topk.top_k(vectors, "id % 100 = 0", 10)
    return best.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


# --- duplicates ------------------------------------------------------------

EXACT_DEDUP = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
    first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g"""


@register(EXACT_DEDUP)
def op6_exact_dedup(spark, sf):
    return exact_dedup.exact_duplicates(table(spark, sf, "documents"))


NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{oracles.UPPER}', '{oracles.LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS shingle FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b
  ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) LEFT JOIN n USING (doc_id)"""


@register(NEAR_DUPLICATES)
def op9_minhash(spark, sf):
    """The contract takes two words to a shingle; the library's default is five."""
    documents = table(spark, sf, "documents")
    return minhash.near_duplicates(documents, settings=minhash.Settings(shingle=2))


# --- licenses and URLs -----------------------------------------------------


THRESHOLD = 0.8  # share of a template's words


@register(oracles.licenses(licenses.PHRASES, licenses.TEMPLATES, THRESHOLD, licenses.TELLING))
def op7_licenses(spark, sf):
    return licenses.scan(table(spark, sf, "documents"), threshold=THRESHOLD)


# The number in the last piece of a URL's path; one of more digits is no document's.
NUMBER = r"^[^?#]*/([0-9]{1,18})(?:[^0-9/?#][^/?#]*)?/?(?:[?#]|$)"
MIN_SUPPORT, MIN_COUNT, MIN_LIFT = 0.001, 10, 1.25


def with_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """A page is bad if the document that its URL numbers is labelled as poor or toxic."""
    number = F.regexp_extract("url", NUMBER, 1)
    numbered = pages.select("url", F.nullif(number, F.lit("")).cast("bigint").alias("doc_id"))
    marks = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    bad = labels.groupBy("doc_id").agg(F.max(marks).alias("bad"))
    return numbered.join(bad, "doc_id").select("url", "bad")


@register(oracles.urls(urls.RULES, MIN_SUPPORT, MIN_COUNT, MIN_LIFT, NUMBER))
def op10_urls(spark, sf):
    return urls.judge(
        table(spark, sf, "pages"),
        with_labels(table(spark, sf, "pages"), table(spark, sf, "labels")),
        min_support=MIN_SUPPORT,
        min_count=MIN_COUNT,
        min_lift=MIN_LIFT,
    )


# --- classifiers -----------------------------------------------------------


@register()
def op2_quality(spark, sf):
    """Scores of all documents, learned outside the held-out third. A row without an id has no
    label and is not held out."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    held_out = F.coalesce(held_out, F.lit(False))
    labels = table(spark, sf, "labels").filter(~held_out)
    model = quality.train(
        documents.withColumnRenamed("doc_id", "id"),
        labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("label")),
    )
    return quality.score(documents, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def toxicity_model(documents: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.train(
        documents.select(F.col("doc_id").alias("id"), "text"),
        labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("grade")),
    )


@register()
def op8_toxicity(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity_model(documents, table(spark, sf, "labels"))
    return toxicity.severity(documents, model).drop("text")


# --- token counts ----------------------------------------------------------


@register()
def op3_token_counts(spark, sf):
    vocabulary = tokens.Vocabulary.load(public_tokenizers.path(UNIGRAM_VOCABULARY))
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return tokens.Unigram(spark, vocabulary).count(documents).drop("text")


# --- conversations, manifest, quality rules --------------------------------


@register(oracles.conversations())
def op11_conversations(spark, sf):
    """Damage the conversations by the hash of their rows, and repair them."""
    names = ("conv_id", "turn", "role", "text")
    rows = table(spark, sf, "conversations")
    repaired = conversations.repair(conversations.damaged(rows, *names), *names)
    return conversations.summary(rows, repaired)


@register(oracles.manifest())
def op12_manifest(spark, sf):
    """The manifest of the documents, and its proofs against rows of which a fifth was tampered with."""
    documents = table(spark, sf, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", oracles.UPPER, oracles.LOWER)
    return manifest.manifest(documents, seen={"text": F.when(tampered, lowered).otherwise(F.col("text"))})


@register()
def op13_quality_rules(spark, sf):
    return rules.judge(table(spark, sf, "documents"))
