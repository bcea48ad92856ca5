"""A corpus pipeline: documents in, token ids out.

Each stage works on all that its predecessor kept. ``run`` writes every stage
to the shared scratch folder and reads it back, so a lost executor costs no
more than the tasks it worked on; all but the last table go again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterism.llm import bpe, exact_dedup, minhash, mixing, toxicity
from asterism.llm.common import settled, stored
from asterism.llm.queries import (
    BYTE_VOCABULARY,
    MIX_EPOCHS,
    MIX_SEED,
    MIX_WEIGHTS,
    domain,
    table,
    toxicity_model,
)


def _named_like(docs: DataFrame, df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{name}`") for name in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not flag."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    marks = {"out": "_severity", "flag": "_toxic", "grade": "_grade"}
    judged = toxicity.severity(docs, model, **marks)
    return _named_like(docs, judged.filter("NOT _toxic"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return minhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of the target weights; a document comes once for each epoch that takes it."""
    mixed = mixing.mix(
        docs, [domain(), "lang", "source"], MIX_WEIGHTS, max_epochs=MIX_EPOCHS, seed=MIX_SEED
    )
    return _named_like(docs, mixed)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of what they decode to."""
    tokenizer = bpe.ByteBPE(spark, public_tokenizers.path(BYTE_VOCABULARY))
    wanted = docs.select("doc_id", "lang", "source", "text")
    return tokenizer.encode(wanted, decoded="decoded").select(
        "doc_id",
        "lang",
        "source",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("minhash", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

# Classifiers and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    *early, (mixture, mix) = STAGES[:-1]

    def prepared() -> DataFrame:
        docs = table(spark, sf_dir, "documents")
        for name, stage in early:
            docs = stored(stage(spark, docs, sf_dir), name)
        return mix(spark, docs, sf_dir)

    return STAGES[-1][1](spark, settled(spark, mixture, prepared), sf_dir)
