from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterism.functions.dates import date_key
from asterism.functions.text import body_length, word_count
from asterism.operators.dml import distinct_keys, materialize, with_defaults
from asterism.operators.history import as_of
from asterism.operators.keys import highest, number_rows
from asterism.operators.partitions import replace_days
from asterism.plans.staging import moment
from asterism.schemas import star_schema


def count_by_key(rows: DataFrame, key: str, name: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").cast("int").alias(name))


def lookup_keys(posts: DataFrame, dim_users: DataFrame) -> DataFrame:
    """``post_id, user_key``; posts of unknown users drop out."""
    return posts.join(dim_users.select("user_id", "user_key"), "user_id").select(
        "post_id", "user_key"
    )


def add_comment_counts(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Comments are counted before the join; posts without any get 0."""
    counts = count_by_key(comments, "post_id", "comment_count")
    return posts.join(counts, "post_id", "left").fillna(0, ["comment_count"])


def fact_measures(
    staging_posts: DataFrame, dim_users: DataFrame, staging_comments: DataFrame
) -> DataFrame:
    """``post_id, user_key, comment_count`` of every post of a known user, on ids alone."""
    posts = staging_posts.select(F.col("id").alias("post_id"), "user_id")
    return add_comment_counts(lookup_keys(posts, dim_users), staging_comments)


def with_texts(measures: DataFrame, staging_posts: DataFrame) -> DataFrame:
    """The measures, with whatever else they carry, and the columns made of the post itself.

    Here the texts move, once and by post id: a user who wrote a third of all
    posts skews only the narrow lookup before.
    """
    posts = staging_posts.select(F.col("id").alias("post_id"), "title", "body", "loaded_at")
    return posts.join(measures, "post_id").select(
        *measures.columns,
        date_key("loaded_at").alias("date_key"),
        "title",
        "body",
        body_length("body").alias("body_length"),
        word_count("body").alias("word_count"),
    )


def fact_source(
    staging_posts: DataFrame, dim_users: DataFrame, staging_comments: DataFrame
) -> DataFrame:
    """One row per post of a known user."""
    return with_texts(fact_measures(staging_posts, dim_users, staging_comments), staging_posts)


def populate_fact_posts(
    staging_posts: DataFrame,
    dim_users: DataFrame,
    staging_comments: DataFrame,
    run_ts: datetime,
    target: DataFrame | None = None,
    id_type: str = "int",
) -> DataFrame:
    """MERGE of the posts into the fact table, decided on ids before any text moves.

    The narrow measures are written once. Posts the target knows keep its key
    and creation time and take everything else from the batch, so of the target
    only these two columns are looked up; the others are numbered. Then the
    texts join once, and target rows without a post are added as they are. Post
    ids are the staging table's primary key, so no post matches twice.
    """
    table, now = star_schema(id_type)["fact_posts"], moment(run_ts)
    serial, key_type = table.serial, table.schema[table.serial].dataType.simpleString()
    measures = materialize(fact_measures(staging_posts, dim_users, staging_comments))
    if target is None:
        new, start = measures, 0
    else:
        new = measures.join(distinct_keys(target, "post_id"), "post_id", "left_anti")
        start = highest(target, serial)
    placed = number_rows(new, serial, ["post_id"], start, key_type)
    if target is not None:
        known = measures.join(target.select("post_id", serial, "created_at"), "post_id")
        placed = placed.withColumn("created_at", now).unionByName(known)
    rows = with_defaults(
        with_texts(placed, staging_posts), table.schema, table.defaults(now)
    )
    if target is None:
        return rows
    kept = target.join(measures.select("post_id"), "post_id", "left_anti")
    return rows.unionByName(kept.select(*rows.columns))


def rerun_days(
    path: str,
    staging_posts: DataFrame,
    dim_users: DataFrame,
    staging_comments: DataFrame,
    days: Sequence[int],
) -> None:
    """Load the facts of single load dates again, into a fact table partitioned by date_key.

    Only posts loaded on these days are read, and only their folders replaced,
    so a re-run may be repeated and other days may be loaded meanwhile. Posts
    are found by post_id; there is no surrogate key to keep.
    """
    wanted = staging_posts.filter(date_key("loaded_at").isin(*days))
    replace_days(materialize(fact_source(wanted, dim_users, staging_comments)), path, days)


def facts_as_of(
    staging_posts: DataFrame, dim_users: DataFrame, staging_comments: DataFrame
) -> DataFrame:
    """``post_id, user_key, comment_count`` with the key of the version valid at loading.

    ``dim_users`` is the dimension with history. Posts of users without a
    version then drop out, as those of unknown users do.
    """
    posts = staging_posts.select(F.col("id").alias("post_id"), "user_id", "loaded_at")
    found = as_of(posts, dim_users, "user_id", "loaded_at", ["user_key"])
    known = found.filter("user_key IS NOT NULL").select("post_id", "user_key")
    return add_comment_counts(known, staging_comments)
