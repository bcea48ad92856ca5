"""

Roles of the test tables: documents, orders are posts; conversations, lineitem
are comments; customer and the users of events and documents are users; events
is an upsert feed. Where a write needs a target and a batch that overlap, the
two are split by an attribute so that together they hold the whole table.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterism.functions.dates import date_key
from asterism.functions.json import (
    json_dumps,
    json_text,
    json_validate,
    optional_text_field,
    optional_value_field,
    parse_fields,
)
from asterism.functions.text import body_length, word_count
from asterism.functions.variant import canonical, variant_text
from asterism.operators.audit import row_counts, same_contents
from asterism.operators.checks import (
    fk_orphans,
    not_null_violations,
    unique_violations,
    varchar_violations,
    violations_in_one_pass,
)
from asterism.operators.counts import apply_changes, count_changes
from asterism.operators.dml import (
    distinct_keys,
    insert_ignore,
    last_per_key,
    materialize,
    merge,
    one_per_key,
    upsert_sequential,
    upsert_set,
    with_defaults,
)
from asterism.operators.history import as_of, load_versions, versions
from asterism.operators.keys import number_rows
from asterism.operators.partitions import read_days, replace_days, write_days
from asterism.operators.profile import (
    DISTINCT_ERROR,
    RANK_ERROR,
    load_profile,
    merged,
    n_distinct,
    quantile,
)
from asterism.plans.dimensions import calendar_attributes, populate_dim_dates, populate_dim_users
from asterism.plans.facts import add_comment_counts, count_by_key, fact_source
from asterism.plans.run import run
from asterism.plans.staging import COMMENTS, POSTS, USERS, load_comments, load_posts, load_users, moment
from asterism.schemas import Column, Table, star_schema
from asterism.session import configure, scratch_path, ship_package
from asterism.sources.arrays import write_arrays
from asterism.sources.calendar import calendar_days, date_series
from asterism.sources.records import read_records, read_typed
from asterism.warehouse import Warehouse

log = logging.getLogger(__name__)

RUN_TS = datetime(2024, 1, 1)
TS = "TIMESTAMP '2024-01-01 00:00:00'"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(oracle: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, by default under its own name, with the SQL it has to match."""

    def add(query: Query) -> Query:
        _QUERIES[name or query.__name__] = query
        _ORACLES[name or query.__name__] = oracle
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- scans and projections -------------------------------------------------


@register("SELECT * FROM customer")
def full_scan(spark, sf):
    return table(spark, sf, "customer")


@register("SELECT o_orderkey AS post_id, o_custkey AS user_id, o_orderpriority AS title FROM orders")
def scan_project_rename(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("post_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("title"),
    )


@register("""
SELECT 'documents' AS source, CAST(COUNT(*) AS INTEGER) AS row_count FROM documents
UNION ALL SELECT 'customer', CAST(COUNT(*) AS INTEGER) FROM customer
UNION ALL SELECT 'conversations', CAST(COUNT(*) AS INTEGER) FROM conversations""")
def row_count_audit(spark, sf):
    return row_counts({n: table(spark, sf, n) for n in ("documents", "customer", "conversations")})


# --- scalar functions ------------------------------------------------------


@register("""
SELECT doc_id AS post_id, CAST(length(text) AS INTEGER) AS body_length,
  CAST(CASE WHEN text = '' THEN NULL ELSE len(string_split(text, ' ')) END AS INTEGER) AS word_count
FROM documents""")
def text_metrics(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("post_id"),
        body_length("text").alias("body_length"),
        word_count("text").alias("word_count"),
    )


@register("""
SELECT o_orderkey AS post_id, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key
FROM orders""")
def date_key_from_ts(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("post_id"), date_key("o_orderdate").alias("date_key")
    )


@register("""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS month, rpad(monthname(d), 9, ' ') AS month_name,
  CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
  rpad(dayname(d), 9, ' ') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders),
  (SELECT max(l_shipdate) FROM lineitem), INTERVAL 1 DAY)) AS d)""")
def date_dimension(spark, sf):
    """Calendar from the first order to the last shipment."""
    ordered = table(spark, sf, "orders").agg(F.min("o_orderdate").alias("d"))
    shipped = table(spark, sf, "lineitem").agg(F.max("l_shipdate").alias("d"))
    bounds = ordered.union(shipped).agg(F.min("d").alias("first"), F.max("d").alias("last"))
    return calendar_attributes(date_series(bounds, "first", "last"))


@register("SELECT event_id, props->>'$.k' AS k, props->>'$.city' AS city FROM events")
def json_text_extract(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", json_text("props", "k").alias("k"), json_text("props", "city").alias("city")
    )


@register("""
SELECT d.doc_id AS id,
  CASE WHEN l.doc_id IS NULL THEN '' WHEN l.toxic = 0 THEN CAST(l.quality AS VARCHAR) END AS phone,
  CASE WHEN l.doc_id IS NULL THEN '{}' WHEN l.toxic = 0 THEN '{"city":"' || d.source || '"}'
    ELSE 'null' END AS address
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def json_default_fill(spark, sf):
    """Unlabelled documents lack the keys, toxic ones hold null."""
    labels = table(spark, sf, "labels")
    joined = table(spark, sf, "documents").join(labels, "doc_id", "left")
    known = F.col("toxic") == 0
    record = F.struct(
        F.col("doc_id").alias("id"),
        F.when(known, F.col("quality").cast("string")).alias("phone"),
        F.when(known, F.struct(F.col("source").alias("city"))).alias("address"),
    )
    text = F.when(F.col("toxic").isNull(), F.to_json(record)).otherwise(json_dumps(record))
    records = joined.select(F.col("doc_id").alias("id"), text.alias("record"))
    fields = F.col("fields")
    return records.withColumn("fields", parse_fields("record", ["phone"], ["address"])).select(
        "id",
        optional_text_field("record", fields, "phone").alias("phone"),
        optional_value_field(fields, "address").alias("address"),
    )


@register("""
SELECT c_custkey AS id, CAST(to_json({'id': c_custkey, 'name': c_name,
  'segment': nullif(c_mktsegment, 'HOUSEHOLD')}) AS VARCHAR) AS raw_data FROM customer""")
def raw_record_json(spark, sf):
    record = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("segment"),
    )
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), json_dumps(record).alias("raw_data")
    )


# --- aggregates and joins --------------------------------------------------


@register("SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_type").distinct()


@register("""
SELECT l_orderkey AS post_id, CAST(COUNT(*) AS INTEGER) AS comment_count
FROM lineitem GROUP BY l_orderkey""", name="count_by_key")
def count_by_post(spark, sf):
    comments = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "post_id")
    return count_by_key(comments, "post_id", "comment_count")


@register("""
SELECT o.o_orderkey AS post_id, u.event_type AS name FROM orders o
JOIN (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) u
ON o.o_custkey = u.user_id""")
def inner_join_drop_orphans(spark, sf):
    """Orders of customers who show up in the event feed."""
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    users = materialize(last_per_key(events, "user_id", "event_id"))
    posts = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("post_id"), F.col("o_custkey").alias("user_id")
    )
    return posts.join(users, "user_id").select("post_id", F.col("event_type").alias("name"))


@register("""
SELECT o.o_orderkey AS post_id, CAST(COALESCE(k.n, 0) AS INTEGER) AS comment_count FROM orders o
LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey) k
ON o.o_orderkey = k.l_orderkey""")
def left_join_count_coalesce(spark, sf):
    posts = table(spark, sf, "orders").select(F.col("o_orderkey").alias("post_id"))
    comments = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("post_id"))
    return add_comment_counts(posts, comments)


# --- writes ----------------------------------------------------------------


@register("""
SELECT user_id AS id, event_id AS seq, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def upsert_last_wins(spark, sf):
    batch = _event_batch(spark, sf)
    return upsert_sequential(None, batch, "id", "seq", schema=batch.schema)


@register("""
SELECT c.c_custkey AS id, e.event_id AS seq,
  CASE WHEN e.user_id IS NULL THEN c.c_mktsegment ELSE e.event_type END AS event_type,
  CASE WHEN e.user_id IS NULL THEN c.c_acctbal ELSE e.value END AS value, e.props
FROM customer c LEFT JOIN
  (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) e
ON c.c_custkey = e.user_id""")
def upsert_last_wins_existing(spark, sf):
    """The event feed over a target that holds every customer."""
    batch = _event_batch(spark, sf)
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("event_type"),
        F.col("c_acctbal").alias("value"),
    )
    return upsert_sequential(with_defaults(customers, batch.schema), batch, "id", "seq")


def _event_batch(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").alias("id"), F.col("event_id").alias("seq"), "event_type", "value", "props"
    )


@register("""
SELECT c_custkey AS user_id,
  CAST(CASE WHEN c_acctbal >= 0 THEN c_custkey + 1
    ELSE (SELECT max(c_custkey) + 1 FROM customer WHERE c_acctbal >= 0)
      + count(*) FILTER (WHERE c_acctbal < 0) OVER (ORDER BY c_custkey) END AS INTEGER) AS user_key,
  CASE WHEN c_acctbal < 5000 THEN lower(nullif(c_mktsegment, 'HOUSEHOLD'))
    ELSE c_mktsegment END AS segment,
  CASE WHEN c_acctbal >= 0 THEN TIMESTAMP '2023-01-01 00:00:00'
    ELSE TIMESTAMP '2024-01-01 00:00:00' END AS valid_from
FROM customer""")
def upsert_set_scd1(spark, sf):
    """Accounts below 5000 over a dimension of the accounts in credit."""
    customers = table(spark, sf, "customer")
    target = customers.filter("c_acctbal >= 0").select(
        F.col("c_custkey").alias("user_id"),
        (F.col("c_custkey") + 1).cast("int").alias("user_key"),
        F.col("c_mktsegment").alias("segment"),
        moment(datetime(2023, 1, 1)).alias("valid_from"),
    )
    batch = customers.filter("c_acctbal < 5000").select(
        F.col("c_custkey").alias("user_id"),
        F.lower(F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD"))).alias("segment"),
    )
    return upsert_set(
        target, batch, "user_id", update=["segment"],
        defaults={"valid_from": moment(RUN_TS)}, serial="user_key",
    )


@register("""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS id,
  CASE WHEN bool_or(ordered) THEN 'EXISTING' ELSE 'NEW' END AS name
FROM (SELECT o_orderdate AS d, TRUE AS ordered FROM orders
  UNION ALL SELECT l_shipdate, FALSE FROM lineitem) GROUP BY d""", name="insert_ignore")
def insert_ignore_days(spark, sf):
    """Shipping days into a calendar that holds the order days."""
    ordered = table(spark, sf, "orders").select(date_key("o_orderdate").alias("id")).distinct()
    target = ordered.withColumn("name", F.lit("EXISTING"))
    batch = table(spark, sf, "lineitem").select(
        date_key("l_shipdate").alias("id"), F.lit("NEW").alias("name")
    )
    return insert_ignore(target, batch, "id")


@register("""
SELECT o_orderkey AS post_id,
  CAST(CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN o_orderkey + 1
    ELSE (SELECT max(o_orderkey) + 1 FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
      + count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '2000-01-01') OVER (ORDER BY o_orderkey)
    END AS INTEGER) AS post_key,
  CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_totalprice * 2 ELSE o_totalprice END AS price,
  CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'kept'
    WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'updated' ELSE 'inserted' END AS action
FROM orders""")
def merge_update_insert(spark, sf):
    """Orders from 1999 on over a fact table loaded to the end of 1999."""
    orders = table(spark, sf, "orders")
    target = orders.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("post_id"),
        (F.col("o_orderkey") + 1).cast("int").alias("post_key"),
        F.col("o_totalprice").alias("price"),
        F.lit("kept").alias("action"),
    )
    batch = orders.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("post_id"), (F.col("o_totalprice") * 2).alias("price")
    )
    return merge(
        target, batch, "post_id", update=["price"], stamp={"action": F.lit("updated")},
        defaults={"action": F.lit("inserted")}, serial="post_key", unique=True,
    )


@register("""
SELECT o_orderkey AS post_id, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS price,
  CASE WHEN o_orderstatus = 'F' THEN 'updated' ELSE 'kept' END AS action FROM orders
UNION ALL SELECT -1 - l_orderkey, l_extendedprice, 'inserted' FROM lineitem""")
def merge_repeated_keys(spark, sf):
    """Over all orders: the finished ones match once, line items repeat keys that match nothing."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("post_id"), "o_totalprice", "o_orderstatus")
    target = orders.select("post_id", F.col("o_totalprice").alias("price"), F.lit("kept").alias("action"))
    finished = orders.filter("o_orderstatus = 'F'").select(
        "post_id", (F.col("o_totalprice") * 2).alias("price")
    )
    lines = table(spark, sf, "lineitem").select(
        (-1 - F.col("l_orderkey")).alias("post_id"), F.col("l_extendedprice").alias("price")
    )
    return merge(
        target, finished.union(lines), "post_id", update=["price"],
        stamp={"action": F.lit("updated")}, defaults={"action": F.lit("inserted")}, unique_target=True,
    )


@register("SELECT o_orderkey AS id, o_orderpriority AS name FROM orders")
def full_refresh(spark, sf):
    """Customers replaced by orders."""
    warehouse = Warehouse(spark, scratch_path(spark, "refresh"))
    customers, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    warehouse.refresh("users", customers.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))
    return warehouse.refresh(
        "users", orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"))
    )


@register(f"""
SELECT CAST(NULL AS BIGINT) AS post_key, o_orderkey AS post_id, o_custkey AS user_key,
  CAST(NULL AS INTEGER) AS date_key, o_orderpriority AS title, CAST(NULL AS VARCHAR) AS body,
  CAST(NULL AS INTEGER) AS body_length, CAST(NULL AS INTEGER) AS word_count,
  CAST(0 AS INTEGER) AS comment_count, {TS} AS created_at, {TS} AS updated_at FROM orders""")
def column_defaults(spark, sf):
    """Orders inserted into the fact table with a list of three columns."""
    fact = star_schema("bigint")["fact_posts"]
    posts = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("post_id"),
        F.col("o_custkey").alias("user_key"),
        F.col("o_orderpriority").alias("title"),
    )
    return with_defaults(posts, fact.schema, fact.defaults(moment(RUN_TS)))


@register("""
SELECT event_id, json_valid(props) AS valid, json_valid(left(props, length(props) - 1)) AS torn FROM events""")
def json_validity(spark, sf):
    """The properties of events, and the same texts without their closing bracket."""
    torn = F.expr("substring(props, 1, length(props) - 1)")
    return table(spark, sf, "events").select(
        "event_id",
        json_validate("props", fail=False).isNotNull().alias("valid"),
        json_validate(torn, fail=False).isNotNull().alias("torn"),
    )


# --- keys and constraints --------------------------------------------------


@register("""
SELECT l_orderkey AS post_id, CAST(row_number() OVER (ORDER BY l_orderkey) AS INTEGER) AS post_key
FROM (SELECT DISTINCT l_orderkey FROM lineitem)""")
def surrogate_key_dense(spark, sf):
    """Dense keys for the orders that have line items, a sparse set of ids."""
    posts = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("post_id")).distinct()
    return number_rows(posts, "post_key", ["post_id"])


@register("""
SELECT l_orderkey, l_linenumber, CAST(COUNT(*) AS INTEGER) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""", name="unique_violations")
def unique_key_violations(spark, sf):
    found = unique_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return found.withColumn("n", F.col("n").cast("int"))


@register("""
SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NULL""", name="not_null_violations")
def null_violations(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    labelled = table(spark, sf, "documents").select("doc_id").join(labels, "doc_id", "left")
    return not_null_violations(labelled, ["quality"])


@register("""
SELECT o_orderkey AS post_id, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders
WHERE o_orderdate < TIMESTAMP '2000-01-01' OR o_orderdate >= TIMESTAMP '2001-01-01'""", name="fk_orphans")
def fk_date_orphans(spark, sf):
    """Orders outside a calendar of the year 2000."""
    calendar = calendar_attributes(calendar_days(spark, date(2000, 1, 1), date(2000, 12, 31)))
    return fk_orphans(date_key_from_ts(spark, sf), "date_key", calendar, "date_key")


@register("""
SELECT o_orderkey AS post_id, o_custkey AS user_id FROM orders
WHERE o_custkey NOT IN (SELECT user_id FROM events)""")
def fk_user_orphans(spark, sf):
    posts = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("post_id"), F.col("o_custkey").alias("user_id")
    )
    users = distinct_keys(table(spark, sf, "events"), "user_id")
    return fk_orphans(posts, "user_id", users, "user_id")


@register("""
SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents WHERE length(rtrim(text, ' ')) > 200""", name="varchar_violations")
def length_violations(spark, sf):
    found = varchar_violations(table(spark, sf, "documents"), {"text": 200})
    return found.select("doc_id", F.length("text").alias("n"))


# --- landed JSON and staging -----------------------------------------------


def _land(df: DataFrame, label: str) -> str:
    """Write a frame as JSON Lines to the scratch folder."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("ignoreNullFields", "false").json(path)
    return path


def _post_records(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.substring_index("source", "src", -1).cast("int").alias("userId"),
        F.col("lang").alias("title"),
        F.col("text").alias("body"),
    )


def _comment_records(spark, sf):
    return table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.col("conv_id").alias("postId"),
        F.col("role").alias("name"),
        F.concat("role", F.lit("@example.net")).alias("email"),
        F.col("text").alias("body"),
    )


@register("""SELECT doc_id AS id, source AS "userId", lang AS title, text AS body FROM documents""")
def src_json_records(spark, sf):
    """Documents written as JSON records and read back with a declared schema."""
    records = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("userId"),
        F.col("lang").alias("title"),
        F.col("text").alias("body"),
    )
    return read_typed(spark, _land(records, "records"), "id bigint, userId string, title string, body string")


@register("""SELECT doc_id AS id, source AS "userId", lang AS title, text AS body FROM documents""")
def src_json_arrays(spark, sf):
    """The same from files that are one JSON array each, read in pieces."""
    path = scratch_path(spark, "arrays")
    write_arrays(
        table(spark, sf, "documents").select(
            F.col("doc_id").alias("id"), F.col("source").alias("userId"),
            F.col("lang").alias("title"), F.col("text").alias("body"),
        ), path,
    )
    return read_typed(spark, path, "id bigint, userId string, title string, body string", "array")


@register(f"""
SELECT CAST(doc_id AS INTEGER) AS id, CAST(substr(source, 4) AS INTEGER) AS user_id, lang AS title,
  text AS body, CAST(to_json({{'id': doc_id, 'userId': CAST(substr(source, 4) AS INTEGER),
    'title': lang, 'body': text}}) AS VARCHAR) AS raw_data, {TS} AS loaded_at
FROM documents""")
def stage_posts(spark, sf):
    return load_posts(read_records(spark, _land(_post_records(spark, sf), "posts"), fields=POSTS.fields), RUN_TS)


@register(f"""
SELECT CAST(conv_id * 1000 + turn AS INTEGER) AS id, CAST(conv_id AS INTEGER) AS post_id, role AS name,
  role || '@example.net' AS email, text AS body,
  CAST(to_json({{'id': conv_id * 1000 + turn, 'postId': conv_id, 'name': role,
    'email': role || '@example.net', 'body': text}}) AS VARCHAR) AS raw_data, {TS} AS loaded_at
FROM conversations""")
def stage_comments(spark, sf):
    landed = _land(_comment_records(spark, sf), "comments")
    return load_comments(read_records(spark, landed, fields=COMMENTS.fields), RUN_TS)


@register(f"""
SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name, lower(c_name) AS username,
  lower(c_name) || '@example.net' AS email,
  CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS VARCHAR) WHEN c_mktsegment <> 'HOUSEHOLD' THEN ''
    END AS phone,
  '' AS website, '{{"city":"' || c_mktsegment || '"}}' AS address,
  CASE WHEN c_nationkey < 12 THEN '{{"name":"' || c_mktsegment || '"}}'
    WHEN c_mktsegment <> 'HOUSEHOLD' THEN '{{}}' ELSE 'null' END AS company,
  '{{"id":' || c_custkey || ',"name":"' || c_name || '","username":"' || lower(c_name)
    || '","email":"' || lower(c_name) || '@example.net"'
    || CASE WHEN c_acctbal >= 0 THEN ',"phone":"' || CAST(c_acctbal AS VARCHAR) || '"'
      WHEN c_mktsegment = 'HOUSEHOLD' THEN ',"phone":null' ELSE '' END
    || ',"address":{{"city":"' || c_mktsegment || '"}}'
    || CASE WHEN c_nationkey < 12 THEN ',"company":{{"name":"' || c_mktsegment || '"}}'
      WHEN c_mktsegment = 'HOUSEHOLD' THEN ',"company":null' ELSE '' END || '}}' AS raw_data,
  {TS} AS loaded_at
FROM customer""")
def stage_users(spark, sf):
    return load_users(_user_records(spark, sf), RUN_TS)


@register("""
SELECT CAST(c_custkey AS INTEGER) AS id, c_mktsegment AS city,
  CASE WHEN c_nationkey < 12 THEN c_mktsegment END AS company_name,
  CASE WHEN c_nationkey < 12 THEN '{"name":"' || c_mktsegment || '"}'
    WHEN c_mktsegment <> 'HOUSEHOLD' THEN '{}' ELSE 'null' END AS company,
  '{"address":{"city":"' || c_mktsegment || '"}'
    || CASE WHEN c_nationkey < 12 THEN ',"company":{"name":"' || c_mktsegment || '"}'
      WHEN c_mktsegment = 'HOUSEHOLD' THEN ',"company":null' ELSE '' END
    || ',"email":"' || lower(c_name) || '@example.net","id":' || c_custkey || ',"name":"' || c_name || '"'
    || CASE WHEN c_acctbal >= 0 THEN ',"phone":"' || CAST(c_acctbal AS VARCHAR) || '"'
      WHEN c_mktsegment = 'HOUSEHOLD' THEN ',"phone":null' ELSE '' END
    || ',"username":"' || lower(c_name) || '"}' AS raw_data
FROM customer""")
def stage_users_variant(spark, sf):
    """Users staged with VARIANT columns, shown by value: keys in order, no blanks."""
    staged = materialize(load_users(_user_records(spark, sf, variant=True), RUN_TS))
    return staged.select(
        "id",
        variant_text(F.col("address"), "city").alias("city"),
        variant_text(F.col("company"), "name").alias("company_name"),
        canonical(F.col("company")).alias("company"),
        canonical(F.col("raw_data")).alias("raw_data"),
    )


def _user_records(spark, sf, variant=False):
    """Phone and company are missing for some users, null for those in HOUSEHOLD."""
    segment = F.col("c_mktsegment")
    record = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.lower("c_name").alias("username"),
        F.concat(F.lower("c_name"), F.lit("@example.net")).alias("email"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).alias("phone"),
        F.struct(segment.alias("city")).alias("address"),
        F.when(F.col("c_nationkey") < 12, F.struct(segment.alias("name"))).alias("company"),
    )
    text = F.when(segment == "HOUSEHOLD", json_dumps(record)).otherwise(F.to_json(record))
    path = scratch_path(spark, "users")
    table(spark, sf, "customer").select(text.alias("value")).write.text(path)
    return read_records(spark, path, fields=USERS.fields, variant=variant)


# --- dimensions and facts --------------------------------------------------


@register(f"""
SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS user_key,
  CAST(c_custkey AS INTEGER) AS user_id, lower(c_name) AS username, c_name AS name,
  lower(c_name) || '@example.net' AS email,
  CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS VARCHAR) WHEN c_mktsegment <> 'HOUSEHOLD' THEN ''
    END AS phone,
  '' AS website, c_mktsegment AS city, CASE WHEN c_nationkey < 12 THEN c_mktsegment END AS company_name,
  {TS} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current, {TS} AS updated_at
FROM customer""")
def dim_users(spark, sf):
    """Customers landed as JSON, staged, and loaded into the user dimension."""
    staged = materialize(load_users(_user_records(spark, sf), RUN_TS))
    return populate_dim_users(staged, RUN_TS, unique=True)


@register("""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS month,
  CASE WHEN d IN (SELECT o_orderdate FROM orders) THEN 'kept' ELSE rpad(monthname(d), 9, ' ') END AS month_name,
  CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
  rpad(dayname(d), 9, ' ') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders),
  (SELECT max(l_shipdate) FROM lineitem), INTERVAL 1 DAY)) AS d)""")
def dim_dates(spark, sf):
    """Every day up to the last shipment, into a calendar that holds the order days."""
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    calendar = calendar_attributes(orders.distinct()).withColumn("month_name", F.lit("kept"))
    shipped = table(spark, sf, "lineitem").agg(F.max("l_shipdate").alias("last"))
    bounds = orders.agg(F.min("d").cast("timestamp_ntz").alias("first")).crossJoin(shipped)
    return populate_dim_dates(date_series(bounds, "first", "last"), calendar)


@register("""
SELECT CAST(d.doc_id AS BIGINT) AS post_id, u.user_key, 20240101 AS date_key, d.lang AS title,
  d.text AS body, CAST(length(d.text) AS INTEGER) AS body_length,
  CAST(CASE WHEN d.text = '' THEN NULL ELSE len(string_split(d.text, ' ')) END AS INTEGER) AS word_count,
  CAST(COALESCE(k.n, 0) AS INTEGER) AS comment_count
FROM documents d
JOIN (SELECT source, CAST(row_number() OVER (ORDER BY source) AS INTEGER) AS user_key
      FROM (SELECT DISTINCT source FROM documents)) u ON d.source = u.source
LEFT JOIN (SELECT conv_id, COUNT(*) AS n FROM conversations GROUP BY conv_id) k
ON d.doc_id = k.conv_id""")
def fact_posts(spark, sf):
    """Flagship: posts with their author's key, text metrics and comment counts."""
    documents = table(spark, sf, "documents")
    authors = documents.select(F.col("source").alias("user_id")).distinct()
    comments = table(spark, sf, "conversations").select(F.col("conv_id").alias("post_id"))
    posts = documents.select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("user_id"),
        F.col("lang").alias("title"),
        F.col("text").alias("body"),
        moment(RUN_TS).alias("loaded_at"),
    )
    return fact_source(posts, number_rows(authors, "user_key", ["user_id"]), comments)


@register("""
SELECT o.o_orderkey AS post_id, c.user_key, CAST(strftime(o.o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
  CAST(COALESCE(k.n, 0) AS INTEGER) AS comment_count
FROM orders o
JOIN (SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS user_key
      FROM customer) c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey) k
ON o.o_orderkey = k.l_orderkey""")
def fact_orders(spark, sf):
    """The same fact at volume, without texts: the rows are narrow enough to join directly."""
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    users = number_rows(customers, "user_key", ["user_id"])
    posts = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("post_id"),
        F.col("o_custkey").alias("user_id"),
        date_key("o_orderdate").alias("date_key"),
    )
    comments = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("post_id"))
    keyed = posts.join(users, "user_id").select("post_id", "user_key", "date_key")
    return add_comment_counts(keyed, comments)


@register(f"""
SELECT CAST(row_number() OVER (ORDER BY d.doc_id) AS INTEGER) AS post_key,
  CAST(d.doc_id AS INTEGER) AS post_id, u.user_key, 20240101 AS date_key, d.lang AS title, d.text AS body,
  CAST(length(d.text) AS INTEGER) AS body_length,
  CAST(CASE WHEN d.text = '' THEN NULL ELSE len(string_split(d.text, ' ')) END AS INTEGER) AS word_count,
  CAST(COALESCE(k.n, 0) AS INTEGER) AS comment_count, {TS} AS created_at, {TS} AS updated_at
FROM documents d
JOIN (SELECT source, CAST(row_number() OVER (ORDER BY CAST(substr(source, 4) AS INTEGER)) AS INTEGER)
        AS user_key FROM (SELECT DISTINCT source FROM documents)) u ON d.source = u.source
LEFT JOIN (SELECT conv_id, COUNT(*) AS n FROM conversations GROUP BY conv_id) k
ON d.doc_id = k.conv_id""")
def star_schema_run(spark, sf):
    """Land posts, users and comments as JSON, run the whole load, read the fact."""
    landing = _land_all(spark, _post_records(spark, sf), _comment_records(spark, sf))
    root = scratch_path(spark, "warehouse")
    run(spark, landing, root, RUN_TS)
    return Warehouse(spark, root).read("fact_posts")


def _land_all(spark, posts: DataFrame, comments: DataFrame) -> str:
    """The records of one day, with the users who wrote the posts."""
    name = F.col("userId").cast("string")
    users = one_per_key(posts.select("userId"), "userId").select(
        F.col("userId").alias("id"),
        name.alias("name"),
        name.alias("username"),
        F.concat(name, F.lit("@example.net")).alias("email"),
    )
    landing = scratch_path(spark, "landing")
    for collection, records in (("posts", posts), ("users", users), ("comments", comments)):
        records.write.option("ignoreNullFields", "false").json(f"{landing}/{collection}")
    return landing


@register(f"""
WITH p AS (SELECT *, CAST(substr(source, 4) AS INTEGER) AS user_id, lang IN ('en', 'fr') AS early FROM documents),
u AS (SELECT user_id, CAST(row_number() OVER (ORDER BY NOT bool_or(early), user_id) AS INTEGER) AS user_key
  FROM p GROUP BY user_id)
SELECT CAST(row_number() OVER (ORDER BY NOT early, doc_id) AS INTEGER) AS post_key,
  CAST(doc_id AS INTEGER) AS post_id, user_key, CASE WHEN lang = 'en' THEN 20240101 ELSE 20240502 END AS date_key,
  lang AS title, text AS body, CAST(length(text) AS INTEGER) AS body_length,
  CAST(CASE WHEN text = '' THEN NULL ELSE len(string_split(text, ' ')) END AS INTEGER) AS word_count,
  CAST(COALESCE(k.n, 0) AS INTEGER) AS comment_count,
  CASE WHEN early THEN {TS} ELSE TIMESTAMP '2024-05-02 00:00:00' END AS created_at,
  TIMESTAMP '2024-05-02 00:00:00' AS updated_at
FROM p JOIN u USING (user_id)
LEFT JOIN (SELECT conv_id, COUNT(*) AS n FROM conversations GROUP BY conv_id) k ON doc_id = k.conv_id""")
def star_schema_two_days(spark, sf):
    """A second load over the first: keys and creation times are kept, the rest is updated.

    English and French documents land first, all but the English ones again on
    the second day; the comments of users first, then all. Staged posts stay
    in buckets, so that their texts are shuffled once a day, when they arrive.
    """
    root, buckets = scratch_path(spark, "warehouse"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    posts, comments = _post_records(spark, sf), _comment_records(spark, sf)
    for day, languages, roles in (
        (RUN_TS, ("en", "fr"), F.col("name") == "user"),
        (datetime(2024, 5, 2), ("fr", "de", "es"), F.lit(True)),
    ):
        landing = _land_all(spark, posts.filter(F.col("title").isin(*languages)), comments.filter(roles))
        run(spark, landing, root, day, refresh=day == RUN_TS, buckets=buckets)
    return Warehouse(spark, root).read("fact_posts")


# --- history, re-runs, maintained counts -----------------------------------


@register("""
WITH c AS (SELECT user_id, ts, event_type, lag(event_type) OVER w AS before, row_number() OVER w AS n
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
v AS (SELECT user_id, ts, event_type FROM c WHERE n = 1 OR event_type <> before)
SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL AS is_current FROM v""")
def user_history(spark, sf):
    """The event feed as versions of each user's latest kind of event."""
    return versions(table(spark, sf, "events"), "user_id", "ts", ["event_type"], ["event_id"])


@register("""
WITH c AS (SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS n FROM events
  WHERE event_type <> 'purchase' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
v AS (SELECT user_id, ts, event_type FROM c WHERE n = 1 OR event_type <> before)
SELECT p.event_id, p.user_id, p.ts, p.value, v.event_type AS state, v.ts AS valid_from
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def purchases_as_of(spark, sf):
    """Each purchase with the state its user was in then."""
    events = table(spark, sf, "events")
    others = events.filter("event_type <> 'purchase'").withColumnRenamed("event_type", "state")
    history = versions(others, "user_id", "ts", ["state"], ["event_id"])
    bought = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    history = history.withColumn("since", F.col("valid_from"))
    found = as_of(bought, history, "user_id", "ts", ["state", "since"])
    return found.withColumnRenamed("since", "valid_from")


@register("""
WITH a AS (SELECT c_custkey AS user_id, c_mktsegment AS old,
  CASE WHEN c_acctbal < 2000 THEN lower(c_mktsegment) ELSE c_mktsegment END AS new,
  c_nationkey < 20 AS first, c_nationkey >= 5 AS second FROM customer),
v AS (SELECT user_id, old AS segment, 1 AS day, second AND new <> old AS closed FROM a WHERE first
  UNION ALL SELECT user_id, new, 2, FALSE FROM a WHERE second AND (NOT first OR new <> old))
SELECT CAST(row_number() OVER (ORDER BY day, user_id) AS INTEGER) AS user_key, user_id, segment,
  CASE day WHEN 1 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-02' END AS valid_from,
  CASE WHEN closed THEN TIMESTAMP '2024-01-02' END AS valid_to, NOT closed AS is_current FROM v""")
def dim_history_two_loads(spark, sf):
    """A dimension with history after two loads: some keys change, some are new, some are missing."""
    customers = table(spark, sf, "customer").withColumnRenamed("c_custkey", "user_id")
    schema = T.StructType.fromDDL(
        "user_key int, user_id bigint, segment string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
    )
    first = customers.filter("c_nationkey < 20").select("user_id", F.col("c_mktsegment").alias("segment"))
    segment = F.when(F.col("c_acctbal") < 2000, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    second = customers.filter("c_nationkey >= 5").select("user_id", segment.alias("segment"))
    target = None
    for day, batch in ((RUN_TS, first), (datetime(2024, 1, 2), second)):
        target = load_versions(
            target, batch, "user_id", ["segment"], moment(day), schema=schema, serial="user_key"
        )
        target = materialize(target)
    return target


@register("""
WITH d AS (SELECT event_id, user_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, value FROM events),
r AS (SELECT max(date_key) AS last FROM d)
SELECT event_id, user_id, date_key, CASE WHEN date_key = last THEN value * 2 ELSE value END AS value,
  date_key = last AS rerun FROM d, r""")
def rerun_one_day(spark, sf):
    """Events by day; the last day is loaded again, twice, and nothing else changes."""
    events = table(spark, sf, "events").select(
        "event_id", "user_id", "value", F.lit(False).alias("rerun"), date_key("ts").alias("date_key")
    )
    path = scratch_path(spark, "days")
    write_days(events, path)
    last = events.agg(F.max("date_key")).first()[0]
    again = events.filter(F.col("date_key") == last).withColumns(
        {"value": F.col("value") * 2, "rerun": F.lit(True)}
    )
    for _ in range(2):
        replace_days(again, path, [last])
    return read_days(spark, path)


@register("""
WITH moved AS (SELECT l_orderkey AS post_id, CASE WHEN l_returnflag = 'R' THEN l_orderkey + 1 ELSE l_orderkey END AS now,
  l_shipdate < TIMESTAMP '1999-01-01' AS known FROM lineitem)
SELECT now AS post_id, CAST(count(*) AS INTEGER) AS comment_count FROM moved GROUP BY now""")
def comment_counts_maintained(spark, sf):
    """Lines shipped before 1999 are known; then all returned ones move to the next order, and the rest is new."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("post_id"), "l_returnflag", "l_shipdate", "l_partkey", "l_suppkey", "l_linenumber",
        "l_extendedprice",
    )
    lines = number_rows(lines, "id", type_="bigint")
    early = F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    known = lines.filter(early).select("id", "post_id")
    counts = count_by_key(known, "post_id", "comment_count")
    moved = F.when(F.col("l_returnflag") == "R", F.col("post_id") + 1).otherwise(F.col("post_id"))
    batch = lines.filter(~early | (F.col("l_returnflag") == "R")).select("id", moved.alias("post_id"))
    changes = count_changes(known, batch, "id", "post_id")
    return apply_changes(counts, [changes], "post_id", "comment_count")


# --- checks and profiles of whole tables -----------------------------------


@register("""
WITH o AS (SELECT *, o_orderkey // 2 AS half FROM orders)
SELECT rule, key, n FROM (
  SELECT 'posts.o_orderkey has to be unique' AS rule, CAST(o_orderkey AS VARCHAR) AS key, count(*) AS n
    FROM o GROUP BY o_orderkey HAVING count(*) > 1
  UNION ALL SELECT 'posts.half has to be unique', CAST(half AS VARCHAR), count(*) FROM o GROUP BY half HAVING count(*) > 1
  UNION ALL SELECT 'posts.status has to be not null', CAST(o_orderkey AS VARCHAR), count(*) FROM o
    WHERE o_orderstatus = 'P' GROUP BY o_orderkey
  UNION ALL SELECT 'posts.o_orderpriority is varchar(8)', CAST(o_orderkey AS VARCHAR), count(*) FROM o
    WHERE length(rtrim(o_orderpriority, ' ')) > 8 GROUP BY o_orderkey
  UNION ALL SELECT 'posts.o_custkey has to be in users', CAST(o_custkey AS VARCHAR), count(*) FROM o
    WHERE o_custkey NOT IN (SELECT user_id FROM events) GROUP BY o_custkey)""")
def rules_in_one_pass(spark, sf):
    """Five rules that orders partly break, from one scan of them."""
    bigint, text = T.LongType(), T.StringType()
    posts = Table(
        "posts",
        (
            Column("o_orderkey", bigint), Column("half", bigint), Column("status", text, not_null=True),
            Column("o_orderpriority", text, length=8), Column("o_custkey", bigint),
        ),
        primary_key="o_orderkey", unique=("half",), foreign_keys={"o_custkey": ("users", "user_id")},
    )
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.floor(F.col("o_orderkey") / 2).alias("half"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
    )
    return violations_in_one_pass(rows, posts, {"users": table(spark, sf, "events").select("user_id")})


@register("""
SELECT date_key, count(*) AS n_rows, count(*) - count(nullif(event_type, 'error')) AS n_nulls,
  count(DISTINCT user_id) AS n_users, TRUE AS users_close, TRUE AS median_close
FROM (SELECT *, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key FROM events) GROUP BY date_key
UNION ALL SELECT NULL, count(*), count(*) - count(nullif(event_type, 'error')), count(DISTINCT user_id), TRUE, TRUE
FROM events""")
def load_profiles(spark, sf):
    """Profiles of each day and, merged from them, of all days, beside exact counts."""
    events = table(spark, sf, "events").select(
        date_key("ts").alias("date_key"), "user_id", "value", F.nullif("event_type", F.lit("error")).alias("kind")
    )
    days = materialize(load_profile(events, "date_key", ["user_id", "value", "kind"]))
    whole = merged(days).select(F.lit(None).cast("int").alias("date_key"), *[c for c in days.columns if c != "date_key"])
    found = days.unionByName(whole)
    users = found.filter("column = 'user_id'").select("date_key", "n_rows", n_distinct().alias("users"))
    nulls = found.filter("column = 'kind'").select(F.col("date_key").alias("d"), "n_nulls")
    medians = found.filter("column = 'value'").select(F.col("date_key").alias("m"), quantile(0.5).alias("median"))
    both = events.withColumn("date_key", F.explode(F.array("date_key", F.lit(None).cast("int"))))
    medians = both.join(F.broadcast(medians), F.col("date_key").eqNullSafe(F.col("m")))
    # Share of the rows below the estimate and up to it: the median's rank lies between.
    below, up_to = F.avg((F.col("value") < F.col("median")).cast("int")), F.avg((F.col("value") <= F.col("median")).cast("int"))
    exact = medians.groupBy("date_key").agg(
        F.count_distinct("user_id").alias("n_users"),
        ((below - 0.5 <= RANK_ERROR) & (0.5 - up_to <= RANK_ERROR)).alias("median_close"),
    )
    exact = exact.withColumnRenamed("date_key", "e")
    close = F.abs(F.col("users") - F.col("n_users")) <= F.ceil(F.col("n_users") * DISTINCT_ERROR)
    joined = users.join(nulls, F.col("date_key").eqNullSafe(F.col("d"))).join(exact, F.col("date_key").eqNullSafe(F.col("e")))
    return joined.select("date_key", "n_rows", "n_nulls", "n_users", close.alias("users_close"), "median_close")


@register("""
SELECT * FROM (VALUES ('reordered', TRUE), ('one row changed', FALSE), ('one row repeated', FALSE),
  ('two values exchanged', FALSE)) AS x(what, same), (SELECT count(*) AS n_rows FROM lineitem)""")
def unchanged_refresh(spark, sf):
    """Whether line items count as unchanged after a few rewrites."""
    lines = table(spark, sf, "lineitem")
    first = lines.agg(F.min(F.struct(*lines.columns)).alias("x")).select("x.*")
    values = first.first().asDict()
    one = reduce(and_, [F.col(f.name) == F.lit(values[f.name]).cast(f.dataType) for f in lines.schema.fields])
    cases = {
        "reordered": lines.repartition(7, "l_partkey").select(*reversed(lines.columns)),
        "one row changed": lines.withColumn("l_tax", F.when(one, F.col("l_tax") + 1).otherwise(F.col("l_tax"))),
        "one row repeated": lines.unionByName(first),
        "two values exchanged": lines.withColumns(
            {"l_discount": F.col("l_tax"), "l_tax": F.col("l_discount")}
        ),
    }
    rows = [(what, same_contents(lines, case)) for what, case in cases.items()]
    found = spark.createDataFrame(rows, "what string, same boolean")
    return found.crossJoin(lines.agg(F.count("*").alias("n_rows")))


# --- driver contract -------------------------------------------------------


def _configured(query: Query) -> Query:
    return lambda spark, sf_dir: query(configure(spark), sf_dir)


def _shipped(query: Query) -> Query:
    return lambda spark, sf_dir: query(ship_package(spark), sf_dir)


def entry(spark: SparkSession) -> DataFrame:
    return fact_posts(configure(spark), "/root/testdata/sf0.001")


def _added() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the training-data operators, where those are installed."""
    queries: dict[str, Query] = {}
    oracles: dict[str, str] = {}
    try:
        from asterism.llm.queries import ORACLES, QUERIES

        queries |= QUERIES
        oracles |= ORACLES
        import corpus_pipeline

        queries["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    except ImportError as error:  # the folder, or a library that only it needs, is not there
        log.warning("without the training-data queries, or some of them: %s", error)
    return queries, oracles


def queries() -> dict[str, Query]:
    added = {name: _shipped(query) for name, query in _added()[0].items()}
    return {name: _configured(query) for name, query in _QUERIES.items()} | added


def oracle_sql() -> dict[str, str]:
    return {name: sql.strip() for name, sql in _ORACLES.items()} | _added()[1]
