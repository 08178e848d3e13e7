"""Scalar extraction: hours, salaries, timestamps, fingerprints and JSON values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweft.catalog.inputs import table
from jobweft.functions import json_values as jv
from jobweft.functions.hours import hours_error, hours_phrase, parse_hours
from jobweft.functions.money import amount, amount_is_bad, salary_period
from jobweft.functions.text import (
    collapse_spaces,
    content_fingerprint,
    currency_code,
    first_non_empty,
    first_non_zero,
    normalized_content,
    optional_text,
)
from jobweft.functions.times import timestamp_from_number, timestamp_from_text
from jobweft.settings import load_hour_limits
from jobweft.sources.bronze import record_count, with_landing_columns


def hours_extract_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours stated in a sentence per line item, and whether they are accepted."""
    q = F.col("l_quantity").cast("int")
    sentence = (
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("Work "), q, F.lit("-"), q + 10, F.lit(" hours per week, 5 h")))
        .when(F.col("l_returnflag") == "A", F.concat(F.lit("Úvazek "), q * 4, F.lit(" h týdně")))
        .when(F.col("l_linestatus") == "O", F.concat(F.lit("od "), q, F.lit(" až "), q * 17, F.lit(" hodin / month")))
        .otherwise(F.concat(F.lit("From "), q * 2, F.lit(" to "), q, F.lit("hours a day or more")))
    )
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_tax"
    )
    read = items.select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_tax") > 0, sentence).otherwise("none").alias("s")
    ).withColumn("h", parse_hours(hours_phrase(F.col("s"))))
    low, high, period = (F.col(f"h.{c}") for c in ("hours_min", "hours_max", "hours_period"))
    return read.select(
        "l_orderkey", "l_linenumber",
        low.cast("double").alias("hours_min"), high.cast("double").alias("hours_max"),
        period.alias("hours_period"),
        hours_error(low, high, period, load_hour_limits()).alias("error"),
    )


HOURS_EXTRACT_VALIDATE = """
WITH q AS (
  SELECT l_orderkey, l_linenumber, l_returnflag AS f, l_linestatus AS s, l_tax,
         CAST(l_quantity AS INTEGER) AS n FROM lineitem
), h AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_tax <= 0 THEN NULL WHEN f = 'R' THEN n WHEN f = 'A' THEN n * 4
         WHEN s = 'O' THEN n ELSE n * 2 END AS lo,
    CASE WHEN l_tax <= 0 THEN NULL WHEN f = 'R' THEN n + 10 WHEN f = 'A' THEN n * 4
         WHEN s = 'O' THEN n * 17 ELSE n END AS hi,
    CASE WHEN l_tax <= 0 THEN NULL WHEN f IN ('R', 'A') THEN 'week' WHEN s = 'O' THEN 'month' ELSE 'day' END AS p
  FROM q
), c AS (SELECT *, CASE p WHEN 'week' THEN 168 WHEN 'month' THEN 744 WHEN 'day' THEN 24 END AS cap FROM h)
SELECT l_orderkey, l_linenumber, CAST(lo AS DOUBLE) AS hours_min, CAST(hi AS DOUBLE) AS hours_max,
  p AS hours_period,
  CASE WHEN hi < lo THEN 'Hours maximum is below minimum: ' || hi || ' < ' || lo
       WHEN lo > cap THEN 'Hours minimum exceeds the configured ' || p || ' limit: ' || lo || ' > ' || cap
       WHEN hi > cap THEN 'Hours maximum exceeds the configured ' || p || ' limit: ' || hi || ' > ' || cap
  END AS error
FROM c
"""


def salary_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts, currency and pay period read from text made of order columns."""
    orders = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    low = (
        F.when(F.col("o_orderstatus") == "F", "negotiable")
        .when(F.col("o_orderstatus") == "P", F.lit(""))
        .otherwise(F.concat(F.lit(" "), cents.cast("string"), F.lit("e-2 ")))
    )
    period = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "per-HOUR-salary")
        .when(F.col("o_orderpriority") == "2-HIGH", "Annual bonus")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "holiday pay monthly")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "project based")
        .otherwise("n/a")
    )
    currency = F.when(F.col("o_custkey") < 500, F.lit(" usd ")).otherwise(F.lit("  "))
    read = orders.select("o_orderkey", low.alias("low"), period.alias("period"), currency.alias("currency"))
    return read.select(
        "o_orderkey",
        F.when(F.col("low") != "", amount(F.col("low"))).cast("decimal(12,2)").cast("double").alias("salary_min"),
        amount_is_bad(F.col("low")).alias("is_bad"),
        salary_period(F.col("period")).alias("salary_period"),
        currency_code(F.col("currency")).alias("salary_currency"),
    )


SALARY_NORMALISE = """
SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'O' THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS salary_min,
  o_orderstatus = 'F' AS is_bad,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'hour' WHEN '2-HIGH' THEN 'year' WHEN '3-MEDIUM' THEN 'day'
    WHEN '4-NOT SPECIFIED' THEN 'project' END AS salary_period,
  CASE WHEN o_custkey < 500 THEN 'USD' END AS salary_currency
FROM orders
"""


def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event time written in one of five forms and read back."""
    events = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == "click", F.date_format(ts, "yyyyMMdd"))
        .when(kind == "error", F.date_format(ts, "yyyy-MM-dd HH:mm:ss,SSS'+02:00'"))
        .when(kind == "signup", F.date_format(ts, "dd.MM.yyyy HH:mm"))
    )
    number = F.when(F.col("value") > 20, F.unix_millis(ts)).otherwise(F.unix_seconds(ts))
    stamp = F.when(kind == "purchase", timestamp_from_number(number)).otherwise(
        timestamp_from_text(F.col("_text"))
    )
    return events.withColumn("_text", text).select("event_id", F.unix_micros(stamp).alias("micros"))


PARSE_TIMESTAMPS = """
SELECT event_id, CAST(CASE event_type
  WHEN 'view' THEN epoch_us(ts)
  WHEN 'click' THEN epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP))
  WHEN 'error' THEN (epoch_us(ts) // 1000) * 1000 - 7200000000
  WHEN 'purchase' THEN CASE WHEN value > 20 THEN (epoch_us(ts) // 1000) * 1000
    ELSE (epoch_us(ts) // 1000000) * 1000000 END
END AS BIGINT) AS micros FROM events
"""


def text_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", content_fingerprint(F.col("text")).alias("content_fingerprint"))


TEXT_FINGERPRINT = """
SELECT doc_id, sha256(replace(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 'ß', 'ss')) AS content_fingerprint
FROM documents
"""


def html_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return pages.select(
        "page_id",
        F.length(normalized_content(F.col("html"))).alias("text_length"),
        content_fingerprint(F.col("html")).alias("content_fingerprint"),
    )


HTML_FINGERPRINT = """
WITH parts AS (
  SELECT page_id, regexp_extract_all(html,
    '(?is)<script[^>]*>.*?</script\\s*>|<style[^>]*>.*?</style\\s*>|<!--.*?-->|<![^>]*>|</?[a-z][^>]*>|[^<]+|<') AS p
  FROM pages
), texts AS (
  SELECT page_id, array_to_string(list_transform(p, lambda t: CASE
    WHEN regexp_matches(t, '(?i)^<(script|style)') THEN
      regexp_replace(t, '(?is)^<[^>]*>|</(script|style)\\s*>$', '', 'g')
    WHEN t LIKE '<_%' THEN NULL
    ELSE replace(replace(replace(replace(t, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') END), ' ') AS t
  FROM parts
), folded AS (
  SELECT page_id, replace(lower(trim(regexp_replace(t, '\\s+', ' ', 'g'))), 'ß', 'ss') AS t FROM texts
)
SELECT page_id, CAST(length(t) AS INTEGER) AS text_length, sha256(t) AS content_fingerprint FROM folded
"""


def bronze_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash and size of every page as it would land in bronze."""
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("source_key"), F.col("html").alias("payload")
    )
    landed = with_landing_columns(pages, "lever")
    fresh = (F.length("run_id") == 32) & (F.col("ingest_date") == F.date_format(F.current_timestamp(), "yyyy-MM-dd"))
    return landed.select(
        "source_key", "source_id", "payload_sha256", "payload_size_bytes", "record_count",
        fresh.alias("is_stamped"),
    )


BRONZE_MANIFEST = """
SELECT CAST(page_id AS VARCHAR) AS source_key, CAST(page_id AS VARCHAR) AS source_id,
  sha256(html) AS payload_sha256, CAST(strlen(html) AS BIGINT) AS payload_size_bytes,
  CAST(NULL AS INTEGER) AS record_count, TRUE AS is_stamped
FROM pages
"""


def payload_record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job counts of payloads in several shapes, one per event."""
    props = F.col("props")
    payload = (
        F.when(F.col("event_type") == "view", F.concat(F.lit("["), props, F.lit(","), props, F.lit("]")))
        .when(F.col("event_type") == "click", F.concat(F.lit('{"data":[],"jobs":['), props, F.lit("]}")))
        .when(F.col("event_type") == "error", F.concat(F.lit('{"data":{},"postings":['), props, F.lit(",1,2]}")))
        .when(F.col("event_type") == "signup", F.concat(F.lit('{"jobs":'), props, F.lit("}")))
        .otherwise(F.concat(F.lit('{"jobs":['), props))
    )
    events = table(spark, sf_dir, "events").select("event_id", payload.alias("payload"))
    return events.select(
        "event_id",
        record_count(F.col("payload"), bare_list=True, members=("data", "postings", "jobs")).alias("any_list"),
        record_count(F.col("payload")).alias("jobs_list"),
    )


PAYLOAD_RECORD_COUNTS = """
SELECT event_id,
  CAST(CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 0 WHEN 'error' THEN 3 END AS INTEGER) AS any_list,
  CAST(CASE event_type WHEN 'click' THEN 1 END AS INTEGER) AS jobs_list
FROM events
"""


def json_props_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members and leaf text of the event properties, with a nested copy."""
    nested = F.concat(
        F.lit('{"k":'), F.get_json_object("props", "$.k"), F.lit(',"list":["a \\"b\\"",{"z":true,"a":null},'),
        F.col("user_id").cast("string"), F.lit('],"none":null,"word":"'), F.col("event_type"), F.lit('"}'),
    )
    events = table(spark, sf_dir, "events").withColumn("doc", nested)
    read = jv.with_members(events, "doc", "k", "list", "none", "word", "absent")
    k, items, none, word, absent = (jv.Member(n) for n in ("k", "list", "none", "word", "absent"))
    return read.select(
        "event_id", k.text.alias("k_text"), items.text.alias("list_text"), none.text.alias("none_text"),
        word.text.alias("word_text"), absent.text.alias("absent_text"),
        k.on.alias("k_on"), items.on.alias("list_on"), none.on.alias("none_on"), word.on.alias("word_on"),
    )


JSON_PROPS_FLATTEN = """
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
  'a "b" True  ' || user_id AS list_text, '' AS none_text, event_type AS word_text, '' AS absent_text,
  CAST(json_extract_string(props, '$.k') AS INTEGER) <> 0 AS k_on, TRUE AS list_on, FALSE AS none_on, TRUE AS word_on
FROM events
"""


def metadata_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named metadata entries of every conversation turn, scalar or list."""
    entries = F.to_json(
        F.array(
            F.struct(F.lit("Location Type:").alias("name"), F.col("role").alias("value")),
            F.struct(F.concat("role", F.lit(" TYPE")).alias("name"), F.lit("x").alias("value")),
        )
    )
    listed = F.concat(
        F.lit('[{"name":"location type","value":["'), F.col("role"), F.lit('","'), F.col("turn").cast("string"),
        F.lit('"]},7,'), F.substr(entries, F.lit(2)),
    )
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.from_json(listed, "array<variant>").alias("entries")
    )
    return turns.select(
        "conv_id", "turn",
        jv.metadata_text(F.col("entries"), "location type").alias("location_type"),
        jv.metadata_text(F.col("entries"), "User type").alias("user_type"),
    )


METADATA_LOOKUP = """
SELECT conv_id, turn, role || ' ' || turn || ' ' || role AS location_type,
  CASE WHEN role = 'user' THEN 'x' ELSE '' END AS user_type
FROM conversations
"""


def optional_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trimmed or missing text, and the first value that is not empty."""
    items = table(spark, sf_dir, "lineitem")
    padded = F.concat(F.lit(" \t"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).otherwise(""), F.lit("\n "))
    return items.select(
        "l_orderkey", "l_linenumber",
        optional_text(padded).alias("flag"),
        first_non_empty(
            F.when(F.col("l_returnflag") == "A", F.lit("")).otherwise(F.nullif("l_returnflag", F.lit("R"))),
            F.col("l_linestatus"),
        ).alias("fallback"),
        first_non_zero(F.col("l_tax"), F.col("l_discount"), F.lit(9.0)).alias("rate"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
    )


OPTIONAL_VALUES = """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag,
  CASE WHEN l_returnflag = 'N' THEN 'N' ELSE l_linestatus END AS fallback,
  CASE WHEN l_tax <> 0 THEN l_tax WHEN l_discount <> 0 THEN l_discount ELSE 9.0 END AS rate,
  strftime(l_shipdate, '%Y-%m-%d') AS day
FROM lineitem
"""


def collapsed_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", collapse_spaces(F.col("text")).alias("text"))


COLLAPSED_SPACES = """
SELECT conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM conversations
"""


QUERIES = {
    "hours_extract_validate": (hours_extract_validate, HOURS_EXTRACT_VALIDATE),
    "salary_normalise": (salary_normalise, SALARY_NORMALISE),
    "parse_timestamps": (parse_timestamps, PARSE_TIMESTAMPS),
    "text_fingerprint": (text_fingerprint, TEXT_FINGERPRINT),
    "html_fingerprint": (html_fingerprint, HTML_FINGERPRINT),
    "bronze_manifest": (bronze_manifest, BRONZE_MANIFEST),
    "payload_record_counts": (payload_record_counts, PAYLOAD_RECORD_COUNTS),
    "json_props_flatten": (json_props_flatten, JSON_PROPS_FLATTEN),
    "metadata_lookup": (metadata_lookup, METADATA_LOOKUP),
    "optional_values": (optional_values, OPTIONAL_VALUES),
    "collapsed_spaces": (collapsed_spaces, COLLAPSED_SPACES),
}
