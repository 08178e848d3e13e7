"""Reports on star-shaped data, and the quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweft.catalog.inputs import TERMS, hits_cte, table
from jobweft.functions.text import slug
from jobweft.operators.dictionary import key_tokens
from jobweft.plans.quality import canonical_issues, count_mismatches, run_counts
from jobweft.plans.reports import (
    count_by_bridge,
    count_by_optional,
    count_by_required,
    posting_detail,
)
from jobweft.plans.seeds import missing_seeds


def report_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per term found in their text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.withColumn("_keys", key_tokens("text", [TERMS])).select(
        F.explode(TERMS.find_all("text", "_keys")).alias("term")
    )
    return (
        found.groupBy("term")
        .agg(F.count("*").alias("active_postings"))
        .orderBy(F.desc("active_postings"), "term")
    )


REPORT_TOP_TERMS = f"""
WITH texts AS (SELECT doc_id AS id, text AS body FROM documents),
{hits_cte("hits", "texts", TERMS)}
SELECT name AS term, COUNT(DISTINCT id) AS active_postings
FROM hits GROUP BY name ORDER BY active_postings DESC, term
"""


def report_count_left_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open line items per supplier in credit; all others share one bucket."""
    items = table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == "O")
    suppliers = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 5000)
    return count_by_optional(
        items, suppliers, "l_suppkey", "s_suppkey", "s_name", "[unknown company]", "company"
    )


REPORT_COUNT_LEFT_UNKNOWN = """
SELECT COALESCE(s.s_name, '[unknown company]') AS company, COUNT(*) AS active_postings
FROM lineitem l LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 5000) s
  ON s.s_suppkey = l.l_suppkey
WHERE l.l_linestatus = 'O'
GROUP BY s.s_suppkey, s.s_name
ORDER BY active_postings DESC, company
"""


def report_by_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct open orders per part type."""
    parts = table(spark, sf_dir, "part")
    bridge = table(spark, sf_dir, "lineitem").join(
        parts.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey"
    )
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "O")
    types = parts.select("p_type").distinct().withColumn("type_name", F.col("p_type"))
    return count_by_bridge(
        bridge, orders, types, posting="l_orderkey", fact_key="o_orderkey",
        value="p_type", key="p_type", name="type_name", out="work_mode",
    )


REPORT_BY_BRIDGE = """
SELECT p.p_type AS work_mode, COUNT(DISTINCT l.l_orderkey) AS active_postings
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE o.o_orderstatus = 'O'
GROUP BY p.p_type ORDER BY active_postings DESC, work_mode
"""


def report_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders per nation of their customer; every order has one."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "O")
    placed = orders.join(
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"),
        "o_custkey",
    )
    return count_by_required(
        placed, table(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey", "n_name", "source"
    )


REPORT_BY_SOURCE = """
SELECT n.n_name AS source, COUNT(*) AS active_postings
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE o.o_orderstatus = 'O'
GROUP BY n.n_nationkey, n.n_name ORDER BY active_postings DESC, source
"""


def detail_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wide row per order.

    What an order collects are distinct values of small domains (flags, part
    types), gathered before the join so nothing fans out.
    """
    orders = table(spark, sf_dir, "orders")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_linestatus", "l_quantity"
    )
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    per_order = (
        items.join(parts, "l_partkey")
        .groupBy("l_orderkey")
        .agg(
            F.array_sort(F.collect_set("l_returnflag")).alias("locations"),
            F.array_sort(F.collect_set("l_linestatus")).alias("work_modes"),
            F.min("l_quantity").cast("decimal(7,2)").alias("low"),
            F.max("l_quantity").cast("decimal(7,2)").alias("high"),
            F.array_sort(F.collect_set("p_type")).alias("skills"),
        )
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"
    )
    none = F.lit(None).cast("string")
    empty = F.array().cast("array<string>")
    options = F.when(
        F.col("low").isNotNull(),
        F.array(
            F.struct(
                F.col("o_orderstatus").alias("employment_relation_name"),
                none.alias("workload_name"),
                F.col("low").alias("hours_min"),
                F.col("high").alias("hours_max"),
                none.alias("hours_period"),
            )
        ),
    )
    day = F.col("o_orderdate").cast("timestamp")
    postings = (
        orders.join(customers, "o_custkey", "left")
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").cast("string").alias("posting_key"),
            F.col("o_orderpriority").alias("source_key"),
            F.col("o_orderkey").cast("string").alias("source_job_id"),
            F.when(F.col("o_orderstatus") == "O", "active").otherwise("inactive").alias("status"),
            F.col("c_name").alias("company_name"),
            F.col("c_mktsegment").alias("role_name"),
            none.alias("seniority_level_name"),
            F.coalesce("locations", empty).alias("locations"),
            F.coalesce("work_modes", empty).alias("work_modes"),
            options.alias("employment_options"),
            F.transform(
                F.coalesce("skills", empty),
                lambda s: F.struct(
                    s.alias("name"), none.alias("proficiency_level_name"),
                    none.alias("requirement_type_name"), F.lit(None).cast("smallint").alias("priority"),
                ),
            ).alias("skill_requirements"),
            F.struct(
                F.col("o_totalprice").cast("decimal(12,2)").alias("salary_min"),
                F.lit(None).cast("decimal(12,2)").alias("salary_max"),
                F.lit("USD").alias("salary_currency"),
                none.alias("salary_period"),
            ).alias("compensation"),
            none.alias("source_url"),
            day.alias("source_published_at"),
            F.lit(None).cast("timestamp").alias("source_updated_at"),
            day.alias("retrieved_at"),
            day.alias("last_seen_at"),
        )
    )
    sources = orders.select(F.col("o_orderpriority").alias("source_key")).distinct()
    sources = sources.withColumn("name", F.regexp_replace("source_key", r"^\d-", ""))
    detail = posting_detail(postings, sources)
    at = [c for c, t in detail.dtypes if t == "timestamp"]
    money = [c for c, t in detail.dtypes if t.startswith("decimal")]
    return detail.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in at}
        | {c: F.col(c).cast("double") for c in money}
    )


DETAIL_WIDE = """
WITH items AS (
  SELECT l_orderkey, l_returnflag, l_linestatus, l_quantity, p_type
  FROM lineitem JOIN part ON p_partkey = l_partkey
), flags AS (
  SELECT l_orderkey, string_agg(l_returnflag, ', ' ORDER BY l_returnflag) AS locations
  FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM items) GROUP BY l_orderkey
), modes AS (
  SELECT l_orderkey, string_agg(l_linestatus, ', ' ORDER BY l_linestatus) AS work_modes
  FROM (SELECT DISTINCT l_orderkey, l_linestatus FROM items) GROUP BY l_orderkey
), hours AS (
  SELECT l_orderkey, CAST(MIN(l_quantity) AS DECIMAL(7,2)) AS low,
         CAST(MAX(l_quantity) AS DECIMAL(7,2)) AS high FROM items GROUP BY l_orderkey
), skills AS (
  SELECT l_orderkey, '[' || string_agg('{"skill":"' || p_type ||
    '","proficiency":null,"requirement_type":null,"priority":null}', ',' ORDER BY p_type) || ']' AS skills
  FROM (SELECT DISTINCT l_orderkey, p_type FROM items) GROUP BY l_orderkey
)
SELECT CAST(o.o_orderkey AS VARCHAR) AS job_posting_id,
  CASE WHEN o.o_orderstatus = 'O' THEN 'active' ELSE 'inactive' END AS status,
  substr(o.o_orderpriority, 3, 20) AS source,
  CAST(o.o_orderkey AS VARCHAR) AS source_job_id,
  c.c_name AS company, c.c_mktsegment AS role, CAST(NULL AS VARCHAR) AS seniority_level,
  f.locations, m.work_modes,
  CASE WHEN h.low IS NOT NULL THEN '[{"employment_relation":"' || o.o_orderstatus ||
    '","workload":null,"hours_min":' || CAST(h.low AS VARCHAR) || ',"hours_max":' ||
    CAST(h.high AS VARCHAR) || ',"hours_period":null}]' END AS employment_options,
  s.skills,
  CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS salary_min,
  CAST(NULL AS DOUBLE) AS salary_max, 'USD' AS salary_currency,
  CAST(NULL AS VARCHAR) AS salary_period, CAST(NULL AS VARCHAR) AS source_url,
  strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS source_published_at,
  CAST(NULL AS VARCHAR) AS source_updated_at,
  strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS retrieved_at,
  strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS last_seen_at
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN flags f ON f.l_orderkey = o.o_orderkey
LEFT JOIN modes m ON m.l_orderkey = o.o_orderkey
LEFT JOIN hours h ON h.l_orderkey = o.o_orderkey
LEFT JOIN skills s ON s.l_orderkey = o.o_orderkey
ORDER BY o.o_orderdate DESC, job_posting_id
"""


def _order_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as runs: the items an order has against the items it was to have."""
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").cast("int").alias("processed_records"),
        F.countDistinct("l_linenumber").cast("int").alias("lines"),
    )
    orders = table(spark, sf_dir, "orders")
    return orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderpriority").alias("source_id"),
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.when(F.col("o_orderstatus") == "O", "processed")
        .when(F.col("o_orderstatus") == "P", "partial")
        .otherwise("failed")
        .alias("status"),
        F.col("lines").alias("record_count"),
        F.coalesce("processed_records", F.lit(0)).alias("processed_records"),
    )


_ORDER_RUNS = """
runs AS (
  SELECT o.o_orderpriority AS source_id, CAST(o.o_orderkey AS VARCHAR) AS run_id,
    CASE o.o_orderstatus WHEN 'O' THEN 'processed' WHEN 'P' THEN 'partial' ELSE 'failed' END AS status,
    l.lines AS record_count, COALESCE(l.n, 0) AS processed_records
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, CAST(COUNT(*) AS INTEGER) AS n,
      CAST(COUNT(DISTINCT l_linenumber) AS INTEGER) AS lines
    FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
)"""


def quality_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_counts(_order_runs(spark, sf_dir))


QUALITY_RUN_COUNTS = f"""
WITH {_ORDER_RUNS}
SELECT status, COUNT(*) AS runs,
  CAST(COALESCE(SUM(record_count), 0) AS BIGINT) AS downloaded_records,
  CAST(COALESCE(SUM(processed_records), 0) AS BIGINT) AS processed_records
FROM runs GROUP BY status ORDER BY status
"""


def quality_count_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_mismatches(_order_runs(spark, sf_dir))


QUALITY_COUNT_MISMATCHES = f"""
WITH {_ORDER_RUNS}
SELECT source_id, run_id, record_count, processed_records FROM runs
WHERE status = 'processed' AND record_count IS NOT NULL AND record_count <> processed_records
ORDER BY source_id, run_id
"""


def quality_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as postings, their items as links, customers as canonicals."""
    orders = table(spark, sf_dir, "orders")
    postings = orders.select(
        F.col("o_orderkey").alias("posting_key"),
        F.col("o_orderpriority").alias("company"),
        F.when(F.col("o_totalprice") > 1000, F.date_format("o_orderdate", "yyyy-MM-dd")).alias(
            "fingerprint"
        ),
    )
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_returnflag").alias("flag"))
    method = (
        F.when(F.col("flag") == "A", "algorithmic_match")
        .when(F.col("flag") == "N", "new_canonical_job")
        .otherwise("guess")
    )
    links = shipped.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("posting_key"),
        F.col("o_custkey").alias("canonical_id"),
        method.alias("match_method"),
    )
    canonicals = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("canonical_id"))
    return canonical_issues(postings, links, canonicals)


QUALITY_INTEGRITY = """
WITH postings AS (
  SELECT o_orderkey AS posting_key, o_orderpriority AS company,
    CASE WHEN o_totalprice > 1000 THEN strftime(o_orderdate, '%Y-%m-%d') END AS fingerprint
  FROM orders
), links AS (
  SELECT o_orderkey AS posting_key, o_custkey AS canonical_id,
    CASE MIN(l_returnflag) WHEN 'A' THEN 'algorithmic_match' WHEN 'N' THEN 'new_canonical_job'
      ELSE 'guess' END AS match_method
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_custkey
)
SELECT 'missing_canonical_link' AS issue, COUNT(*) AS issue_count
FROM postings p LEFT JOIN links k ON k.posting_key = p.posting_key WHERE k.posting_key IS NULL
UNION ALL
SELECT 'canonical_without_posting', COUNT(*)
FROM customer c LEFT JOIN links k ON k.canonical_id = c.c_custkey WHERE k.canonical_id IS NULL
UNION ALL
SELECT 'duplicate_fingerprint_across_canonicals', COUNT(*) FROM (
  SELECT company, fingerprint FROM postings p JOIN links k ON k.posting_key = p.posting_key
  WHERE fingerprint IS NOT NULL GROUP BY company, fingerprint
  HAVING COUNT(DISTINCT canonical_id) > 1)
UNION ALL
SELECT 'invalid_match_method', COUNT(*) FROM links
WHERE match_method NOT IN ('new_canonical_job', 'algorithmic_match', 'llm_match', 'manual_match')
ORDER BY issue
"""


def seed_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts nobody ordered at a discount of 10 %, to be added to those known."""
    seed = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"))
    known = table(spark, sf_dir, "lineitem").where(F.col("l_discount") >= 0.1)
    known = known.select(F.col("l_partkey").alias("key")).distinct()
    return missing_seeds(seed, known, "key")


SEED_MISSING = """
SELECT p_partkey AS key, p_name AS name FROM part
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_discount >= 0.1)
"""


def slug_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    name = F.concat_ws(" - ", "p_brand", "p_name", "p_type")
    return parts.select("p_partkey", slug(name).alias("source_key"))


SLUG_KEYS = """
SELECT p_partkey,
  lower(regexp_replace(p_brand || ' - ' || p_name || ' - ' || p_type, '[^a-zA-Z0-9]+', '_', 'g')) AS source_key
FROM part
"""


QUERIES = {
    "report_top_terms": (report_top_terms, REPORT_TOP_TERMS),
    "report_count_left_unknown": (report_count_left_unknown, REPORT_COUNT_LEFT_UNKNOWN),
    "report_by_bridge": (report_by_bridge, REPORT_BY_BRIDGE),
    "report_by_source": (report_by_source, REPORT_BY_SOURCE),
    "detail_wide": (detail_wide, DETAIL_WIDE),
    "quality_run_counts": (quality_run_counts, QUALITY_RUN_COUNTS),
    "quality_count_mismatches": (quality_count_mismatches, QUALITY_COUNT_MISMATCHES),
    "quality_integrity": (quality_integrity, QUALITY_INTEGRITY),
    "seed_missing": (seed_missing, SEED_MISSING),
    "slug_keys": (slug_keys, SLUG_KEYS),
}
