"""Canonical linking on documents and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweft.catalog.inputs import table
from jobweft.functions.text import content_fingerprint
from jobweft.operators.canonical import assign_canonical, fallback_candidates
from jobweft.session import cut_lineage

_FINGERPRINT = "sha256(replace(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 'ß', 'ss'))"


def canonical_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of a document within a language share the first one's canonical."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    new = docs.select(
        F.col("doc_id").cast("string").alias("posting_key"),
        F.col("lang").alias("company"),
        content_fingerprint(F.col("text")).alias("fingerprint"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("seniority"),
        F.array().cast("array<string>").alias("locations"),
        F.col("doc_id").alias("ord"),
    )
    return assign_canonical(cut_lineage(new))


CANONICAL_EXACT = f"""
WITH d AS (SELECT doc_id, MIN(doc_id) OVER (PARTITION BY lang, {_FINGERPRINT}) AS head FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS posting_key, CAST(head AS VARCHAR) AS canonical_id,
  CASE WHEN doc_id = head THEN 'new_canonical_job' ELSE 'algorithmic_match' END AS match_method
FROM d
"""


def canonical_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole rule: documents with a quality label of 1 are linked already.

    Language is the company, source the role, the label of toxicity the seniority
    and the length class of the text its set of locations.
    """
    docs = table(spark, sf_dir, "documents")
    docs = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    places = (
        F.when(F.col("n_chars") < 400, F.array().cast("array<string>"))
        .when(F.col("n_chars") < 1500, F.array(F.lit("a")))
        .when(F.col("n_chars") < 3000, F.array(F.lit("b"), F.lit("a")))
        .otherwise(F.array(F.lit("c")))
    )
    postings = docs.select(
        F.col("doc_id").cast("string").alias("posting_key"),
        F.col("lang").alias("company"),
        F.when(F.col("n_chars") > 300, content_fingerprint(F.col("text"))).alias("fingerprint"),
        F.when(F.col("source") != "src3", F.col("source")).alias("role"),
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").alias("seniority"),
        places.alias("locations"),
        F.col("doc_id").alias("ord"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("is_linked"),
    )
    # Read twice, as new and as linked postings; the fingerprint is made once.
    postings = cut_lineage(postings)
    linked = postings.where("is_linked").withColumn(
        "canonical_id", F.concat(F.lit("c"), F.floor(F.col("ord") / 40).cast("string"))
    )
    return assign_canonical(
        postings.where("not is_linked").drop("is_linked"), linked.drop("is_linked", "ord")
    )


CANONICAL_ASSIGN = f"""
WITH p AS (
  SELECT doc_id AS k, lang AS company,
    CASE WHEN n_chars > 300 THEN {_FINGERPRINT} END AS fp,
    CASE WHEN source <> 'src3' THEN source END AS role,
    CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'low' END AS lvl,
    CASE WHEN n_chars < 400 THEN NULL WHEN n_chars < 1500 THEN 'a' WHEN n_chars < 3000 THEN 'ab' ELSE 'c' END AS places,
    COALESCE(quality = 1, FALSE) AS is_linked
  FROM documents LEFT JOIN labels USING (doc_id)
), linked AS (
  SELECT company, list({{'k': k, 'fp': fp, 'role': role, 'lvl': lvl, 'places': places, 'c': 'c' || CAST(floor(k / 40) AS INTEGER)}}
    ORDER BY k) AS pool FROM p WHERE is_linked GROUP BY company
), arriving AS (
  SELECT company, list({{'k': k, 'fp': fp, 'role': role, 'lvl': lvl, 'places': places, 'c': CAST(k AS VARCHAR)}}
    ORDER BY k) AS items FROM p WHERE NOT is_linked GROUP BY company
), walked AS (
  SELECT list_reduce(items, lambda pool, x: list_append(pool, {{'k': x.k, 'fp': x.fp, 'role': x.role, 'lvl': x.lvl, 'places': x.places,
    'c': CASE
      WHEN len(list_distinct(list_transform(list_filter(pool, lambda y: y.fp = x.fp), lambda y: y.c))) = 1
        THEN list_distinct(list_transform(list_filter(pool, lambda y: y.fp = x.fp), lambda y: y.c))[1]
      WHEN len(list_distinct(list_transform(list_filter(pool, lambda y: y.fp = x.fp), lambda y: y.c))) > 1 THEN x.c
      WHEN len(list_distinct(list_transform(list_filter(pool, lambda y: y.role = x.role AND y.places = x.places
          AND (y.lvl IS NULL OR x.lvl IS NULL OR y.lvl = x.lvl)), lambda y: y.c))) = 1
        THEN list_distinct(list_transform(list_filter(pool, lambda y: y.role = x.role AND y.places = x.places
          AND (y.lvl IS NULL OR x.lvl IS NULL OR y.lvl = x.lvl)), lambda y: y.c))[1]
      ELSE x.c END}}), COALESCE(pool, [])) AS pool
  FROM arriving LEFT JOIN linked USING (company)
), links AS (SELECT UNNEST(pool) AS l FROM walked)
SELECT CAST(l.k AS VARCHAR) AS posting_key, l.c AS canonical_id,
  CASE WHEN l.c = CAST(l.k AS VARCHAR) THEN 'new_canonical_job' ELSE 'algorithmic_match' END AS match_method
FROM links JOIN p ON p.k = l.k WHERE NOT p.is_linked
"""


def canonical_fallback_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in building as new postings, all others as linked ones.

    The set of priorities of a customer's orders stands for the locations.
    """
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    sets = orders.groupBy("c_custkey").agg(F.collect_set("o_orderpriority").alias("locations"))
    customers = table(spark, sf_dir, "customer").join(sets, "c_custkey", "left").select(
        F.col("c_custkey").cast("string").alias("posting_key"),
        F.lit("all").alias("company"),
        F.lit(None).cast("string").alias("fingerprint"),
        F.col("c_nationkey").cast("string").alias("role"),
        F.when(F.col("c_acctbal") > 6000, "rich").when(F.col("c_acctbal") < 0, "poor").alias("seniority"),
        F.coalesce("locations", F.array().cast("array<string>")).alias("locations"),
        "c_mktsegment",
    )
    linked = customers.where(F.col("c_mktsegment") != "BUILDING").withColumn("canonical_id", F.col("c_mktsegment"))
    return fallback_candidates(customers.where(F.col("c_mktsegment") == "BUILDING"), linked)


CANONICAL_FALLBACK_CANDIDATES = """
WITH c AS (
  SELECT c_custkey AS k, c_nationkey AS role, c_mktsegment AS seg,
    CASE WHEN c_acctbal > 6000 THEN 'rich' WHEN c_acctbal < 0 THEN 'poor' END AS lvl,
    (SELECT string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority)
     FROM orders WHERE o_custkey = c_custkey) AS places
  FROM customer
)
SELECT CAST(n.k AS VARCHAR) AS posting_key, MIN(l.seg) AS c_low, MAX(l.seg) AS c_high
FROM c n LEFT JOIN c l ON l.seg <> 'BUILDING' AND l.role = n.role AND l.places = n.places
  AND (l.lvl IS NULL OR n.lvl IS NULL OR l.lvl = n.lvl)
WHERE n.seg = 'BUILDING' AND n.places IS NOT NULL
GROUP BY n.k
"""


QUERIES = {
    "canonical_exact": (canonical_exact, CANONICAL_EXACT),
    "canonical_fallback_candidates": (canonical_fallback_candidates, CANONICAL_FALLBACK_CANDIDATES),
    "canonical_assign": (canonical_assign, CANONICAL_ASSIGN),
}
