"""Row constraints, reference checks and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweft.catalog.inputs import table
from jobweft.operators.constraints import (
    hours_constraints,
    link_constraints,
    posting_constraints,
    run_constraints,
    salary_constraints,
    skill_constraints,
    split_quarantine,
    unknown_reference,
    violations,
)


def constraints_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraint names broken by each line item, read as a posting row."""
    items = table(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity").cast("decimal(7,2)")
    rows = items.select(
        "l_orderkey", "l_linenumber",
        (quantity * 4 - 8).alias("hours_min"),
        F.when(F.col("l_tax") > 0, quantity * 5 - 20).alias("hours_max"),
        F.when(F.col("l_returnflag") == "R", "week")
        .when(F.col("l_returnflag") == "A", "day")
        .when(F.col("l_linestatus") == "O", "shift")
        .alias("hours_period"),
        F.when(F.col("l_discount") > 0.01, F.col("l_extendedprice")).cast("decimal(12,2)").alias("salary_min"),
        F.when(F.col("l_tax") > 0.01, F.lit(50000) - F.col("l_extendedprice")).cast("decimal(12,2)").alias("salary_max"),
        F.when(F.col("l_linestatus") == "O", "EUR").otherwise("eur").alias("salary_currency"),
        F.when(F.col("l_returnflag") == "N", "decade").otherwise("year").alias("salary_period"),
        F.when(F.col("l_discount") > 0, F.col("l_linenumber")).alias("priority"),
        F.when(F.col("l_returnflag") == "N", "gone").otherwise("active").alias("status"),
        F.when(F.col("l_tax") > 0.04, F.sha2(F.col("l_orderkey").cast("string"), 256)).otherwise("F00").alias("content_fingerprint"),
    )
    rules = {
        **posting_constraints(), **hours_constraints(), **salary_constraints(), **skill_constraints(),
    }
    return rows.select(
        "l_orderkey", "l_linenumber", F.array_join(violations(rules), ",").alias("broken")
    )


CONSTRAINTS_QUARANTINE = """
WITH r AS (
  SELECT l_orderkey, l_linenumber,
    CAST(l_quantity AS DECIMAL(9,2)) * 4 - 8 AS lo,
    CASE WHEN l_tax > 0 THEN CAST(l_quantity AS DECIMAL(9,2)) * 5 - 20 END AS hi,
    CASE WHEN l_returnflag = 'R' THEN 'week' WHEN l_returnflag = 'A' THEN 'day' WHEN l_linestatus = 'O' THEN 'shift' END AS p,
    CASE WHEN l_discount > 0.01 THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS slo,
    CASE WHEN l_tax > 0.01 THEN CAST(50000 - l_extendedprice AS DECIMAL(12,2)) END AS shi,
    CASE WHEN l_linestatus = 'O' THEN 'EUR' ELSE 'eur' END AS cur,
    CASE WHEN l_returnflag = 'N' THEN 'decade' ELSE 'year' END AS sp,
    CASE WHEN l_discount > 0 THEN l_linenumber END AS pri,
    CASE WHEN l_returnflag = 'N' THEN 'gone' ELSE 'active' END AS st,
    l_tax > 0.04 AS fp_ok
  FROM lineitem
), c AS (SELECT *, CASE p WHEN 'week' THEN 168 WHEN 'day' THEN 24 ELSE 8784 END AS cap FROM r)
SELECT l_orderkey, l_linenumber, concat_ws(',',
  CASE WHEN st = 'gone' THEN 'status_domain' END,
  CASE WHEN NOT fp_ok THEN 'fingerprint_format' END,
  CASE WHEN lo < 0 THEN 'hours_min_not_negative' END,
  CASE WHEN hi < 0 THEN 'hours_max_not_negative' END,
  CASE WHEN hi < lo THEN 'hours_range_ordered' END,
  CASE WHEN p = 'shift' THEN 'hours_period_domain' END,
  CASE WHEN lo > cap THEN 'hours_min_within_period' END,
  CASE WHEN hi > cap THEN 'hours_max_within_period' END,
  CASE WHEN slo IS NULL AND shi IS NULL THEN 'salary_has_bound' END,
  CASE WHEN slo < 0 THEN 'salary_min_not_negative' END,
  CASE WHEN shi < 0 THEN 'salary_max_not_negative' END,
  CASE WHEN shi < slo THEN 'salary_range_ordered' END,
  CASE WHEN cur = 'eur' THEN 'salary_currency_format' END,
  CASE WHEN sp = 'decade' THEN 'salary_period_domain' END,
  CASE WHEN pri NOT BETWEEN 1 AND 5 THEN 'priority_range' END) AS broken
FROM c
"""


def ledger_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run and link constraints on orders: how many rows break each of them."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        F.when(F.col("o_orderstatus") == "P", "halted").otherwise("processed").alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice") - 20000).cast("int").alias("record_count"),
        (F.col("o_totalprice") - 10000).cast("int").alias("processed_records"),
        F.regexp_replace("o_orderpriority", r"^\d-", "").alias("match_method"),
    )
    rules = {**run_constraints(), **link_constraints()}
    return (
        rows.select(F.explode(violations(rules)).alias("broken"))
        .groupBy("broken")
        .agg(F.count("*").alias("n"))
    )


LEDGER_CONSTRAINTS = """
SELECT 'run_status_domain' AS broken, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'P' HAVING COUNT(*) > 0
UNION ALL
SELECT 'record_count_not_negative', COUNT(*) FROM orders
WHERE o_orderpriority <> '5-LOW' AND trunc(o_totalprice - 20000) < 0 HAVING COUNT(*) > 0
UNION ALL
SELECT 'processed_records_not_negative', COUNT(*) FROM orders WHERE trunc(o_totalprice - 10000) < 0 HAVING COUNT(*) > 0
UNION ALL
SELECT 'match_method_domain', COUNT(*) FROM orders HAVING COUNT(*) > 0
"""


def reference_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose supplier is unknown or missing, as error rows."""
    items = table(spark, sf_dir, "lineitem")
    named = items.select(
        F.col("l_returnflag").alias("source_id"),
        F.col("l_linenumber").cast("string").alias("run_id"),
        F.col("l_orderkey").alias("pos"),
        F.when(F.col("l_tax") > 0, F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))).alias("company"),
    )
    known = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0)
    checked = unknown_reference(named, "company", known, "s_name", "companies", required=True)
    error = F.struct(
        F.col("company").alias("source_job_id"), F.lit("database").alias("stage"),
        F.lit("ValueError").alias("error_type"), F.col("company_error").alias("error_message"),
    )
    _, bad = split_quarantine(checked.withColumn("error", F.when(F.col("company_error").isNotNull(), error)))
    return bad


REFERENCE_QUARANTINE = """
WITH named AS (
  SELECT l_returnflag AS source_id, CAST(l_linenumber AS VARCHAR) AS run_id, l_orderkey AS pos,
    CASE WHEN l_tax > 0 THEN 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') END AS company
  FROM lineitem
)
SELECT source_id, run_id, pos, company AS source_job_id, 'database' AS stage, 'ValueError' AS error_type,
  CASE WHEN company IS NULL THEN 'Missing reference value in companies: None'
    ELSE 'Unknown reference value in companies: ' || company END AS error_message
FROM named LEFT JOIN supplier ON s_name = company AND s_acctbal > 0
WHERE s_name IS NULL
"""


QUERIES = {
    "constraints_quarantine": (constraints_quarantine, CONSTRAINTS_QUARANTINE),
    "ledger_constraints": (ledger_constraints, LEDGER_CONSTRAINTS),
    "reference_quarantine": (reference_quarantine, REFERENCE_QUARANTINE),
}
