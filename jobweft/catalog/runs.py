"""Run ledger, upsert and snapshot lifecycle on events.

A day of one event type is a run, its events are the records, and events of type
"error" or with a large value stand for rejected ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweft.catalog.inputs import table
from jobweft.operators.ledger import (
    advance_ledger,
    link_errors,
    load_summary,
    new_runs,
    run_outcomes,
    runs_to_process,
)
from jobweft.operators import upsert as upserts
from jobweft.operators.upsert import deactivate_missing, snapshot_cutoffs, upsert
from jobweft.sources.boards import attribute_runs
from jobweft.sources.bronze import parse_run_metadata

_RUNS_SQL = """
runs AS (SELECT event_type AS source_id, strftime(ts, '%Y-%m-%d') AS run_id, COUNT(*) AS n
         FROM events GROUP BY ALL),
ledger AS (SELECT source_id, run_id,
    CASE WHEN n < 60 THEN 'processed' WHEN n < 66 THEN 'partial' WHEN n < 70 THEN 'failed' ELSE 'processing' END AS status
  FROM runs WHERE run_id < '2024-01-21')"""


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.groupBy(
        F.col("event_type").alias("source_id"), F.date_format("ts", "yyyy-MM-dd").alias("run_id")
    ).agg(F.count("*").alias("n"))


def _ledger(runs: DataFrame) -> DataFrame:
    status = (
        F.when(F.col("n") < 60, "processed").when(F.col("n") < 66, "partial")
        .when(F.col("n") < 70, "failed").otherwise("processing")
    )
    return runs.where(F.col("run_id") < "2024-01-21").select("source_id", "run_id", status.alias("status"))


def ledger_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs to process, with and without retrying partly read ones, and new runs."""
    runs = _runs(spark, sf_dir)
    ledger = _ledger(runs)
    plain = runs_to_process(runs, ledger).select("source_id", "run_id", F.lit("plain").alias("mode"))
    retry = runs_to_process(runs, ledger, retry_partial=True).select(
        "source_id", "run_id", F.lit("retry").alias("mode")
    )
    fresh = new_runs(runs, ledger).select("source_id", "run_id", F.col("status").alias("mode"))
    return plain.unionByName(retry).unionByName(fresh)


LEDGER_INCREMENTAL = f"""
WITH {_RUNS_SQL}
SELECT r.source_id, r.run_id, 'plain' AS mode FROM runs r LEFT JOIN ledger l USING (source_id, run_id)
WHERE l.status IS NULL OR l.status NOT IN ('processed', 'partial')
UNION ALL
SELECT r.source_id, r.run_id, 'retry' FROM runs r LEFT JOIN ledger l USING (source_id, run_id)
WHERE l.status IS NULL OR l.status <> 'processed'
UNION ALL
SELECT r.source_id, r.run_id, 'pending' FROM runs r LEFT JOIN ledger l USING (source_id, run_id)
WHERE l.status IS NULL
"""


def _events_as_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(runs, accepted records, error rows): a run is one user's day."""
    events = table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    rows = events.select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("source_id"),
        day.alias("run_id"), F.col("event_id").alias("pos"), "event_type", "value",
    )
    is_bad = (F.col("event_type") == "error") | (F.col("value") > 60)
    good = rows.where(~is_bad)
    errors = rows.where(is_bad).select(
        "source_id", "run_id", "pos",
        F.when(F.col("value") > 60, "database").otherwise("parse").alias("stage"),
        F.lit("ValueError").alias("error_type"),
        F.col("pos").cast("string").alias("source_job_id"),
        F.concat(F.lit("event "), F.col("pos").cast("string"), F.lit(" rejected")).alias("error_message"),
    )
    runs = rows.groupBy("source_id", "run_id").agg(
        F.count("*").cast("int").alias("n"), F.max("value").alias("top")
    )
    runs = runs.select(
        "source_id", "run_id",
        F.col("source_id").alias("source_key"),
        F.lit("p").alias("raw_path"),
        F.to_timestamp("run_id").alias("retrieved_at"),
        F.when(F.col("top") < 10, F.col("n") + 1).when(F.col("top") > 20, F.col("n")).alias("record_count"),
        F.lit(None).cast("string").alias("payload_sha256"),
        F.when((F.col("top") > 200), F.lit("no list")).alias("run_error"),
    )
    return runs, good, errors


_OUTCOMES_SQL = """
rows_ AS (SELECT 'user' || user_id AS source_id, strftime(ts, '%Y-%m-%d') AS run_id, event_id AS pos, event_type, value,
    event_type = 'error' OR value > 60 AS bad, value > 60 AS late FROM events),
runs AS (SELECT source_id, run_id, COUNT(*) AS n, MAX(value) AS top,
    COUNT(*) FILTER (WHERE NOT bad) AS good, COUNT(*) FILTER (WHERE bad) AS bad FROM rows_ GROUP BY ALL),
msgs AS (SELECT source_id, run_id, string_agg('event ' || pos || ' rejected', '; ' ORDER BY late, pos) AS msg
  FROM (SELECT *, row_number() OVER (PARTITION BY source_id, run_id ORDER BY late, pos) AS k FROM rows_ WHERE bad)
  WHERE k <= 3 GROUP BY ALL),
counted AS (SELECT *, CASE WHEN top < 10 THEN n + 1 WHEN top > 20 THEN n ELSE good + bad END AS expected,
    CASE WHEN top < 10 THEN n + 1 WHEN top > 20 THEN n END AS record_count FROM runs LEFT JOIN msgs USING (source_id, run_id)),
outcomes AS (SELECT *, CASE WHEN top > 200 OR good = 0 THEN 'failed' WHEN bad > 0 OR good < expected THEN 'partial'
    ELSE 'processed' END AS status FROM counted)"""


def run_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = run_outcomes(*_events_as_runs(spark, sf_dir))
    return outcomes.select(
        "source_id", "run_id", "record_count", "status", "processed_records", "error_message"
    )


RUN_OUTCOME = f"""
WITH {_OUTCOMES_SQL}
SELECT source_id, run_id, CAST(record_count AS INTEGER) AS record_count, status,
  CAST(CASE WHEN status = 'failed' THEN 0 ELSE good END AS INTEGER) AS processed_records,
  CASE WHEN top > 200 THEN 'no list' WHEN status = 'failed' THEN COALESCE(msg, 'No records were processed')
    WHEN status = 'partial' THEN COALESCE(msg, 'Some records were not processed') END AS error_message
FROM outcomes
"""


def ledger_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of the first ten days after the outcomes of all days from the sixth on."""
    runs, good, errors = _events_as_runs(spark, sf_dir)
    outcomes = run_outcomes(runs, good, errors)
    at = F.to_timestamp(F.lit("2020-01-01"))
    old = outcomes.where(F.col("run_id") <= "2024-01-10").select(
        "source_id", "run_id", "source_key", "raw_path", "retrieved_at", "record_count", "payload_sha256",
        F.lit("failed").alias("status"), F.lit(0).alias("processed_records"),
        F.lit("v1").alias("parser_version"), F.lit("old").alias("error_message"),
        at.alias("processing_started_at"), at.alias("processed_at"), at.alias("created_at"), at.alias("updated_at"),
    )
    new = outcomes.where(F.col("run_id") >= "2024-01-06")
    after = advance_ledger(old, new, "v2")
    return after.select(
        "source_id", "run_id", "status", "processed_records", "parser_version", "error_message",
        (F.col("processed_at") == at).alias("processed_before"),
        (F.col("created_at") == at).alias("created_before"),
        (F.col("updated_at") == at).alias("updated_before"),
    )


LEDGER_ADVANCE = f"""
WITH {_OUTCOMES_SQL},
o AS (SELECT source_id, run_id, status, CASE WHEN status = 'failed' THEN 0 ELSE good END AS processed,
  CASE WHEN top > 200 THEN 'no list' WHEN status = 'failed' THEN COALESCE(msg, 'No records were processed')
    WHEN status = 'partial' THEN COALESCE(msg, 'Some records were not processed') END AS message,
  run_id <= '2024-01-10' AS known, run_id >= '2024-01-06' AS tried FROM outcomes)
SELECT source_id, run_id, CASE WHEN tried THEN status ELSE 'failed' END AS status,
  CAST(CASE WHEN tried THEN processed ELSE 0 END AS INTEGER) AS processed_records,
  CASE WHEN tried AND status <> 'failed' THEN 'v2' WHEN known THEN 'v1' END AS parser_version,
  CASE WHEN tried THEN message ELSE 'old' END AS error_message,
  CASE WHEN tried AND status <> 'failed' THEN FALSE WHEN known THEN TRUE END AS processed_before,
  known AS created_before, NOT tried AS updated_before
FROM o WHERE known OR tried
"""


def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run fields and problems read from one metadata text per event, some of them damaged."""
    kind = F.col("event_id") % 7
    written = F.to_json(
        F.struct(
            F.when(kind != 1, F.concat(F.lit(" run"), "event_id", F.lit(" "))).alias("run_id"),
            F.when(kind != 2, F.col("event_type")).alias("source_id"),
            F.when(kind == 3, F.lit("many")).otherwise(F.floor("value").cast("string")).alias("record_count"),
            F.struct(F.concat(F.lit("user "), "user_id").alias("company")).alias("context"),
        )
    )
    text = F.when(kind == 4, F.concat(F.lit("{"), written)).when(kind == 5, F.concat(F.lit("["), written, F.lit("]"))).otherwise(written)
    read = parse_run_metadata(table(spark, sf_dir, "events").select("event_id", text.alias("metadata")), F.col("metadata"))
    return read.select("event_id", "source_id", "run_id", "record_count", "context_company", "run_error")


RUN_METADATA = """
SELECT event_id,
  CASE WHEN event_id % 7 NOT IN (2, 4, 5) THEN event_type END AS source_id,
  CASE WHEN event_id % 7 NOT IN (1, 4, 5) THEN 'run' || event_id END AS run_id,
  CASE WHEN event_id % 7 NOT IN (3, 4, 5) THEN CAST(floor(value) AS INTEGER) END AS record_count,
  CASE WHEN event_id % 7 NOT IN (4, 5) THEN 'user ' || user_id END AS context_company,
  CASE event_id % 7 WHEN 1 THEN 'Metadata field is missing: run_id' WHEN 2 THEN 'Metadata field is missing: source_id'
    WHEN 3 THEN 'Metadata field is no number: record_count' WHEN 4 THEN 'Metadata must be a JSON object'
    WHEN 5 THEN 'Metadata must be a JSON object' END AS run_error
FROM events
"""


def load_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a load over the days from the sixth on."""
    runs, good, errors = _events_as_runs(spark, sf_dir)
    outcomes = run_outcomes(runs, good, errors).where(F.col("run_id") >= "2024-01-06")
    return load_summary(runs, outcomes)


LOAD_COUNTERS = f"""
WITH {_OUTCOMES_SQL}, o AS (SELECT * FROM outcomes WHERE run_id >= '2024-01-06')
SELECT (SELECT COUNT(*) FROM outcomes) AS discovered,
  COUNT(*) FILTER (WHERE status = 'processed') AS processed, COUNT(*) FILTER (WHERE status = 'partial') AS partial,
  (SELECT COUNT(*) FROM outcomes) - COUNT(*) AS skipped, COUNT(*) FILTER (WHERE status = 'failed') AS failed,
  CAST(SUM(CASE WHEN status = 'failed' THEN 0 ELSE good END) AS BIGINT) AS records,
  CAST(CASE WHEN COUNT(*) FILTER (WHERE status <> 'processed') > 0 THEN 1 ELSE 0 END AS INTEGER) AS exit_code
FROM o
"""


def error_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error rows of the runs the ledger knows."""
    runs, _, errors = _events_as_runs(spark, sf_dir)
    return link_errors(errors, runs.where(F.col("record_count").isNotNull()))


ERROR_HISTORY = f"""
WITH {_OUTCOMES_SQL}
SELECT r.source_id, r.run_id, CAST(r.pos AS VARCHAR) AS source_job_id,
  CASE WHEN r.late THEN 'database' ELSE 'parse' END AS stage, 'ValueError' AS error_type,
  'event ' || r.pos || ' rejected' AS error_message
FROM rows_ r JOIN counted c USING (source_id, run_id) WHERE r.bad AND c.record_count IS NOT NULL
"""


def board_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as boards: which board each order line's run belongs to."""
    boards = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("adapter_id"),
        F.col("s_name").alias("source_key"),
        F.concat(F.lit("c"), F.floor(F.col("s_acctbal") / 2000).cast("string")).alias("company"),
        F.col("s_suppkey").cast("int").alias("board_ord"),
    )
    customers = table(spark, sf_dir, "customer")
    runs = customers.select(
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("adapter_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("Supplier#"), F.lpad(F.col("c_nationkey").cast("string"), 9, "0")))
        .otherwise(F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))).alias("source_id"),
        F.col("c_name").alias("run_id"),
        F.concat(F.lit("c"), F.floor(F.col("c_acctbal") / 2000).cast("string")).alias("context_company"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("explicit")).alias("context_source_key"),
        F.lit(None).cast("string").alias("run_error"),
    )
    return attribute_runs(runs, boards).select("run_id", "source_key", "run_error")


BOARD_ATTRIBUTION = """
WITH boards AS (
  SELECT 'n' || s_nationkey AS adapter_id, s_name AS source_key,
    'c' || CAST(floor(s_acctbal / 2000) AS INTEGER) AS company, s_suppkey AS ord FROM supplier
), runs AS (
  SELECT 'n' || c_nationkey AS adapter_id, c_name AS run_id, c_mktsegment AS seg,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'Supplier#' || lpad(CAST(c_nationkey AS VARCHAR), 9, '0')
      ELSE 'n' || c_nationkey END AS source_id,
    'c' || CAST(floor(c_acctbal / 2000) AS INTEGER) AS company FROM customer
)
SELECT run_id,
  CASE WHEN source_id <> adapter_id THEN source_id WHEN seg = 'MACHINERY' THEN 'explicit' ELSE COALESCE(
    (SELECT arg_min(b.source_key, b.ord) FROM boards b WHERE b.adapter_id = r.adapter_id AND b.company = r.company),
    adapter_id) END AS source_key,
  CASE WHEN source_id <> adapter_id AND NOT EXISTS (SELECT 1 FROM boards b
      WHERE b.adapter_id = r.adapter_id AND b.source_key = r.source_id)
    THEN 'Raw run source mismatch: adapter=' || adapter_id || ', metadata=' || source_id END AS run_error
FROM runs r
"""


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings keyed by (user, type): state of the first half, upserted by the second."""
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", "event_id", "value",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("retrieved"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("created"),
    )
    middle = F.unix_micros(F.to_timestamp(F.lit("2024-01-15")))
    state = upsert(
        events.where("false"), events.where(F.col("retrieved") < middle),
        ["user_id", "event_type"], ["retrieved", "event_id"], ["created"],
    )
    batch = events.where(F.col("retrieved") >= middle)
    return upsert(state, batch, ["user_id", "event_type"], ["retrieved", "event_id"], ["created"])


UPSERT_LATEST = """
SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value,
  epoch_us(MAX(ts)) AS retrieved, epoch_us(MIN(ts)) AS created
FROM events GROUP BY user_id, event_type
"""


def snapshot_inactive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users per board (event type) still in its newest complete daily snapshot."""
    events = table(spark, sf_dir, "events")
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    seen = events.groupBy(F.col("event_type").alias("source_key"), "user_id").agg(F.max(day).alias("last_seen_at"))
    postings = seen.withColumns(
        {
            "status": F.when(F.col("user_id") % 7 == 0, "unknown").otherwise("active"),
            "updated_at": F.lit(None).cast("timestamp"),
        }
    )
    ledger = events.groupBy(F.col("event_type").alias("source_key"), day.alias("retrieved_at")).agg(
        F.count("*").alias("n")
    )
    ledger = ledger.withColumn("status", F.when(F.col("n") >= 60, "processed").otherwise("partial"))
    after = deactivate_missing(postings, snapshot_cutoffs(ledger))
    return after.select(
        "source_key", "user_id", "status", F.date_format("last_seen_at", "yyyy-MM-dd").alias("last_seen"),
        F.col("updated_at").isNotNull().alias("touched"),
    )


SNAPSHOT_INACTIVE = """
WITH seen AS (SELECT event_type AS source_key, user_id, MAX(CAST(ts AS DATE)) AS d FROM events GROUP BY ALL),
cut AS (SELECT source_key, MAX(d) AS cutoff FROM (
  SELECT event_type AS source_key, CAST(ts AS DATE) AS d, COUNT(*) AS n FROM events GROUP BY ALL) WHERE n >= 60 GROUP BY ALL)
SELECT source_key, user_id,
  CASE WHEN user_id % 7 = 0 THEN 'unknown' WHEN d < cutoff THEN 'inactive' ELSE 'active' END AS status,
  strftime(d, '%Y-%m-%d') AS last_seen,
  COALESCE(user_id % 7 <> 0 AND d < cutoff, FALSE) AS touched
FROM seen LEFT JOIN cut USING (source_key)
"""


def child_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers that an order loses and gains when its shipped lines replace its open ones.

    The lines of status O are what is stored and those of status F what arrives; an order
    whose stored lines shipped later stays as it is.
    """
    lines = table(spark, sf_dir, "lineitem")

    def side(status: str) -> DataFrame:
        return lines.where(F.col("l_linestatus") == status).groupBy("l_orderkey").agg(
            F.max("l_shipdate").alias("at"), F.collect_set("l_suppkey").alias("suppliers")
        )

    return upserts.child_delta(side("O"), side("F"), ["l_orderkey"], ["at"], "suppliers")


CHILD_DELTA = """
WITH old AS (SELECT l_orderkey, MAX(l_shipdate) AS at_, list(DISTINCT l_suppkey) AS s FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL),
new AS (SELECT l_orderkey, MAX(l_shipdate) AS at_, list(DISTINCT l_suppkey) AS s FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL),
met AS (SELECT n.l_orderkey, COALESCE(o.s, []) AS old, n.s AS new FROM new n LEFT JOIN old o USING (l_orderkey)
  WHERE o.at_ IS NULL OR n.at_ >= o.at_)
SELECT l_orderkey, child, op FROM (
  SELECT l_orderkey, UNNEST(list_filter(old, lambda x: NOT list_contains(new, x))) AS child, 'delete' AS op FROM met
  UNION ALL SELECT l_orderkey, UNNEST(list_filter(new, lambda x: NOT list_contains(old, x))), 'insert' FROM met)
"""


QUERIES = {
    "ledger_incremental": (ledger_incremental, LEDGER_INCREMENTAL),
    "run_outcome": (run_outcome, RUN_OUTCOME),
    "ledger_advance": (ledger_advance, LEDGER_ADVANCE),
    "run_metadata": (run_metadata, RUN_METADATA),
    "load_counters": (load_counters, LOAD_COUNTERS),
    "error_history": (error_history, ERROR_HISTORY),
    "board_attribution": (board_attribution, BOARD_ATTRIBUTION),
    "child_delta": (child_delta, CHILD_DELTA),
    "upsert_latest": (upsert_latest, UPSERT_LATEST),
    "snapshot_inactive": (snapshot_inactive, SNAPSHOT_INACTIVE),
}
