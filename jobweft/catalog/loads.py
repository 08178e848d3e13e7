"""The load as a transition of states, its inputs in order, and checks with their rows.

Documents are advertisements. Fifty neighbours of a source are a board, and its
snapshots are built by Spark as the JSON that a board sends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweft.catalog.inputs import TERMS, hits_cte, table
from jobweft.operators.dictionary import AliasDictionary, load_dictionaries
from jobweft.operators.ledger import register_runs, runs_to_process
from jobweft.operators.ordering import run_order as ordered_runs
from jobweft.plans.load import Rules, State, parse_batch, plan_load
from jobweft.plans.quality import check_results
from jobweft.plans.seeds import seed_frame
from jobweft.schemas import ERRORS, LEDGER, POSTINGS, ddl
from jobweft.session import cut_lineage
from jobweft.sources.boards import attribute_runs
from jobweft.sources.bronze import RunFrame, paired_folders
from jobweft.settings import boards_frame


def _snapshots(ads: DataFrame, run_id: str, day: str) -> DataFrame:
    """Runs frame: one snapshot per board of ``ads(board, doc_id, company, job_id, content)``."""
    job = F.to_json(
        F.struct(
            F.col("job_id").alias("id"), F.lit("").alias("title"), F.col("company").alias("company_name"),
            F.col("content"),
        )
    )
    boards = ads.groupBy("board").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", job.alias("job")))).alias("jobs"),
        F.count("*").cast("int").alias("record_count"),
    )
    nothing = F.lit(None).cast("string")
    return boards.select(
        F.lit("greenhouse").alias("adapter_id"), F.lit("greenhouse").alias("source_id"),
        F.concat(F.lit(f"{run_id}/"), "board").alias("run_id"), F.concat(F.lit(f"runs/{run_id}/"), "board").alias("raw_path"),
        F.to_timestamp(F.lit(day)).alias("retrieved_at"), "record_count", nothing.alias("payload_sha256"),
        nothing.alias("context_company"), F.col("board").alias("context_source_key"), nothing.alias("run_error"),
        F.concat(F.lit('{"jobs":['), F.array_join("jobs.job", ","), F.lit("]}")).alias("payload"),
    )


def load_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings, ledger and errors after two loads, from empty tables.

    The first load has every document. The second one lacks those labelled as bad,
    brings changed French texts, whose terms replace the stored ones, and short documents
    without an id, which leave an error row and make their run a partial one.
    """
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    board = F.concat("source", F.lit("_"), F.floor(F.col("doc_id") / 50).cast("string"))
    ads = docs.select(
        board.alias("board"), "doc_id", F.col("source").alias("company"), "quality",
        F.col("doc_id").cast("string").alias("job_id"), F.col("text").alias("content"),
        F.when(F.col("n_chars") >= 300, F.col("doc_id").cast("string")).alias("later_id"),
        F.when(F.col("lang") == "fr", F.replace("text", F.lit("le"), F.lit("und"))).otherwise(F.col("text")).alias("later"),
    )
    second = ads.where(~F.col("quality").eqNullSafe(0)).withColumns(
        {"job_id": F.col("later_id"), "content": F.col("later")}
    )
    dictionaries = load_dictionaries() | {"skills": TERMS, "companies": AliasDictionary("companies", [])}
    rules = Rules(dictionaries=dictionaries, boards=[])
    named = ads.select("board", "company").distinct()
    dimensions = seed_frame(spark, dictionaries, [])
    for kind, name, key in (("sources", "company", "board"), ("companies", "company", None)):
        dimensions = dimensions.unionByName(
            named.select(
                F.lit(kind).alias("dimension"), F.col(name).alias("name"),
                (F.col(key) if key else F.lit(None).cast("string")).alias("source_key"), F.lit(None).cast("smallint").alias("sort_order"),
            ).distinct()
        )
    dimensions = cut_lineage(dimensions)
    empty = [spark.createDataFrame([], ddl(t)) for t in (POSTINGS, LEDGER, ERRORS)]
    state, errors = State(empty[0], empty[1], dimensions), empty[2]
    for number, (rows, run_id, day) in enumerate(((ads, "first", "2026-01-01"), (second, "second", "2026-01-02"))):
        now = F.to_timestamp(F.lit(f"{day} 12:00:00"))
        source = RunFrame(_snapshots(rows, run_id, day))
        todo = runs_to_process(attribute_runs(source.facts(), boards_frame(spark, [])), state.ledger)
        ledger = cut_lineage(register_runs(state.ledger, todo, f"attempt{number}", now).select(*LEDGER))
        batch = parse_batch(source.with_payload(cut_lineage(todo)), rules, dimensions, f"attempt{number}", now)
        changes = plan_load(State(state.postings, ledger, dimensions), batch)
        others = state.postings.join(changes.touched, "source_key", "left_anti").select(*POSTINGS)
        # Both parts are kept already, by this load and the one before.
        state = State(others.unionByName(changes.postings), changes.ledger, dimensions)
        errors = errors.unionByName(changes.errors)

    def shown(frame: DataFrame, kind: str, board: Column, key: str, status: Column, detail: Column) -> DataFrame:
        return frame.select(
            F.lit(kind).alias("kind"), board.alias("board"), F.col(key).alias("key"), status.alias("status"), detail.alias("detail")
        )

    terms = F.concat_ws(" ", F.substring_index("run_id", "/", 1), F.array_join("skill_requirements.name", "|"))
    outcome = F.concat_ws(" ", F.col("processed_records").cast("string"), "error_message")
    return (
        shown(state.postings, "posting", F.col("source_key"), "source_job_id", F.col("status"), terms)
        .unionByName(shown(state.ledger, "run", F.col("source_key"), "run_id", F.col("status"), outcome))
        .unionByName(shown(errors, "error", F.substring_index("run_id", "/", -1), "source_job_id", F.col("stage"), F.col("error_message")))
    )


LOAD_STATE = f"""
WITH d AS (
  SELECT doc_id, source || '_' || (doc_id // 50) AS board, text, quality IS DISTINCT FROM 0 AS again, n_chars >= 300 AS has_id,
    CASE WHEN lang = 'fr' THEN replace(text, 'le', 'und') ELSE text END AS later
  FROM documents LEFT JOIN labels USING (doc_id)),
old_texts AS (SELECT doc_id AS id, chr(10) || text AS body FROM d),
new_texts AS (SELECT doc_id AS id, chr(10) || later AS body FROM d),
{hits_cte("old_hits", "old_texts", TERMS)},
{hits_cte("new_hits", "new_texts", TERMS)},
old_terms AS (SELECT id, string_agg(name, '|' ORDER BY start, name) AS terms
  FROM (SELECT id, name, MIN(start) AS start FROM old_hits GROUP BY id, name) GROUP BY id),
new_terms AS (SELECT id, string_agg(name, '|' ORDER BY start, name) AS terms
  FROM (SELECT id, name, MIN(start) AS start FROM new_hits GROUP BY id, name) GROUP BY id),
runs AS (
  SELECT board, COUNT(*) AS n, COUNT(*) FILTER (WHERE again) AS n2, COUNT(*) FILTER (WHERE again AND has_id) AS good2,
    COUNT(*) FILTER (WHERE again AND NOT has_id) AS bad2 FROM d GROUP BY board),
judged AS (
  SELECT *, CASE WHEN good2 = 0 THEN 'failed' WHEN bad2 > 0 THEN 'partial' ELSE 'processed' END AS status2 FROM runs)
SELECT 'posting' AS kind, board, CAST(doc_id AS VARCHAR) AS key,
  CASE WHEN again AND has_id OR n2 = 0 OR status2 <> 'processed' THEN 'active' ELSE 'inactive' END AS status,
  CASE WHEN again AND has_id THEN 'second ' || COALESCE(b.terms, '') ELSE 'first ' || COALESCE(a.terms, '') END AS detail
FROM d JOIN judged USING (board) LEFT JOIN old_terms a ON a.id = doc_id LEFT JOIN new_terms b ON b.id = doc_id
UNION ALL SELECT 'run', board, 'first/' || board, 'processed', CAST(n AS VARCHAR) FROM judged
UNION ALL SELECT 'run', board, 'second/' || board, status2,
  CASE WHEN status2 = 'failed' THEN '0' ELSE CAST(good2 AS VARCHAR) END
  || CASE WHEN bad2 > 0 THEN repeat(' Greenhouse job has no id;', CAST(least(bad2, 3) AS INTEGER))[:-2] ELSE '' END
FROM judged WHERE n2 > 0
UNION ALL SELECT 'error', board, NULL, 'parse', 'Greenhouse job has no id' FROM d WHERE again AND NOT has_id
"""


def run_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete run folders that are left to do, and the size of their bodies.

    Each document is a folder: short ones lack their response, those of the first
    source their metadata. What is labelled good is done already.
    """
    docs = table(spark, sf_dir, "documents")
    folder = F.concat_ws("/", F.lit("runs"), "lang", F.col("doc_id").cast("string"))
    files = F.array(
        F.when(F.col("source") != "src0", F.concat(folder, F.lit("/metadata.json"))),
        F.when(F.col("n_chars") > 400, F.concat(folder, F.lit("/response.json"))), F.concat(folder, F.lit("/notes.txt")),
    )
    paths = docs.select(F.explode(F.array_compact(files)).alias("path"))
    place = F.split("run_dir", "/")
    runs = paired_folders(paths).select(place[1].alias("source_id"), place[2].alias("run_id"), F.col("run_dir").alias("raw_path"))
    nothing = F.lit(None).cast("string")
    facts = runs.select(
        F.lit("ashby").alias("adapter_id"), "source_id", "run_id", "raw_path", F.lit(None).cast("timestamp").alias("retrieved_at"),
        F.lit(None).cast("int").alias("record_count"),
        *[nothing.alias(c) for c in ("payload_sha256", "context_company", "context_source_key", "run_error")],
    )
    status = F.when(F.col("quality") == 1, "processed").otherwise("failed")
    ledger = docs.join(table(spark, sf_dir, "labels"), "doc_id").select(
        F.col("lang").alias("source_id"), F.col("doc_id").cast("string").alias("run_id"), status.alias("status")
    )
    todo = runs_to_process(facts, ledger)
    bodies = docs.select(F.col("doc_id").cast("string").alias("run_id"), F.col("lang").alias("source_id"), F.col("text").alias("payload"))
    # Only here are bodies read: what is left to do is known.
    return todo.join(bodies, ["source_id", "run_id"]).select("source_id", "run_id", "raw_path", F.octet_length("payload").alias("size"))


RUN_PAIRS = """
SELECT lang AS source_id, CAST(doc_id AS VARCHAR) AS run_id, 'runs/' || lang || '/' || doc_id AS raw_path,
  CAST(strlen(text) AS INTEGER) AS size
FROM documents LEFT JOIN labels USING (doc_id)
WHERE source <> 'src0' AND n_chars > 400 AND quality IS DISTINCT FROM 1
"""


def run_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document's run: sources as the suppliers list them, then by path."""
    runs = table(spark, sf_dir, "documents").select(
        F.col("source").alias("adapter_id"), F.concat_ws("/", "lang", F.col("doc_id").cast("string")).alias("raw_path")
    )
    configured = table(spark, sf_dir, "supplier").groupBy(
        F.concat(F.lit("src"), (F.col("s_nationkey")).cast("string")).alias("adapter_id")
    ).agg(F.min("s_suppkey").alias("source_ord"))
    return ordered_runs(runs, configured)


RUN_ORDER = """
SELECT source AS adapter_id, lang || '/' || doc_id AS raw_path,
  row_number() OVER (ORDER BY ord NULLS LAST, source, lang || '/' || doc_id) - 1 AS ordinal
FROM documents LEFT JOIN (SELECT 'src' || s_nationkey AS source, MIN(s_suppkey) AS ord FROM supplier GROUP BY ALL) USING (source)
"""


def run_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both quality checks, with orders as runs and their lines as postings."""
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    counts = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").cast("int").alias("n"))
    status = F.when(F.col("o_orderstatus") == "F", "processed").when(F.col("o_orderstatus") == "P", "partial").otherwise("failed")
    ledger = orders.join(counts, "o_orderkey", "left").select(
        F.col("o_orderpriority").alias("source_id"), F.col("o_orderkey").cast("string").alias("run_id"), status.alias("status"),
        F.when(F.col("o_totalprice") > 50000, F.col("n")).alias("record_count"),
        (F.coalesce("n", F.lit(0)) - F.when(F.col("o_orderkey") % 97 == 0, 1).otherwise(0)).alias("processed_records"),
    )
    key = F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    postings = lines.select(
        key.alias("posting_key"), F.col("l_linestatus").alias("company"), F.concat_ws("/", "l_partkey", "l_suppkey").alias("fingerprint")
    )
    method = F.when(F.col("l_returnflag") == "R", "guess").otherwise("algorithmic_match")
    links = lines.where(F.col("l_linenumber") < 7).select(
        key.alias("posting_key"), F.col("l_suppkey").cast("string").alias("canonical_id"), method.alias("match_method")
    )
    canonicals = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("canonical_id"))
    tables = {"ledger": ledger, "postings": postings, "links": links, "canonicals": canonicals}
    return check_results(spark, tables)[1]


RUN_CHECKS = """
WITH ledger AS (
  SELECT o_orderpriority AS source_id, o_orderkey AS run_id,
    CASE o_orderstatus WHEN 'F' THEN 'processed' WHEN 'P' THEN 'partial' ELSE 'failed' END AS status,
    CASE WHEN o_totalprice > 50000 THEN n END AS record_count,
    COALESCE(n, 0) - CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS processed
  FROM orders LEFT JOIN (SELECT l_orderkey AS o_orderkey, COUNT(*) AS n FROM lineitem GROUP BY ALL) USING (o_orderkey)),
counts AS (
  SELECT status, COUNT(*) AS runs, COALESCE(SUM(record_count), 0)::BIGINT AS downloaded, COALESCE(SUM(processed), 0)::BIGINT AS processed
  FROM ledger GROUP BY status),
links AS (
  SELECT l_orderkey || '/' || l_linenumber AS k, l_suppkey::VARCHAR AS c, l_returnflag = 'R' AS bad
  FROM lineitem WHERE l_linenumber < 7),
postings AS (
  SELECT l_orderkey || '/' || l_linenumber AS k, l_linestatus AS company, l_partkey || '/' || l_suppkey AS fp FROM lineitem),
issues AS (
  SELECT 'missing_canonical_link' AS issue, (SELECT COUNT(*) FROM postings WHERE k NOT IN (SELECT k FROM links)) AS n
  UNION ALL SELECT 'canonical_without_posting', (SELECT COUNT(*) FROM part WHERE p_partkey::VARCHAR NOT IN (SELECT c FROM links))
  UNION ALL SELECT 'duplicate_fingerprint_across_canonicals',
    (SELECT COUNT(*) FROM (SELECT 1 FROM postings JOIN links USING (k) GROUP BY company, fp HAVING MIN(c) <> MAX(c)))
  UNION ALL SELECT 'invalid_match_method', (SELECT COUNT(*) FROM links WHERE bad))
SELECT '001_processed_run_counts' AS "check", 'report' AS kind, '{"status":"' || status || '","runs":' || runs || ',"downloaded_records":'
  || downloaded || ',"processed_records":' || processed || '}' AS row FROM counts
UNION ALL SELECT '001_processed_run_counts', 'violation', '{"source_id":"' || source_id || '","run_id":"' || run_id || '","record_count":'
  || record_count || ',"processed_records":' || processed || '}'
FROM ledger WHERE status = 'processed' AND record_count <> processed
UNION ALL SELECT '002_canonical_job_integrity', 'report', '{"issue":"' || issue || '","issue_count":' || n || '}' FROM issues
"""


QUERIES = {
    "load_state": (load_state, LOAD_STATE),
    "run_pairs": (run_pairs, RUN_PAIRS),
    "run_order": (run_order, RUN_ORDER),
    "run_checks": (run_checks, RUN_CHECKS),
}
