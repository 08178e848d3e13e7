"""Payload adapters on documents, each document sent as a board snapshot.

The payloads are built by Spark from the documents table and then read by the same
adapters, dictionaries and reports as real snapshots; only the dictionaries hold
words that occur in these texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweft.catalog.inputs import TERMS, TOPICS, hits_cte, table
from jobweft.operators.constraints import check_records, split_quarantine
from jobweft.operators.dictionary import AliasDictionary, load_dictionaries
from jobweft.operators.enrich import enrich_jobs
from jobweft.plans import reports
from jobweft.session import cut_lineage
from jobweft.settings import load_hour_limits
from jobweft.sources.adapters import read_jobs


def _title() -> Column:
    return F.substring_index("text", "\n", 1)


def _dictionaries() -> dict[str, AliasDictionary]:
    used = load_dictionaries()
    return used | {"roles": TOPICS, "skills": TERMS, "companies": AliasDictionary("companies", [])}


def _runs(docs: DataFrame, adapter: str, payload: Column) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return docs.select(
        F.lit(adapter).alias("adapter_id"),
        F.lit(adapter).alias("source_id"),
        F.concat(F.lit("run"), F.col("doc_id").cast("string")).alias("run_id"),
        F.concat(F.lit("runs/"), F.col("doc_id").cast("string")).alias("raw_path"),
        F.to_timestamp(F.lit("2026-01-01")).alias("retrieved_at"),
        F.lit(1).alias("record_count"),
        nothing.alias("payload_sha256"),
        F.lit("Default Company").alias("context_company"),
        nothing.alias("context_source_key"),
        nothing.alias("run_error"),
        payload.alias("payload"),
        F.col("source").alias("source_key"),
    )


def _shown(records: DataFrame) -> DataFrame:
    option = F.try_element_at("employment_options", F.lit(1))
    return records.select(
        "run_id", "source_key", "source_job_id", "company_name", "role_name", "source_url",
        F.array_join("skill_requirements.name", "|").alias("skills"),
        F.array_join("locations", "|").alias("locations"),
        F.array_join("work_modes", "|").alias("work_modes"),
        option["employment_relation_name"].alias("relation"),
        option["workload_name"].alias("workload"),
        F.unix_seconds("source_published_at").alias("published"),
        F.col("compensation.salary_min").cast("double").alias("salary_min"),
        F.col("compensation.salary_max").cast("double").alias("salary_max"),
        F.col("compensation.salary_currency").alias("salary_currency"),
        F.col("compensation.salary_period").alias("salary_period"),
        "content_fingerprint",
        F.col("error.error_message").alias("error"),
    )


def _read(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    jobs, checked = read_jobs(runs)
    return enrich_jobs(jobs, _dictionaries(), load_hour_limits()), checked


def _object_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    is_fr, is_de, is_en = (F.col("lang") == lang for lang in ("fr", "de", "en"))
    mode = F.when(is_fr, F.array(F.lit("Hybrid"), F.lit("On site"))).otherwise(F.array(F.lit("?")))
    text = F.struct(
        F.struct(
            F.when(F.col("n_chars") > 100, F.col("doc_id")).alias("id"),
            _title().alias("title"),
            F.when(~is_de, F.concat(F.lit(" "), F.col("source"))).alias("company_name"),
            F.struct(F.when(is_en, "Prague, Czechia or Brno").when(is_de, "Ostrava - Praha").alias("name")).alias("location"),
            F.array(F.struct(F.when(is_fr, "Office: Brno, CZ").alias("location"))).alias("offices"),
            F.concat(F.lit(" https://x/"), F.col("doc_id").cast("string")).alias("absolute_url"),
            F.lit("2026-01-02T03:04:05+01:00").alias("first_published"),
            F.when(F.col("n_chars") % 2 == 0, "yesterday").alias("updated_at"),
            F.array(F.struct(F.lit("Location Type:").alias("name"), mode.alias("value"))).alias("metadata"),
            F.col("text").alias("content"),
        ).alias("job")
    )
    payload = F.concat(F.lit('{"jobs":['), F.to_json(text["job"]), F.lit("]}"))
    return _runs(docs, "greenhouse", payload)


def adapter_object_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, _ = _read(_object_runs(spark, sf_dir))
    return _shown(records)


_FINGERPRINT = "sha256(replace(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 'ß', 'ss'))"
_SEARCHED = f"""
titles AS (SELECT doc_id AS id, string_split(text, chr(10))[1] AS body FROM documents),
texts AS (SELECT doc_id AS id, string_split(text, chr(10))[1] || chr(10) || text AS body FROM documents),
{hits_cte("in_title", "titles", TOPICS)},
{hits_cte("in_text", "texts", TOPICS)},
{hits_cte("skill_hits", "texts", TERMS)},
t AS (SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY start, width DESC, name) AS n FROM in_title),
b AS (SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY start, width DESC, name) AS n FROM in_text),
s AS (SELECT id, string_agg(name, '|' ORDER BY start, name) AS skills
      FROM (SELECT id, name, MIN(start) AS start FROM skill_hits GROUP BY id, name) GROUP BY id),
d AS (SELECT doc_id, text, lang, source, n_chars, COALESCE(t.name, b.name) AS role_name, COALESCE(skills, '') AS skills,
        'run' || doc_id AS run_id
      FROM documents LEFT JOIN t ON t.id = doc_id AND t.n = 1 LEFT JOIN b ON b.id = doc_id AND b.n = 1
      LEFT JOIN s ON s.id = doc_id)"""

ADAPTER_OBJECT_BOARD = f"""
WITH {_SEARCHED}
SELECT run_id, source AS source_key, CASE WHEN n_chars > 100 THEN CAST(doc_id AS VARCHAR) END AS source_job_id,
  CASE WHEN lang = 'de' THEN 'Default Company' ELSE source END AS company_name, role_name,
  'https://x/' || doc_id AS source_url, skills,
  CASE lang WHEN 'en' THEN 'Prague, Czechia|Brno, Czechia' WHEN 'de' THEN 'Ostrava, Czechia|Prague, Czechia'
    WHEN 'fr' THEN 'Brno, Czechia' ELSE '' END AS locations,
  CASE WHEN lang = 'fr' THEN 'Hybrid|On-site' ELSE '' END AS work_modes,
  CAST(NULL AS VARCHAR) AS relation, CAST(NULL AS VARCHAR) AS workload,
  CAST(epoch(TIMESTAMP '2026-01-02 02:04:05') AS BIGINT) AS published,
  CAST(NULL AS DOUBLE) AS salary_min, CAST(NULL AS DOUBLE) AS salary_max, CAST(NULL AS VARCHAR) AS salary_currency,
  CAST(NULL AS VARCHAR) AS salary_period, CASE WHEN text <> '' THEN {_FINGERPRINT} END AS content_fingerprint,
  CASE WHEN n_chars <= 100 THEN 'Greenhouse job has no id'
    WHEN n_chars % 2 = 0 THEN 'Invalid isoformat string: ''yesterday''' END AS error
FROM d
"""


def _list_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    is_en = F.col("lang") == "en"
    job = F.struct(
        F.when(F.col("n_chars") > 100, F.concat(F.lit(" L"), F.col("doc_id").cast("string"))).alias("id"),
        F.concat(F.lit("https://l/"), F.col("doc_id").cast("string")).alias("hostedUrl"),
        F.concat(_title(), F.lit("  ")).alias("text"),
        F.struct(
            F.when(is_en, "Praha").alias("location"),
            F.array(F.lit("Brno"), F.lit("Prague")).alias("allLocations"),
            F.struct(F.lit("Full-time").alias("b"), F.lit("Contractor").alias("a")).alias("commitment"),
            F.lit(None).cast("string").alias("team"),
            F.lit("remote").alias("workplaceType"),
        ).alias("categories"),
        F.lit("").alias("descriptionPlain"),
        F.array(F.col("text")).alias("description"),
        (F.col("doc_id") + 1_700_000_000).alias("createdAt"),
        F.struct().alias("salaryRange"),
        F.struct(
            F.col("n_chars").alias("min"),
            F.when(F.col("n_chars") % 3 == 0, "lots").otherwise((F.col("n_chars") + 1).cast("string")).alias("max"),
            F.lit("czk ").alias("currency"),
            F.lit("annually").alias("interval"),
        ).alias("salary_range"),
    )
    text = F.to_json(job)
    payload = (
        F.when(is_en, F.concat(F.lit("["), text, F.lit("]")))
        .when(F.col("lang") == "fr", F.concat(F.lit('{"data":[],"postings":['), text, F.lit("]}")))
        .when(F.col("lang") == "de", F.concat(F.lit('{"data":['), text, F.lit(",7]}")))
        .otherwise(F.concat(F.lit('{"jobs":['), text, F.lit("]}")))
    )
    return _runs(docs, "lever", payload)


def adapter_list_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, _ = _read(_list_runs(spark, sf_dir))
    return _shown(records)


ADAPTER_LIST_BOARD = f"""
WITH {_SEARCHED}
SELECT run_id, source AS source_key,
  CASE WHEN n_chars > 100 THEN 'L' || doc_id ELSE 'https://l/' || doc_id END AS source_job_id,
  'Default Company' AS company_name, role_name, 'https://l/' || doc_id AS source_url, skills,
  CASE WHEN lang = 'en' THEN 'Prague, Czechia|Brno, Czechia' ELSE 'Brno, Czechia|Prague, Czechia' END AS locations,
  'Remote' AS work_modes, 'Self-employed' AS relation, 'Full-time' AS workload,
  CAST(1700000000 + doc_id AS BIGINT) AS published,
  CAST(n_chars AS DOUBLE) AS salary_min, CASE WHEN n_chars % 3 <> 0 THEN CAST(n_chars + 1 AS DOUBLE) END AS salary_max,
  'CZK' AS salary_currency, 'year' AS salary_period, CASE WHEN text <> '' THEN {_FINGERPRINT} END AS content_fingerprint,
  CASE WHEN n_chars % 3 = 0 THEN 'Salary is not a number' END AS error
FROM d WHERE lang <> 'de'
"""


def _flagged_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    job = F.struct(
        F.col("doc_id").alias("id"),
        _title().alias("title"),
        F.col("source").alias("company"),
        F.lit("Remote").alias("location"),
        F.array(F.struct(F.lit("Brno").alias("location"), F.lit("x").alias("z"))).alias("secondaryLocations"),
        (F.col("n_chars") > 1000).alias("isRemote"),
        F.when(F.col("lang") == "en", "Hybrid").alias("workplaceType"),
        F.lit("Part time, HPP").alias("employmentType"),
        F.col("text").alias("descriptionPlain"),
        F.when(F.col("n_chars") > 500, F.lit("20260102")).alias("publishedAt"),
        F.struct(
            F.struct(
                F.lit(0).alias("minValue"), (F.col("n_chars") / 8).alias("min"),
                F.when(F.col("n_chars") > 700, F.lit(50.0)).alias("maxValue"),
                F.when(F.col("lang") == "fr", "EURO").alias("currency"),
                F.lit("1 HOUR").alias("salaryType"),
            ).alias("range")
        ).alias("compensation"),
    )
    return _runs(docs, "ashby", F.concat(F.lit('{"jobs":['), F.to_json(job), F.lit("]}")))


def adapter_flagged_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records after the checks of the silver tables."""
    runs = _flagged_runs(spark, sf_dir)
    records, _ = _read(runs)
    known = table(spark, sf_dir, "documents").select("source").distinct()
    sources = known.select(F.col("source").alias("source_key"))
    companies = known.where(F.col("source") != "src1").select(F.col("source").alias("name"))
    return _shown(check_records(records, sources, companies))


ADAPTER_FLAGGED_BOARD = f"""
WITH {_SEARCHED}, c AS (SELECT *, CAST(n_chars / 8.0 AS DECIMAL(12,2)) AS lo, CASE WHEN n_chars > 700 THEN 50.0 END AS hi FROM d)
SELECT run_id, source AS source_key, CAST(doc_id AS VARCHAR) AS source_job_id, source AS company_name, role_name,
  CAST(NULL AS VARCHAR) AS source_url, skills, 'Brno, Czechia' AS locations,
  CASE WHEN lang = 'en' AND n_chars > 1000 THEN 'Hybrid|Remote' WHEN lang = 'en' THEN 'Hybrid'
    WHEN n_chars > 1000 THEN 'Remote' ELSE '' END AS work_modes,
  'Employee' AS relation, 'Part-time' AS workload,
  CASE WHEN n_chars > 500 THEN CAST(epoch(TIMESTAMP '2026-01-02') AS BIGINT) END AS published,
  CAST(lo AS DOUBLE) AS salary_min, CAST(hi AS DOUBLE) AS salary_max,
  CASE WHEN lang = 'fr' THEN 'EURO' END AS salary_currency, 'hour' AS salary_period,
  CASE WHEN text <> '' THEN {_FINGERPRINT} END AS content_fingerprint,
  CASE WHEN source = 'src1' THEN 'Unknown reference value in companies: src1'
    WHEN hi < lo THEN 'violates check salary_range_ordered'
    WHEN lang = 'fr' THEN 'violates check salary_currency_format' END AS error
FROM c
"""


def payload_run_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs whose payload is not what their adapter expects: whole texts in wrong places."""
    docs = table(spark, sf_dir, "documents")
    job = F.to_json(F.struct(F.col("text").alias("content")))
    payload = (
        F.when(F.col("lang") == "en", F.concat(F.lit('{"jobs":['), job, F.lit(",2]}")))
        .when(F.col("lang") == "fr", F.concat(F.lit('{"jobs":'), job, F.lit("}")))
        .when(F.col("lang") == "de", F.concat(F.lit("["), job, F.lit("]")))
        .otherwise(F.col("text"))
    )
    runs = _runs(docs, "greenhouse", payload)
    for adapter in ("lever", "ashby"):
        runs = runs.unionByName(_runs(docs, adapter, payload))
    _, checked = read_jobs(runs)
    return checked.select("adapter_id", "run_id", "run_error")


PAYLOAD_RUN_ERRORS = """
SELECT a.adapter_id, 'run' || doc_id AS run_id, CASE
  WHEN a.adapter_id = 'greenhouse' AND lang <> 'en' THEN 'Greenhouse response has no jobs array: runs/' || doc_id
  WHEN a.adapter_id = 'ashby' THEN 'Ashby response has no jobs array: runs/' || doc_id
  WHEN a.adapter_id = 'lever' AND lang <> 'de' THEN 'Lever response has no postings array' END AS run_error
FROM documents, (VALUES ('greenhouse'), ('lever'), ('ashby')) AS a(adapter_id)
"""


def silver_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports over accepted postings of all three boards, stacked."""
    runs = _object_runs(spark, sf_dir)
    runs = runs.unionByName(_list_runs(spark, sf_dir)).unionByName(_flagged_runs(spark, sf_dir))
    records, _ = _read(runs)
    # Five reports read the postings, so they are parsed once and kept, as the
    # silver tables keep them. They are kept with their errors, as the load does: a
    # filter on errors would be moved before the parse, with every step in it again
    # for each of its uses.
    good, _ = split_quarantine(
        cut_lineage(
            records.select(
                "source_id", "run_id", "pos", "company_name", "role_name", "skill_requirements",
                "work_modes", "locations", "error",
            )
        )
    )
    postings = good.withColumn("status", F.when(F.col("source_id") == "ashby", "inactive").otherwise("active"))
    made = {
        "company": reports.active_by_company(postings),
        "role": reports.active_by_role(postings),
        "skill": reports.top_skills(postings),
        "work_mode": reports.active_by_work_mode(postings),
        "location": reports.active_by_location(postings),
    }
    stacked = None
    for name, frame in made.items():
        rows = frame.select(
            F.lit(name).alias("report"), F.col(frame.columns[0]).alias("value"), "active_postings"
        )
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return stacked


SILVER_REPORTS = f"""
WITH {_SEARCHED}, p AS (
  SELECT doc_id, role_name, skills, CASE WHEN lang = 'de' THEN 'Default Company' ELSE source END AS company,
    CASE lang WHEN 'en' THEN 'Prague, Czechia|Brno, Czechia' WHEN 'de' THEN 'Ostrava, Czechia|Prague, Czechia'
      WHEN 'fr' THEN 'Brno, Czechia' ELSE '' END AS locations,
    CASE WHEN lang = 'fr' THEN 'Hybrid|On-site' ELSE '' END AS modes
  FROM d WHERE n_chars > 100 AND n_chars % 2 <> 0
  UNION ALL
  SELECT doc_id, role_name, skills, 'Default Company', 'Brno, Czechia|Prague, Czechia', 'Remote'
  FROM d WHERE lang <> 'de' AND n_chars % 3 <> 0
)
SELECT 'company' AS report, company AS value, COUNT(*) AS active_postings FROM p GROUP BY company
UNION ALL SELECT 'role', COALESCE(role_name, '[unknown role]'), COUNT(*) FROM p GROUP BY role_name
UNION ALL SELECT 'skill', v, COUNT(*) FROM (SELECT UNNEST(string_split(skills, '|')) AS v FROM p WHERE skills <> '') GROUP BY v
UNION ALL SELECT 'work_mode', v, COUNT(*) FROM (SELECT UNNEST(string_split(modes, '|')) AS v FROM p WHERE modes <> '') GROUP BY v
UNION ALL SELECT 'location', v, COUNT(*) FROM (SELECT UNNEST(string_split(locations, '|')) AS v FROM p WHERE locations <> '') GROUP BY v
"""


QUERIES = {
    "adapter_object_board": (adapter_object_board, ADAPTER_OBJECT_BOARD),
    "adapter_list_board": (adapter_list_board, ADAPTER_LIST_BOARD),
    "adapter_flagged_board": (adapter_flagged_board, ADAPTER_FLAGGED_BOARD),
    "payload_run_errors": (payload_run_errors, PAYLOAD_RUN_ERRORS),
    "silver_reports": (silver_reports, SILVER_REPORTS),
}
