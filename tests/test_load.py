"""The incremental load over bronze files, run by run and as a stream."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobweft.plans.load import Rules, load_runs
from jobweft.plans.quality import run_checks
from jobweft.plans.reports import (
    active_by_company,
    active_by_location,
    active_by_role,
    active_by_source,
    active_by_work_mode,
    posting_compensations,
    posting_detail,
    posting_employment_options,
    posting_skills,
    top_skills,
)
from jobweft.settings import boards_frame, load_boards
from jobweft.sources.bronze import RunFiles, RunTable, discover_runs, read_bronze, read_run_files, write_bronze
from jobweft.sources.silver import SilverTables
from jobweft.streaming.bronze_stream import stream_loads


def put_run(root, day, run_id, source_id, payload, *, at, count="auto", company=None, **extra):
    folder = Path(root) / day / run_id
    folder.mkdir(parents=True)
    text = payload if isinstance(payload, str) else json.dumps(payload, ensure_ascii=False)
    (folder / "response.json").write_text(text, encoding="utf-8")
    jobs = payload.get("jobs") if isinstance(payload, dict) else payload
    meta = {
        "run_id": run_id,
        "source_id": source_id,
        "retrieved_at": at,
        "record_count": len(jobs) if count == "auto" else count,
        "context": {"company": company},
        **extra,
    }
    (folder / "metadata.json").write_text(json.dumps(meta), encoding="utf-8")


def job(number, title="Senior BI Developer", content="Airflow runs our nightly dbt models on Redis.", **more):
    return {
        "id": number,
        "title": title,
        "company_name": "Mews",
        "location": {"name": "Prague, Czechia"},
        "content": content,
        "absolute_url": f"https://jobs.example/{number}",
        **more,
    }


def load(spark, bronze, silver, adapter="greenhouse", **options):
    tables = SilverTables(spark, str(silver))
    summary = load_runs(spark, RunFiles(spark, str(bronze), adapter), tables, **options)
    return tables, summary.first().asDict()


def status_of(tables):
    return {r.source_job_id: r.status for r in tables.postings().collect()}


def test_load_lifecycle(spark, tmp_path):
    bronze, silver = tmp_path / "bronze", tmp_path / "silver"
    put_run(
        bronze, "2026-01-01", "run1", "greenhouse_mews",
        {"jobs": [job(1), job(2, "Data Analyst", "Plain text"), job(3, "Platform Engineer", "Plain text")]},
        at="2026-01-01T10:00:00Z",
    )
    tables, summary = load(spark, bronze, silver)
    assert summary == {
        "discovered": 1, "processed": 1, "partial": 0, "skipped": 0, "failed": 0, "records": 3, "exit_code": 0, "rejected": 0,
    }
    assert status_of(tables) == {"1": "active", "2": "active", "3": "active"}
    first = {r.source_job_id: r for r in tables.postings().collect()}
    # Jobs 2 and 3 have the same text, hence one canonical.
    assert first["3"].canonical_id == first["2"].posting_key
    assert first["3"].match_method == "algorithmic_match"
    assert first["1"].match_method == "new_canonical_job"

    # A second complete snapshot without job 2, and a partial one with a bad record.
    put_run(
        bronze, "2026-01-02", "run2", "greenhouse_mews", {"jobs": [job(1, content="Now Scala."), job(3)]},
        at="2026-01-02T10:00:00Z",
    )
    tables, summary = load(spark, bronze, silver)
    assert (summary["skipped"], summary["processed"], summary["records"]) == (1, 1, 2)
    assert status_of(tables) == {"1": "active", "2": "inactive", "3": "active"}
    second = {r.source_job_id: r for r in tables.postings().collect()}
    assert second["1"].created_at == first["1"].created_at
    assert second["1"].canonical_id == first["1"].canonical_id
    assert [s.name for s in second["1"].skill_requirements] == ["Scala"]
    assert second["1"].source_published_at is None

    put_run(
        bronze, "2026-01-03", "run3", "greenhouse_mews",
        {"jobs": [job(2), {"title": "no id"}, job(9, content="200 hours per week")]},
        at="2026-01-03T10:00:00Z",
    )
    put_run(bronze, "2026-01-03", "run4", "greenhouse_mews", {"jobs": []}, at="2026-01-04T10:00:00Z")
    put_run(bronze, "2026-01-03", "run5", "greenhouse_mews", "{broken", at="2026-01-04T11:00:00Z", count=4)
    put_run(bronze, "2026-01-03", "run6", "other_source", {"jobs": [job(1)]}, at="2026-01-04T11:00:00Z")
    tables, summary = load(spark, bronze, silver)
    assert (summary["partial"], summary["failed"], summary["exit_code"]) == (1, 3, 1)
    # Partial and empty runs deactivate nothing; job 2 is back.
    assert status_of(tables) == {"1": "active", "2": "active", "3": "active"}
    ledger = {r.run_id: r for r in tables.ledger().collect()}
    assert (ledger["run3"].status, ledger["run3"].processed_records) == ("partial", 1)
    assert ledger["run3"].error_message == (
        "Greenhouse job has no id; Hours minimum exceeds the configured week limit: 200 > 168"
    )
    assert ledger["run4"].error_message == "No records were processed"
    assert ledger["run5"].error_message.startswith("Greenhouse response has no jobs array: ")
    assert ledger["run6"].error_message == (
        "Raw run source mismatch: adapter=greenhouse, metadata=other_source"
    )
    assert tables.errors().count() == 2

    # Replaying skips finished runs and tries failed ones again; state stays.
    before = sorted(tables.postings().drop("updated_at").collect())
    tables, summary = load(spark, bronze, silver)
    assert (summary["skipped"], summary["failed"]) == (3, 3)
    assert sorted(tables.postings().drop("updated_at").collect()) == before
    checks = {r.check: r.passed for r in run_checks(spark, tables.quality_tables()).collect()}
    assert checks == {"001_processed_run_counts": True, "002_canonical_job_integrity": True}

    # An older run that arrives late changes neither content nor status.
    put_run(
        bronze, "2025-12-31", "run0", "greenhouse_mews", {"jobs": [job(1, content="Old Java text"), job(7)]},
        at="2025-12-31T10:00:00Z",
    )
    tables, summary = load(spark, bronze, silver, retry_partial=True)
    assert (summary["processed"], summary["partial"]) == (1, 1)
    third = {r.source_job_id: r for r in tables.postings().collect()}
    assert [s.name for s in third["1"].skill_requirements] == ["Scala"]
    assert {k: r.status for k, r in third.items()} == {
        "1": "active", "2": "active", "3": "active", "7": "inactive",
    }
    assert tables.errors().count() == 4


def test_reports_over_three_adapters(spark, tmp_path):
    silver = tmp_path / "silver"
    put_run(
        tmp_path / "gh", "2026-01-01", "a", "greenhouse_mews",
        {"jobs": [job(1, metadata=[
            {"name": "Employment type", "value": "Employee - Fixed term"},
            {"name": "Location type:", "value": ["Hybrid"]}],
            content="You keep Kafka, dbt and Redis going, 12-18 hours per week.")]},
        at="2026-01-01T10:00:00Z",
    )
    put_run(
        tmp_path / "lv", "2026-01-01", "b", "lever", [{
            "id": "post-71", "text": "Senior BI Developer",
            "categories": {"location": "Prague, Czechia", "commitment": "Full-time", "workplaceType": "Hybrid"},
            "descriptionPlain": "Dashboards over dbt models, fed by Kafka.", "createdAt": 1700000000000,
            "salaryRange": {"min": 1000, "max": "2000.505", "currency": "eur", "interval": "per-month"},
        }, {"id": "post-72", "text": "Nobody", "company": "Unheard Of", "descriptionPlain": "x"},
            {"id": "post-73", "text": "Bad pay", "salaryRange": {"min": 5, "max": 1}},
            {"id": "post-74", "text": "Bad pay", "salaryRange": {"min": "five"}}],
        at="2026-01-01T11:00:00Z", company="Ataccama",
    )
    put_run(
        tmp_path / "as", "2026-01-01", "c", "ashby_apify",
        {"jobs": [{"id": "u-5", "title": "Data Scientist", "location": "Remote", "isRemote": True,
                   "employmentType": "Full-time", "descriptionPlain": "Machine learning with NumPy, served by Kafka."}]},
        at="2026-01-01T12:00:00Z", company="Apify",
    )
    runs = read_run_files(spark, str(tmp_path / "gh"), "greenhouse")
    runs = runs.unionByName(read_run_files(spark, str(tmp_path / "lv"), "lever"))
    runs = runs.unionByName(read_run_files(spark, str(tmp_path / "as"), "ashby"))
    tables = SilverTables(spark, str(silver))
    summary = load_runs(spark, runs, tables).first()
    assert (summary.processed, summary.partial, summary.records) == (2, 1, 3)
    messages = {r.source_job_id: r.error_message for r in tables.errors().collect()}
    assert messages == {
        "post-72": "Unknown reference value in companies: Unheard Of",
        "post-73": "violates check salary_range_ordered",
        "post-74": "Salary is not a number",
    }
    postings = tables.postings()
    sources = boards_frame(spark, load_boards()).select("source_key", F.col("company").alias("name"))

    def rows(frame):
        return [tuple(r) for r in frame.collect()]

    assert rows(active_by_company(postings)) == [("Apify", 1), ("Ataccama", 1), ("Mews", 1)]
    assert rows(active_by_role(postings)) == [("BI Developer", 2), ("Data Scientist", 1)]
    assert rows(top_skills(postings))[:2] == [("Apache Kafka", 3), ("dbt", 2)]
    assert rows(active_by_work_mode(postings)) == [("Hybrid", 2), ("Remote", 1)]
    assert rows(active_by_location(postings)) == [("Prague, Czechia", 2)]
    assert rows(active_by_source(postings, sources)) == [("Apify", 1), ("Ataccama", 1), ("Mews", 1)]
    detail = {r.source_job_id: r for r in posting_detail(postings, sources).collect()}
    assert len(detail["1"].asDict()) == 20
    assert json.loads(detail["1"].employment_options) == [
        {"employment_relation": "Employee", "workload": None, "hours_min": 12.0, "hours_max": 18.0, "hours_period": "week"}
    ]
    assert json.loads(detail["1"].skills)[0] == {
        "skill": "Apache Kafka", "proficiency": None, "requirement_type": None, "priority": None,
    }
    pay = detail["post-71"]
    assert (str(pay.salary_min), str(pay.salary_max), pay.salary_currency, pay.salary_period) == (
        "1000.00", "2000.51", "EUR", "month",
    )
    assert posting_skills(postings).where("name = 'Machine Learning'").count() == 1
    assert posting_compensations(postings).count() == 1
    assert posting_employment_options(postings).count() == 3


def test_stream_equals_batch(spark, tmp_path):
    bronze = tmp_path / "bronze"
    for day, numbers in (("2026-02-01", [1, 2]), ("2026-02-02", [2, 3])):
        put_run(
            bronze, day, f"run-{day}", "greenhouse_mews",
            {"jobs": [job(n, content=f"text {n}") for n in numbers]}, at=f"{day}T10:00:00Z",
        )
    for _ in range(2):  # the second start finds nothing new
        stream_loads(
            spark, str(bronze), "greenhouse", str(tmp_path / "streamed"), str(tmp_path / "checkpoint")
        ).awaitTermination()
    batch, _ = load(spark, bronze, tmp_path / "batch")
    streamed = SilverTables(spark, str(tmp_path / "streamed"))
    columns = ["source_job_id", "status", "content_fingerprint", "canonical_id", "last_seen_at"]
    assert sorted(streamed.postings().select(columns).collect()) == sorted(
        batch.postings().select(columns).collect()
    )
    assert {r.status for r in streamed.ledger().collect()} == {"processed"}


def test_stream_takes_up_what_failed(spark, tmp_path):
    """A broken run is repaired and a partial one is read again; no new file arrives for either."""
    bronze, silver = tmp_path / "bronze", str(tmp_path / "silver")
    put_run(bronze, "d1", "r1", "greenhouse_mews", "{broken", at="2026-02-01", count=1)
    put_run(bronze, "d1", "r2", "greenhouse_mews", {"jobs": [job(2), {"title": "no id"}]}, at="2026-02-02")

    def start(**options):
        stream_loads(spark, str(bronze), "greenhouse", silver, str(tmp_path / "checkpoint"), **options).awaitTermination()
        return {r.run_id: r.status for r in SilverTables(spark, silver).ledger().collect()}

    assert start() == {"r1": "failed", "r2": "partial"}
    (bronze / "d1" / "r1" / "response.json").write_text(json.dumps({"jobs": [job(1)]}))
    (bronze / "d1" / "r2" / "response.json").write_text(json.dumps({"jobs": [job(2), job(3)]}))
    assert start() == {"r1": "processed", "r2": "partial"}
    assert start(retry_partial=True) == {"r1": "processed", "r2": "processed"}
    assert sorted(status_of(SilverTables(spark, silver))) == ["1", "2", "3"]


def test_landing_keeps_the_request(spark, tmp_path):
    rows = spark.createDataFrame(
        [("b", "C", "[]", "https://x/jobs", "post", {"page": "1"}, 200, "application/json", {"company": "wrong", "trace": "t"})],
        "source_key string, company string, payload string, endpoint string, method string, request_params map<string,string>, "
        "http_status int, content_type string, context map<string,string>",
    )
    write_bronze(rows, str(tmp_path / "b"), "lever")
    write_bronze(rows.select("source_key", "company", "payload"), str(tmp_path / "b"), "lever")
    full, bare = spark.read.parquet(str(tmp_path / "b")).orderBy(F.desc_nulls_last("endpoint")).collect()
    assert (full.endpoint, full.method, full.request_params, full.http_status, full.content_type) == (
        "https://x/jobs", "POST", {"page": "1"}, 200, "application/json",
    )
    assert full.context == {"company": "C", "source_key": "b", "trace": "t"}
    assert (bare.endpoint, bare.method, bare.http_status, bare.context) == (None, "GET", None, {"company": "C", "source_key": "b"})


def test_bronze_table_round_trip(spark, tmp_path):
    body = '{"jobs":[]}'
    snapshots = spark.createDataFrame(
        [("greenhouse_mews", "Mews", body)], "source_key string, company string, payload string"
    )
    path = str(tmp_path / "bronze")
    write_bronze(snapshots, path, "greenhouse")
    stored = spark.read.parquet(path).first()
    assert stored.payload == body
    assert stored.payload_size_bytes == 11
    assert stored.record_count == 0
    assert stored.payload_sha256 == (
        spark.range(1).select(F.sha2(F.lit(body), 256)).first()[0]
    )
    run = read_bronze(spark, path).first()
    assert (run.adapter_id, run.source_id, run.context_company, run.payload) == (
        "greenhouse", "greenhouse_mews", "Mews", body,
    )


def test_discovery_needs_both_files(spark, tmp_path):
    put_run(tmp_path, "2026-01-01", "whole", "greenhouse_mews", {"jobs": []}, at=None)
    (tmp_path / "2026-01-01" / "half").mkdir()
    (tmp_path / "2026-01-01" / "half" / "metadata.json").write_text("{}")
    found = [r.run_dir for r in discover_runs(spark, str(tmp_path)).collect()]
    assert [f.rsplit("/", 1)[1] for f in found] == ["whole"]


@pytest.mark.parametrize(
    ("meta", "problem"),
    [
        ("[1]", "Metadata must be a JSON object"),
        ('{"run_id": " ", "source_id": "s"}', "Metadata field is missing: run_id"),
        ('{"run_id": "r"}', "Metadata field is missing: source_id"),
        ('{"run_id": "r", "source_id": "s", "record_count": "x"}', "Metadata field is no number: record_count"),
        ('{"run_id": "r", "source_id": "s", "retrieved_at": "soon"}', "Invalid isoformat string: 'soon'"),
        ('{"run_id": "r", "source_id": "s", "record_count": "7"}', None),
    ],
)
def test_metadata_problems(spark, tmp_path, meta, problem):
    folder = tmp_path / "d" / "r"
    folder.mkdir(parents=True)
    (folder / "response.json").write_text("[]")
    (folder / "metadata.json").write_text(meta)
    assert read_run_files(spark, str(tmp_path), "lever").first().run_error == problem


def test_unseeded_name_is_quarantined(spark, tmp_path):
    rules = Rules()
    put_run(tmp_path / "b", "2026-01-01", "a", "greenhouse_mews", {"jobs": [job(1), job(2, "Cook")]}, at="2026-01-01")
    from jobweft.plans import load as module

    seeded = module.missing_dimensions(spark, rules, SilverTables(spark, str(tmp_path / "s")).dimensions())
    seeded = seeded.where("name <> 'BI Developer'")
    runs = module.attribute_runs(
        read_run_files(spark, str(tmp_path / "b"), "greenhouse"), boards_frame(spark, rules.boards)
    )
    good, bad, _ = module.parse_runs(runs, rules, seeded)
    assert [r.source_job_id for r in good.collect()] == ["2"]
    assert bad.first().error_message == "Unknown reference value in roles: BI Developer"


def rejected_and_odd_runs(bronze):
    put_run(bronze, "d1", "r4", "greenhouse_mews", {"jobs": [job(5)]}, at=None, count=-1)
    put_run(bronze, "d1", "r1", "greenhouse", {"jobs": [job(1), job(2)]}, at=None, company="  Mews ")
    put_run(bronze, "d2", "r1", "greenhouse", {"jobs": [job(1), job(2)]}, at=None, company="Mews")
    put_run(bronze, "d1", "r2", "greenhouse", {"jobs": [job(3)]}, at=None)
    (bronze / "d1" / "r2" / "metadata.json").write_text("{broken")
    put_run(bronze, "d1", "r3", "greenhouse_mews", {"jobs": [job(4)]}, at=None)
    (bronze / "d1" / "r3" / "metadata.json").write_text('{"source_id": "greenhouse_mews"}')


def test_runs_that_cannot_be_keyed_are_rejected_and_second_folders_ignored(spark, tmp_path):
    rejected_and_odd_runs(tmp_path / "b")
    tables, summary = load(spark, tmp_path / "b", tmp_path / "s")
    assert (summary["discovered"], summary["processed"], summary["rejected"], summary["exit_code"]) == (5, 1, 4, 1)
    (run,) = tables.ledger().collect()
    assert (run.source_key, run.status, run.processed_records) == ("greenhouse_mews", "processed", 2)
    messages = sorted(r.error_message.split("/b/")[1] for r in tables.errors().collect())
    assert messages == [
        "d1/r2: Metadata must be a JSON object", "d1/r3: Metadata field is missing: run_id",
        "d1/r4: violates check record_count_not_negative", "d2/r1: The same run was found in another folder",
    ]


def test_complete_snapshots_without_time_deactivate_what_they_lack(spark, tmp_path):
    put_run(tmp_path / "b", "d1", "r1", "greenhouse_mews", {"jobs": [job(1), job(2)]}, at=None)
    load(spark, tmp_path / "b", tmp_path / "s")
    put_run(tmp_path / "b", "d2", "r2", "greenhouse_mews", {"jobs": [job(1)]}, at=None)
    tables, _ = load(spark, tmp_path / "b", tmp_path / "s")
    assert status_of(tables) == {"1": "active", "2": "inactive"}


@pytest.mark.parametrize("broken", ["write_postings", "write_whole", "write_errors", "commit"])
def test_a_load_that_died_is_repeated_without_doubles(spark, tmp_path, monkeypatch, broken):
    put_run(tmp_path / "b", "d1", "r1", "greenhouse_mews", {"jobs": [job(1), {"title": "no id"}]}, at="2026-01-01")
    original = getattr(SilverTables, broken)

    def die(self, *args):
        if broken != "commit":
            original(self, *args)
        raise OSError("lost")

    monkeypatch.setattr(SilverTables, broken, die)
    with pytest.raises(OSError, match="lost"):
        load(spark, tmp_path / "b", tmp_path / "s")
    monkeypatch.undo()
    after = SilverTables(spark, str(tmp_path / "s"))
    assert [after.postings().count(), after.errors().count()] == [0, 0]
    assert {r.status for r in after.ledger().collect()} <= {"processing"}
    tables, _ = load(spark, tmp_path / "b", tmp_path / "s")
    assert [tables.postings().count(), tables.ledger().count(), tables.errors().count()] == [1, 1, 1]


def two_boards(bronze):
    put_run(bronze / "one", "d1", "r1", "greenhouse_mews", {"jobs": [job(1), job(2), {"title": "no id"}]}, at="2026-01-01")
    put_run(bronze / "two", "d1", "r2", "greenhouse_mews", {"jobs": [job(1), job(3)]}, at="2026-01-02")


@pytest.mark.parametrize("moment", ["_register", "_finish"])
def test_two_loads_from_one_base_lose_nothing(spark, tmp_path, monkeypatch, moment):
    """The second load commits while the first one is about to; the first plans again."""
    two_boards(tmp_path / "b")
    tables = SilverTables(spark, str(tmp_path / "s"))
    original, calls = SilverTables.commit, []

    def overtaken(self, parts, version):
        calls.append(version)
        if len(calls) == (1 if moment == "_register" else 2):
            monkeypatch.setattr(SilverTables, "commit", original)
            load(spark, tmp_path / "b" / "two", tmp_path / "s")
            monkeypatch.setattr(SilverTables, "commit", overtaken)
        original(self, parts, version)

    monkeypatch.setattr(SilverTables, "commit", overtaken)
    _, summary = load(spark, tmp_path / "b" / "one", tmp_path / "s")
    monkeypatch.undo()
    assert (summary["partial"], summary["records"]) == (1, 2)
    assert {r.run_id: r.status for r in tables.ledger().collect()} == {"r1": "partial", "r2": "processed"}
    # The newer run is complete and lacks job 2; what both have is the newer one's.
    assert status_of(tables) == {"1": "active", "2": "inactive", "3": "active"}
    assert {r.source_job_id: r.run_id for r in tables.postings().collect()} == {"1": "r2", "2": "r1", "3": "r2"}
    assert tables.errors().count() == 1 and tables.dimensions().count() == tables.dimensions().distinct().count()


def test_a_run_taken_over_meanwhile_is_left_to_its_new_owner(spark, tmp_path, monkeypatch):
    """Both loads parse the run; one of them registers it later and finishes first."""
    put_run(tmp_path / "b", "d1", "r1", "greenhouse_mews", {"jobs": [job(1), {"title": "no id"}]}, at="2026-01-01")
    from jobweft.plans import load as module

    original, seen = module._finish, []

    def slow(spark, tables, batch):
        if not seen:
            seen.append(True)
            load(spark, tmp_path / "b", tmp_path / "s")
        return original(spark, tables, batch)

    monkeypatch.setattr(module, "_finish", slow)
    tables, summary = load(spark, tmp_path / "b", tmp_path / "s")
    assert [tables.postings().count(), tables.ledger().count(), tables.errors().count()] == [1, 1, 1]
    assert (summary["partial"], summary["skipped"]) == (0, 1)


def test_a_load_killed_after_registration_is_taken_over(spark, tmp_path, monkeypatch):
    put_run(tmp_path / "b", "d1", "r1", "greenhouse_mews", {"jobs": [job(1)]}, at=None)
    from jobweft.plans import load as module

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(module, "parse_batch", killed)
    with pytest.raises(KeyboardInterrupt):
        load(spark, tmp_path / "b", tmp_path / "s")
    monkeypatch.undo()
    (left,) = SilverTables(spark, str(tmp_path / "s")).ledger().collect()
    assert (left.status, left.processed_records, left.processed_at, left.parser_version) == ("processing", 0, None, None)
    # Within the lease it is still the other attempt's.
    tables, summary = load(spark, tmp_path / "b", tmp_path / "s", lease_seconds=3600)
    assert (summary["skipped"], summary["processed"], tables.postings().count()) == (1, 0, 0)
    tables, summary = load(spark, tmp_path / "b", tmp_path / "s")
    (run,) = tables.ledger().collect()
    assert (summary["processed"], run.status, run.created_at) == (1, "processed", left.created_at)
    assert run.attempt_id != left.attempt_id and run.processing_started_at > left.processing_started_at
    # A run without a time keeps the one it was registered with.
    assert (run.retrieved_at, tables.postings().first().last_seen_at) == (left.retrieved_at, left.retrieved_at)


def test_runs_are_taken_up_in_portions(spark, tmp_path):
    for n in range(3):
        jobs = [job(k, content=f"text {k}") for k in range(n, n + 2)]
        put_run(tmp_path / "b", f"d{n}", f"r{n}", "greenhouse_mews", {"jobs": jobs}, at=f"2026-01-0{n + 1}")
    put_run(tmp_path / "b", "d9", "r9", "greenhouse_mews", "{broken", at="2026-01-09", count=1)
    _, summary = load(spark, tmp_path / "b", tmp_path / "many", runs_at_once=1)
    assert (summary["processed"], summary["failed"], summary["records"], summary["skipped"]) == (3, 1, 6, 0)
    columns = ["source_job_id", "status", "canonical_id", "last_seen_at", "run_id"]
    whole, _ = load(spark, tmp_path / "b", tmp_path / "once")
    many = SilverTables(spark, str(tmp_path / "many"))
    assert sorted(many.postings().select(columns).collect()) == sorted(whole.postings().select(columns).collect())


def test_second_load_opens_only_new_bodies_and_shuffles_none(spark, tmp_path, monkeypatch):
    two_boards(tmp_path / "b")
    load(spark, tmp_path / "b" / "one", tmp_path / "s")
    from jobweft.plans import load as module

    taken, original = [], module.parse_batch
    monkeypatch.setattr(module, "parse_batch", lambda todo, *rest: taken.append(todo) or original(todo, *rest))
    load(spark, tmp_path / "b", tmp_path / "s")
    (todo,) = taken
    assert [f.rsplit("/", 2)[1] for f in todo.inputFiles() if f.endswith("response.json")] == ["r2"]
    # Up to the rows of advertisements, what is exchanged holds no payload.
    rows = module.read_rows(todo, module.Rules().adapters)
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "payload" in text
    for line in text.splitlines():
        if "Exchange" in line and "BroadcastExchange" not in line:
            assert "payload#" not in line


def test_table_layout_reads_only_the_days_of_new_runs(spark, tmp_path, capsys):
    path = str(tmp_path / "bronze")
    body = json.dumps({"jobs": [job(1)]})
    for company in ("Mews", "Mews"):
        rows = spark.createDataFrame([("greenhouse_mews", company, body)], "source_key string, company string, payload string")
        write_bronze(rows, path, "greenhouse")
    table = RunTable(spark, path)
    facts = table.facts().orderBy("run_id")
    assert "payload" not in facts.columns and facts.count() == 2
    one = table.with_payload(facts.limit(1))
    assert [r.payload for r in one.collect()] == [body]
    one.explain("formatted")
    scans = [line for line in capsys.readouterr().out.splitlines() if line.startswith("PartitionFilters")]
    assert any("source_key" in line and "= greenhouse_mews" in line and "ingest_date" in line for line in scans)
    tables = SilverTables(spark, str(tmp_path / "s"))
    assert load_runs(spark, table, tables).first().processed == 2
    assert load_runs(spark, table, tables).first().skipped == 2


def test_advertisements_meet_their_postings_only_where_they_are_read(spark, tmp_path, monkeypatch):
    from jobweft.plans import load as module

    made, original = [], module.plan_load
    monkeypatch.setattr(module, "plan_load", lambda *given: made.append(original(*given)) or made[-1])
    first = [job(1), job(2), job(2, "Data Analyst"), job(3)]
    put_run(tmp_path / "b", "2026-01-01", "r1", "greenhouse_mews", {"jobs": first}, at="2026-01-01T10:00:00Z")
    load(spark, tmp_path / "b", tmp_path / "s")
    put_run(tmp_path / "b", "2026-01-02", "r2", "greenhouse_mews", {"jobs": [job(1, "Data Analyst")]}, at="2026-01-02T10:00:00Z")
    tables, _ = load(spark, tmp_path / "b", tmp_path / "s")
    stored = {r.source_job_id: (json.loads(r.raw_advertisement), r.status) for r in tables.postings().collect()}
    # Replaced, the last of two in one snapshot, and kept from the state.
    assert stored == {"1": (job(1, "Data Analyst"), "active"), "2": (job(2, "Data Analyst"), "inactive"), "3": (job(3), "inactive")}
    for changes in made:
        assert "raw_advertisement" in changes.postings.columns
        text = changes.postings.drop("raw_advertisement")._jdf.queryExecution().optimizedPlan().toString()
        assert "raw_advertisement" not in text and "Join" not in text
