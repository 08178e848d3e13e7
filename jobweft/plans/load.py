"""The incremental load: from new board snapshots to silver postings."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweft import PARSER_VERSION
from jobweft.operators.canonical import assign_canonical
from jobweft.operators.constraints import check_records, run_constraints, split_quarantine, violations
from jobweft.operators.dictionary import AliasDictionary, load_dictionaries
from jobweft.operators.enrich import enrich_jobs
from jobweft.operators.ledger import (
    advance_ledger,
    leased,
    link_errors,
    load_summary,
    owned_runs,
    register_runs,
    run_outcomes,
    runs_to_process,
)
from jobweft.operators.upsert import deactivate_missing, posting_key, snapshot_cutoffs, upsert
from jobweft.plans.seeds import missing_seeds, seed_frame
from jobweft.schemas import ERRORS, LEDGER, POSTINGS, RECORD
from jobweft.session import cut_lineage, cut_measured
from jobweft.settings import Board, HourLimits, boards_frame, load_boards, load_hour_limits
from jobweft.sources.adapters import ADAPTERS, RUN_FIELDS, Adapter, read_rows
from jobweft.sources.boards import attribute_runs
from jobweft.sources.bronze import RunFiles, RunFrame, RunTable
from jobweft.sources.silver import CommitConflict, SilverTables, whole

_RUN = ["source_id", "run_id"]
_ORDER = ["retrieved_at", "run_id", "pos"]
#: The advertisement as it came, which nothing is decided by, and the columns without it.
_BODY = "raw_advertisement"
_SLIM = [c for c in POSTINGS if c != _BODY]
#: What stands for a row of the state among the hashes that tell parsed rows apart.
_STORED = 0

#: Runs that one commit takes up, and how often a commit that came second is planned again.
RUNS_AT_ONCE, ATTEMPTS = 4096, 10


@dataclass(frozen=True)
class Rules:
    """Everything a load is configured with."""

    dictionaries: dict[str, AliasDictionary] = field(default_factory=load_dictionaries)
    limits: HourLimits = field(default_factory=load_hour_limits)
    boards: list[Board] = field(default_factory=load_boards)
    adapters: dict[str, Adapter] = field(default_factory=lambda: dict(ADAPTERS))


def parse_runs(runs: DataFrame, rules: Rules, dimensions: DataFrame) -> tuple[DataFrame, ...]:
    """(accepted records, error rows, runs with run_error) of attributed runs."""
    records = enrich_jobs(read_rows(runs, rules.adapters), rules.dictionaries, rules.limits)
    checked = check_records(
        records,
        dimensions.where(F.col("dimension") == "sources"),
        dimensions.where(F.col("dimension") == "companies"),
        unseeded_names(rules.dictionaries, dimensions),
        rules.limits,
    )
    # Parsing is the costly part and several consumers follow: the payloads are read
    # once and the rows kept, those that only stand for their run included.
    rows = cut_lineage(checked)
    good, bad = split_quarantine(rows.where(F.col("pos").isNotNull()))
    facts = ["source_key", "retrieved_at", *RUN_FIELDS]
    seen = rows.groupBy(*_RUN).agg(*[F.max(c).alias(c) for c in facts])
    return good.drop(*RUN_FIELDS), bad, seen


def unseeded_names(
    dictionaries: dict[str, AliasDictionary], dimensions: DataFrame
) -> dict[str, list[str]]:
    """Dictionary names without a dimension row.

    Only names of the dictionaries are collected, so the result is no larger.
    """
    tables = ("roles", "seniority_levels", "skills", "work_modes", "locations",
              "employment_relations", "workloads")
    wanted = F.lit(False)
    for table in tables:
        wanted = wanted | (
            (F.col("dimension") == table) & F.col("name").isin(dictionaries[table].names)
        )
    seeded = {(r.dimension, r.name) for r in dimensions.where(wanted).distinct().collect()}
    return {
        table: sorted({n for n in dictionaries[table].names if (table, n) not in seeded})
        for table in tables
    }


@dataclass(frozen=True)
class State:
    """What a load starts from."""

    postings: DataFrame
    ledger: DataFrame
    dimensions: DataFrame


@dataclass(frozen=True)
class Batch:
    """Parsed runs of one attempt: accepted records, error rows and the runs themselves."""

    attempt_id: str
    now: Column
    good: DataFrame
    bad: DataFrame
    runs: DataFrame


@dataclass(frozen=True)
class Changes:
    """What a load would make of its state: new rows of the boards it touched, and the rest."""

    postings: DataFrame
    touched: DataFrame
    ledger: DataFrame
    errors: DataFrame
    outcomes: DataFrame


def parse_batch(todo: DataFrame, rules: Rules, dimensions: DataFrame, attempt_id: str, now: Column) -> Batch:
    """Parse attributed runs with their payloads; runs without a parser fail."""
    good, bad, seen = parse_runs(todo, rules, dimensions)
    unknown = todo.where(~F.col("adapter_id").isin(list(rules.adapters))).drop("payload")
    unknown = unknown.withColumn(
        "run_error",
        F.coalesce("run_error", F.concat(F.lit("No parser is registered for source: "), "adapter_id")),
    )
    return Batch(attempt_id, now, good, bad, seen.unionByName(unknown.select(seen.columns)))


def plan_load(state: State, batch: Batch) -> Changes:
    """The state after a batch, as frames: nothing is read from or written to a table.

    Only runs that the ledger still shows as taken up by the batch's attempt count;
    what another load took over meanwhile is left to it. Records replace stored rows
    that are not newer, with all their children; a record with an error leaves only
    its error row. Postings that the newest complete snapshot of a board lacks become
    inactive, and postings without a link get one.

    Advertisements as they came decide nothing, so they stay where parsing or the state
    has them and meet their postings last, when ``postings`` is read. Everything
    before that works on the rest of a row and on which row it is (``_row``).
    """
    owned = cut_measured(owned_runs(state.ledger, batch.attempt_id))
    parsed = batch.good.withColumn("_row", F.xxhash64(*_RUN, "pos", _BODY))
    good, bad, runs = (frame.join(owned, _RUN, "left_semi") for frame in (parsed.drop(_BODY), batch.bad, batch.runs))
    outcomes = cut_lineage(run_outcomes(runs, good, bad))
    ledger = cut_lineage(advance_ledger(state.ledger, outcomes, PARSER_VERSION).select(*LEDGER))

    fresh = _as_postings(good, batch.now)
    touched = cut_measured(fresh.select("source_key").unionByName(outcomes.select("source_key")).distinct())
    stored = state.postings.join(touched, "source_key", "left_semi").withColumns({"pos": F.lit(-1), "_row": F.lit(_STORED)})
    merged = deactivate_missing(_merge(stored.drop(_BODY), fresh), snapshot_cutoffs(ledger))
    linked = cut_lineage(_link(merged, state.postings, fresh))
    errors = link_errors(bad, ledger).withColumn("created_at", batch.now)
    return Changes(_with_bodies(linked, stored, parsed), touched, ledger, errors.select(*ERRORS), outcomes)


def _with_bodies(slim: DataFrame, stored: DataFrame, parsed: DataFrame) -> DataFrame:
    """Postings with the advertisement of the row they come from, stored or parsed.

    A frame that does not read it leaves the join out, as a row has one body.
    """
    own = [posting_key(F.col("source_key"), F.col("source_job_id")).alias("posting_key"), "_row", _BODY]
    rows = stored.select("posting_key", "_row", _BODY).unionByName(parsed.select(*own))
    bodies = rows.groupBy("posting_key", "_row").agg(F.max(_BODY).alias(_BODY))
    return slim.join(bodies, ["posting_key", "_row"], "left").select(*POSTINGS)


def missing_dimensions(spark: SparkSession, rules: Rules, stored: DataFrame) -> DataFrame:
    """Seeds that the stored dimensions do not have yet."""
    seed = seed_frame(spark, rules.dictionaries, rules.boards)
    sources = F.col("dimension") == "sources"
    return missing_seeds(seed.where(~sources), stored, "dimension", "name").unionByName(
        missing_seeds(seed.where(sources), stored.where(sources), "source_key")
    )


def load_runs(
    spark: SparkSession,
    discovered: RunFiles | RunTable | RunFrame | DataFrame,
    tables: SilverTables,
    rules: Rules | None = None,
    *,
    retry_partial: bool = False,
    runs_at_once: int = RUNS_AT_ONCE,
    lease_seconds: int = 0,
) -> DataFrame:
    """Process every run not done yet and commit the results; returns the counters.

    Runs are taken up oldest first, ``runs_at_once`` at a time, in two commits. The
    first one registers them in the ledger as ``processing`` by this attempt, before a
    payload is read. The second one makes postings, ledger and errors visible together.
    A load that dies in between leaves its runs in ``processing``, and the next load
    takes them over (with ``lease_seconds`` only those taken up longer ago).

    Replaying a load changes nothing: finished runs are skipped, postings are keyed by
    board and job id, and a link once made stays. Loads may run side by side: a commit
    that comes second is planned again from the tables as they are then, without the
    runs that belong to another attempt by then.

    Runs that cannot be registered are counted as ``rejected``, leave an error row with
    their path, and make the exit code 1.
    """
    rules = rules or Rules()
    source = RunFrame(discovered) if isinstance(discovered, DataFrame) else discovered
    attempt_id = uuid.uuid4().hex
    # One time stands for the whole load, also for runs that do not say theirs.
    now = F.lit(datetime.now(timezone.utc))
    named, rejected = map(cut_lineage, split_runs(cut_lineage(source.facts())))
    attributed = cut_lineage(attribute_runs(named, boards_frame(spark, rules.boards)))
    turned_away, done = rejected.count(), []
    problems = _rejections(rejected).withColumn("created_at", now).select(*ERRORS) if turned_away else None
    while True:
        todo = _register(
            spark, tables, attributed, problems if not done else None, rules, attempt_id, now,
            retry_partial, runs_at_once, lease_seconds,
        )
        if todo is None:
            break
        dimensions = tables.dimensions()
        batch = parse_batch(source.with_payload(todo), rules, dimensions, attempt_id, now)
        done.append(_finish(spark, tables, batch))
    outcomes = reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], "status string, processed_records int")
    counted = load_summary(named, outcomes)
    return cut_lineage(
        counted.withColumn("discovered", F.col("discovered") + turned_away)
        .withColumn("exit_code", F.when(F.lit(turned_away > 0), 1).otherwise(F.col("exit_code")))
        .withColumn("rejected", F.lit(turned_away))
    )


def _rejections(rejected: DataFrame) -> DataFrame:
    return rejected.select(
        "source_id", "run_id", F.lit(None).cast("string").alias("source_job_id"), F.lit("metadata").alias("stage"),
        F.lit("RejectedRun").alias("error_type"),
        F.concat("raw_path", F.lit(": "), F.coalesce("run_error", F.lit("run cannot be keyed"))).alias("error_message"),
    )


def _register(
    spark, tables, attributed, problems, rules, attempt_id, now, retry_partial, runs_at_once, lease_seconds
) -> DataFrame | None:
    """Commit the next runs as taken up, and return them; None if there are none.

    Missing seeds, and ``problems`` if given, are committed along.
    """
    for _ in range(ATTEMPTS):
        held = tables.snapshot()
        ledger = held.ledger()
        mine = F.col("attempt_id") == attempt_id
        skipped = ledger.where(mine & (F.col("status") != "processing")).select(*_RUN)
        if lease_seconds:
            skipped = skipped.unionByName(leased(ledger, attempt_id, now, lease_seconds))
        known = ledger.select(*_RUN, F.col("retrieved_at").alias("_registered_at"))
        waiting = runs_to_process(attributed, ledger, retry_partial=retry_partial).join(skipped, _RUN, "left_anti")
        todo = (
            waiting.join(known, _RUN, "left")
            .withColumn("retrieved_at", F.coalesce("retrieved_at", "_registered_at", now)).drop("_registered_at")
            .orderBy("retrieved_at", *_RUN).limit(runs_at_once)
        )
        todo = cut_lineage(todo)
        seeds = cut_lineage(missing_dimensions(spark, rules, held.dimensions()))
        written = {"dimensions": None if seeds.isEmpty() else seeds, "errors": problems}
        if not todo.isEmpty():
            written["ledger"] = register_runs(ledger, todo, attempt_id, now).select(*LEDGER)
        written = {name: frame for name, frame in written.items() if frame is not None}
        if not written:
            return None
        version = held.next_version()
        for name, frame in written.items():
            held.write_whole(name, frame, version)
        parts = reduce(DataFrame.unionByName, [whole(name, spark) for name in written])
        try:
            held.commit(parts, version)
        except CommitConflict:
            continue
        return todo if "ledger" in written else None
    raise CommitConflict(f"{ATTEMPTS} registrations were overtaken by other loads")


def _finish(spark: SparkSession, tables: SilverTables, batch: Batch) -> DataFrame:
    """Commit what a batch changes, and return the outcomes of its runs."""
    for _ in range(ATTEMPTS):
        held = tables.snapshot()
        changes = plan_load(State(held.postings(), held.ledger(), held.dimensions()), batch)
        version = held.next_version()
        held.write_postings(changes.postings, version)
        held.write_whole("ledger", changes.ledger, version)
        held.write_errors(changes.errors, version)
        parts = changes.touched.select(F.lit("postings").alias("table_name"), F.col("source_key").alias("part"))
        for name in ("ledger", "errors"):
            parts = parts.unionByName(whole(name, spark))
        try:
            held.commit(parts, version)
        except CommitConflict:
            continue
        return changes.outcomes.select("status", "processed_records")
    raise CommitConflict(f"{ATTEMPTS} commits were overtaken by other loads")


def split_runs(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs that can be registered, and those that cannot; neither has a payload.

    A run is keyed by source and run id. One without them is rejected; so are a run that
    breaks a rule of the ledger, and one found in a second folder, where the first by path
    counts.
    """
    rules = {n: ok for n, ok in run_constraints().items() if n == "record_count_not_negative"}
    broken = violations(rules)
    facts = facts.withColumn(
        "run_error",
        F.coalesce("run_error", F.when(F.size(broken) > 0, F.concat(F.lit("violates check "), F.get(broken, F.lit(0))))),
    )
    keyed = F.col("source_id").isNotNull() & F.col("run_id").isNotNull() & (F.size(broken) == 0)
    places = facts.where(keyed).groupBy(*_RUN).agg(F.min("raw_path").alias("raw_path"))
    again = facts.where(keyed).join(places, [*_RUN, "raw_path"], "left_anti").withColumn(
        "run_error", F.lit("The same run was found in another folder")
    )
    named = facts.where(keyed).join(places, [*_RUN, "raw_path"], "left_semi").select(facts.columns)
    return named, facts.where(~keyed).unionByName(again.select(facts.columns))


def _as_postings(good: DataFrame, now: Column) -> DataFrame:
    seen = F.col("retrieved_at")
    fresh = {
        "posting_key": posting_key(F.col("source_key"), F.col("source_job_id")),
        "retrieved_at": seen,
        "last_seen_at": seen,
        "status": F.lit("active"),
        "normalization_version": F.lit(PARSER_VERSION),
        "created_at": now,
        "updated_at": now,
        "canonical_id": F.lit(None).cast("string"),
        "match_method": F.lit(None).cast("string"),
        "matched_at": F.lit(None).cast("timestamp"),
    }
    own = {"source_key", "run_id", *RECORD}
    return good.select(*[F.col(c) if c in own else fresh[c].alias(c) for c in _SLIM], "pos", "_row")


def _merge(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Newest row per posting; first sight, link and greatest time seen are kept."""
    kept = ["created_at", "canonical_id", "match_method", "matched_at"]
    return upsert(state.select(batch.columns), batch, ["posting_key"], _ORDER, kept)


def _link(merged: DataFrame, before: DataFrame, batch: DataFrame) -> DataFrame:
    """Add links to postings that have none; postings of all boards are candidates."""
    attributes = [
        "posting_key",
        F.col("company_name").alias("company"),
        F.col("content_fingerprint").alias("fingerprint"),
        F.col("role_name").alias("role"),
        F.col("seniority_level_name").alias("seniority"),
        "locations",
    ]
    merged = cut_lineage(merged)
    first_seen = batch.groupBy("posting_key").agg(F.min(F.struct(*_ORDER)).alias("_seen"))
    new = (
        merged.where(F.col("canonical_id").isNull())
        .select(*attributes)
        .join(first_seen, "posting_key")
        .withColumn("ord", F.struct("_seen.*", "posting_key"))
        .drop("_seen")
    )
    # Rows of this load are newer than the stored ones of the same boards.
    current = merged.where(F.col("canonical_id").isNotNull()).select(*attributes, "canonical_id")
    elsewhere = before.where(F.col("canonical_id").isNotNull()).join(
        merged.select("posting_key"), "posting_key", "left_anti"
    )
    companies = new.select("company").distinct()
    candidates = current.unionByName(elsewhere.select(*attributes, "canonical_id")).join(
        companies, "company", "left_semi"
    )
    links = assign_canonical(new, candidates).select(
        "posting_key",
        F.col("canonical_id").alias("_canonical_id"),
        F.col("match_method").alias("_match_method"),
    )
    joined = merged.join(links, "posting_key", "left")
    made = F.col("_canonical_id").isNotNull()
    return joined.withColumns(
        {
            "canonical_id": F.coalesce("canonical_id", "_canonical_id"),
            "match_method": F.coalesce("match_method", "_match_method"),
            "matched_at": F.when(made, F.current_timestamp()).otherwise(F.col("matched_at")),
        }
    ).drop("_canonical_id", "_match_method", "pos")
