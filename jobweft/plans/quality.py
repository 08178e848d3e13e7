"""Data-quality checks as DataFrames, and a runner that reports on all of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from jobweft.schemas import MATCH_METHODS
from jobweft.session import cut_lineage

Tables = Mapping[str, DataFrame]


def run_counts(ledger: DataFrame) -> DataFrame:
    """Runs, downloaded and processed records per status."""
    return (
        ledger.groupBy("status")
        .agg(
            F.count("*").alias("runs"),
            F.coalesce(F.sum("record_count"), F.lit(0)).cast("bigint").alias("downloaded_records"),
            F.coalesce(F.sum("processed_records"), F.lit(0)).cast("bigint").alias("processed_records"),
        )
        .orderBy("status")
    )


def count_mismatches(ledger: DataFrame) -> DataFrame:
    """Processed runs whose record count is known and differs."""
    return (
        ledger.where(
            (F.col("status") == "processed")
            & F.col("record_count").isNotNull()
            & (F.col("record_count") != F.col("processed_records"))
        )
        .select("source_id", "run_id", "record_count", "processed_records")
        .orderBy("source_id", "run_id")
    )


def canonical_issues(postings: DataFrame, links: DataFrame, canonicals: DataFrame) -> DataFrame:
    """Counters of linking problems; informational, it never fails.

    ``postings`` (posting_key, company, fingerprint), ``links`` (posting_key,
    canonical_id, match_method), ``canonicals`` (canonical_id).
    """
    missing = postings.join(links, "posting_key", "left_anti")
    orphans = canonicals.join(links, "canonical_id", "left_anti")
    # Two ends of the canonical ids tell one from several without a distinct count.
    duplicates = (
        postings.where(F.col("fingerprint").isNotNull())
        .join(links, "posting_key")
        .groupBy("company", "fingerprint")
        .agg(F.min("canonical_id").alias("low"), F.max("canonical_id").alias("high"))
        .where(F.col("low") != F.col("high"))
    )
    methods = links.where(~F.col("match_method").isin(MATCH_METHODS))
    counted = {
        "missing_canonical_link": missing,
        "canonical_without_posting": orphans,
        "duplicate_fingerprint_across_canonicals": duplicates,
        "invalid_match_method": methods,
    }
    rows = [
        frame.agg(F.count("*").cast("bigint").alias("issue_count")).select(
            F.lit(issue).alias("issue"), "issue_count"
        )
        for issue, frame in counted.items()
    ]
    return reduce(DataFrame.unionByName, rows).orderBy("issue")


@dataclass(frozen=True)
class Check:
    """A named check: ``report`` is shown, any row of ``violations`` fails it."""

    report: Callable[[Tables], DataFrame]
    violations: Callable[[Tables], DataFrame] | None = None


CHECKS: dict[str, Check] = {
    "001_processed_run_counts": Check(
        report=lambda t: run_counts(t["ledger"]),
        violations=lambda t: count_mismatches(t["ledger"]),
    ),
    "002_canonical_job_integrity": Check(
        report=lambda t: canonical_issues(t["postings"], t["links"], t["canonicals"]),
    ),
}


def run_checks(
    spark: SparkSession, tables: Tables, checks: dict[str, Check] | None = None, *, strict: bool = False
) -> DataFrame:
    """Run all checks in name order, each on its own; a broken check fails alone.

    Returns (check, passed, violations, message); ``strict`` raises if one failed.
    """
    return check_results(spark, tables, checks, strict=strict)[0]


def check_results(
    spark: SparkSession, tables: Tables, checks: dict[str, Check] | None = None, *, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """What ``run_checks`` returns, and the rows that the checks found.

    The rows are (check, kind, row): the rows of the report and those that violate the
    check, as JSON. They are computed once and kept; the violations are counted in that
    pass.
    """
    checks = CHECKS if checks is None else checks
    if not checks:
        raise RuntimeError("No quality checks found")
    results, found = [], [spark.createDataFrame([], _CHECK_ROWS)]
    for name in sorted(checks):
        counted = Observation(name)
        try:
            rows = _check_rows(name, checks[name], tables)
            violating = F.count_if(F.col("kind") == "violation").alias("violations")
            found.append(cut_lineage(rows.observe(counted, violating)))
            violations = counted.get["violations"]
            message = f"{violations} violations" if violations else None
        except (PySparkException, KeyError) as error:
            violations, message = None, str(error)
        results.append((name, violations == 0, violations, message))
    failed = [name for name, passed, *_ in results if not passed]
    if strict and failed:
        raise RuntimeError(f"Quality checks failed: {', '.join(failed)}")
    summary = spark.createDataFrame(
        results, "check string, passed boolean, violations bigint, message string"
    ).orderBy("check")
    return summary, reduce(DataFrame.unionByName, found)


_CHECK_ROWS = "check string, kind string, row string"


def _check_rows(name: str, check: Check, tables: Tables) -> DataFrame:
    def shown(frame: DataFrame, kind: str) -> DataFrame:
        return frame.select(
            F.lit(name).alias("check"), F.lit(kind).alias("kind"), F.to_json(F.struct(*frame.columns)).alias("row")
        )

    rows = shown(check.report(tables), "report")
    if check.violations:
        rows = rows.unionByName(shown(check.violations(tables), "violation"))
    return rows
