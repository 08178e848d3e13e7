"""Row constraints, reference checks and the split into good rows and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweft.functions.hours import hours_cap
from jobweft.schemas import (
    HOURS_PERIODS,
    MATCH_METHODS,
    POSTING_STATUSES,
    RUN_STATUSES,
    SALARY_PERIODS,
)
from jobweft.settings import HourLimits, load_hour_limits


def posting_constraints() -> dict[str, Column]:
    return {
        "status_domain": F.col("status").isin(POSTING_STATUSES),
        "fingerprint_format": F.col("content_fingerprint").rlike("^[0-9a-f]{64}$"),
    }


def hours_constraints(limits: HourLimits | None = None) -> dict[str, Column]:
    limits = limits or load_hour_limits()
    low, high, period = F.col("hours_min"), F.col("hours_max"), F.col("hours_period")
    cap = hours_cap(period, limits)
    return {
        "hours_min_not_negative": low >= 0,
        "hours_max_not_negative": high >= 0,
        "hours_range_ordered": high >= low,
        "hours_period_domain": period.isin(HOURS_PERIODS),
        "hours_min_within_period": low <= cap,
        "hours_max_within_period": high <= cap,
    }


def salary_constraints() -> dict[str, Column]:
    low, high = F.col("salary_min"), F.col("salary_max")
    return {
        "salary_has_bound": low.isNotNull() | high.isNotNull(),
        "salary_min_not_negative": low >= 0,
        "salary_max_not_negative": high >= 0,
        "salary_range_ordered": high >= low,
        "salary_currency_format": F.col("salary_currency").rlike("^[A-Z]{3}$"),
        "salary_period_domain": F.col("salary_period").isin(SALARY_PERIODS),
    }


def skill_constraints() -> dict[str, Column]:
    return {"priority_range": F.col("priority").between(1, 5)}


def run_constraints() -> dict[str, Column]:
    return {
        "run_status_domain": F.col("status").isin(RUN_STATUSES),
        "record_count_not_negative": F.col("record_count") >= 0,
        "processed_records_not_negative": F.col("processed_records") >= 0,
    }


def link_constraints() -> dict[str, Column]:
    return {"match_method_domain": F.col("match_method").isin(MATCH_METHODS)}


def violations(constraints: dict[str, Column]) -> Column:
    """Names of the broken constraints; an unknown (NULL) result passes."""
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(True)), name) for name, ok in constraints.items()])
    )


def unknown_reference(
    df: DataFrame, value: str, dimension: DataFrame, name: str, table: str, *, required: bool
) -> DataFrame:
    """Add ``<value>_error`` for values that the dimension table does not have.

    A missing optional value is fine, a missing required one is an error.
    """
    known = dimension.select(F.col(name).alias("_known_name")).distinct()
    given = F.nullif(F.col(value), F.lit(""))
    message = F.when(
        given.isNotNull() & F.col("_known_name").isNull(),
        F.concat(F.lit(f"Unknown reference value in {table}: "), given),
    )
    if required:
        message = message.when(
            given.isNull(),
            F.concat(
                F.lit(f"Missing reference value in {table}: "), F.coalesce(F.col(value), F.lit("None"))
            ),
        )
    return (
        df.join(known, F.col(value) == F.col("_known_name"), "left")
        .withColumn(f"{value}_error", message)
        .drop("_known_name")
    )


def check_records(
    records: DataFrame,
    sources: DataFrame,
    companies: DataFrame,
    missing_names: dict[str, list[str]] | None = None,
    limits: HourLimits | None = None,
) -> DataFrame:
    """Fill ``error`` of records the silver tables would not accept.

    All rules of a record are checked: hours, salary, fingerprint and skills. Status and
    link are not read but set by the load, to values of their domains.

    ``missing_names`` lists dictionary names without a dimension row, by table;
    it is empty unless somebody added an alias rule without seeding its name.
    """
    option = F.try_element_at("employment_options", F.lit(1))
    pay = F.col("compensation")
    flat = records.select(
        "*",
        option["hours_min"].alias("hours_min"),
        option["hours_max"].alias("hours_max"),
        option["hours_period"].alias("hours_period"),
        pay["salary_min"].alias("salary_min"),
        pay["salary_max"].alias("salary_max"),
        pay["salary_currency"].alias("salary_currency"),
        pay["salary_period"].alias("salary_period"),
    )
    salary = {n: pay.isNull() | ok for n, ok in salary_constraints().items()}
    fingerprint = {"fingerprint_format": posting_constraints()["fingerprint_format"]}
    skills = {
        "priority_range": F.forall("skill_requirements", lambda s: s["priority"].isNull() | s["priority"].between(1, 5))
    }
    broken = violations({**hours_constraints(limits), **salary, **fingerprint, **skills})
    source_known = sources.select(F.col("source_key").alias("_source")).distinct()
    checked = flat.join(source_known, F.col("source_key") == F.col("_source"), "left")
    checked = unknown_reference(checked, "company_name", companies, "name", "companies", required=True)
    reference_error = F.coalesce(
        F.when(
            F.col("_source").isNull(), F.concat(F.lit("Unknown source key: "), F.col("source_key"))
        ),
        F.col("company_name_error"),
        *_unseeded(missing_names or {}),
    )
    checked = checked.withColumn("_broken", broken)
    error = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(reference_error.isNotNull(), _error("ValueError", reference_error))
        .when(
            F.size("_broken") > 0,
            _error("CheckViolation", F.concat(F.lit("violates check "), F.element_at("_broken", 1))),
        )
    )
    return checked.withColumn("error", error).select(records.columns)


def _unseeded(missing: dict[str, list[str]]) -> list[Column]:
    found = {
        "roles": F.array("role_name"),
        "seniority_levels": F.array("seniority_level_name"),
        "locations": F.col("locations"),
        "work_modes": F.col("work_modes"),
        "employment_relations": F.col("employment_options.employment_relation_name"),
        "workloads": F.col("employment_options.workload_name"),
        "skills": F.col("skill_requirements.name"),
    }
    messages = []
    for table, column in found.items():
        if missing.get(table):
            hit = F.array_intersect(F.array_compact(column), F.array(*map(F.lit, missing[table])))
            messages.append(
                F.when(
                    F.size(hit) > 0,
                    F.concat(F.lit(f"Unknown reference value in {table}: "), F.element_at(hit, 1)),
                )
            )
    return messages


def split_quarantine(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, error rows) of a frame with an ``error`` struct."""
    good = checked.where(F.col("error").isNull()).drop("error")
    bad = checked.where(F.col("error").isNotNull()).select(
        "source_id", "run_id", "pos", "error.*"
    )
    return good, bad.withColumn("error_message", F.substring("error_message", 1, 2000))


def _error(kind: str, message: Column) -> Column:
    return F.struct(
        F.col("source_job_id"),
        F.lit("database").alias("stage"),
        F.lit(kind).alias("error_type"),
        message.alias("error_message"),
    )
