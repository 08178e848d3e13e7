"""Turn common advertisement fields into a normalised record or an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweft.functions.hours import hours_error, hours_phrase, parse_hours
from jobweft.functions.money import amount
from jobweft.functions.text import content_fingerprint
from jobweft.operators.dictionary import AliasDictionary, find_first_of, key_tokens
from jobweft.schemas import EMPLOYMENT_OPTION
from jobweft.settings import HourLimits
from jobweft.sources.adapters import RUN_FIELDS


def employment_options(relation: Column, workload: Column, hours: Column) -> Column:
    """One option, or none when nothing at all was found."""
    none = relation.isNull() & workload.isNull() & hours["hours_min"].isNull()
    option = F.struct(
        relation.alias("employment_relation_name"),
        workload.alias("workload_name"),
        hours["hours_min"].alias("hours_min"),
        hours["hours_max"].alias("hours_max"),
        hours["hours_period"].alias("hours_period"),
    ).cast(EMPLOYMENT_OPTION)
    # Zero hours count as "not found", as an empty value does.
    only_zero = (
        relation.isNull() & workload.isNull() & hours["hours_period"].isNull()
        & (hours["hours_min"] == 0) & (hours["hours_max"] == 0)
    )
    empty = F.array().cast(f"array<{EMPLOYMENT_OPTION}>")
    return F.when(none | F.coalesce(only_zero, F.lit(False)), empty).otherwise(F.array(option))


def enrich_jobs(
    jobs: DataFrame, dictionaries: dict[str, AliasDictionary], limits: HourLimits
) -> DataFrame:
    """Records with ``error``; a row has an error struct or is a valid record.

    One projection per text: the tokens that decide which aliases to try are
    split out once and shared by all dictionaries.
    """
    used = [
        dictionaries[n]
        for n in ("companies", "roles", "seniority_levels", "skills", "work_modes", "locations",
                  "employment_relations", "workloads")
    ]
    everything = F.concat_ws(
        "\n", "search_text", "company_text", F.array_join("location_texts", "\n"),
        "work_mode_text", "employment_text",
    )
    staged = (
        jobs.withColumn("search_text", F.concat(F.col("title"), F.lit("\n"), F.col("body")))
        .withColumns(
            {
                "_keys": key_tokens(everything, used),
                "_phrase": hours_phrase(F.col("search_text")),
                "_low": amount(F.col("salary_min_text")),
                "_high": amount(F.col("salary_max_text")),
                "_job_text": F.concat_ws("\n", "employment_text", "search_text"),
            }
        )
        .withColumns(
            {
                "_hours": parse_hours(F.col("_phrase")),
                "_named_modes": dictionaries["work_modes"].find_all("work_mode_text", "_keys"),
                "_relation": dictionaries["employment_relations"].find_first("employment_text", "_keys"),
                "_workload": dictionaries["workloads"].find_first("_job_text", "_keys"),
                "_min": F.col("_low").try_cast("decimal(12,2)"),
                "_max": F.col("_high").try_cast("decimal(12,2)"),
            }
        )
    )
    skills = F.transform(
        dictionaries["skills"].find_all("search_text", "_keys"),
        lambda name: F.struct(
            name.alias("name"),
            F.lit(None).cast("string").alias("proficiency_level_name"),
            F.lit(None).cast("string").alias("requirement_type_name"),
            F.lit(None).cast("smallint").alias("priority"),
        ),
    )
    low, high = F.col("_low"), F.col("_high")
    pay = F.struct(
        F.col("_min").alias("salary_min"),
        F.col("_max").alias("salary_max"),
        "salary_currency",
        "salary_period",
    )
    overflow = (low.isNotNull() & F.col("_min").isNull()) | (high.isNotNull() & F.col("_max").isNull())
    text_modes = dictionaries["work_modes"].find_all("search_text", "_keys")
    records = staged.select(
        "source_id", "run_id", "source_key", "retrieved_at", *RUN_FIELDS, "pos",
        "error_job_id", "id_error", "time_error", "salary_error", "_hours",
        "source_job_id",
        F.coalesce(
            dictionaries["companies"].find_first("company_text", "_keys"),
            F.when(F.col("company_text") != "", F.col("company_text")),
        ).alias("company_name"),
        find_first_of(dictionaries["roles"], "_keys", "title", "search_text").alias("role_name"),
        find_first_of(dictionaries["seniority_levels"], "_keys", "title", "search_text").alias(
            "seniority_level_name"
        ),
        "source_url", "source_published_at", "source_updated_at", "raw_advertisement",
        content_fingerprint(F.col("body")).alias("content_fingerprint"),
        dictionaries["locations"].find_non_overlapping_each("location_texts", "_keys").alias(
            "locations"
        ),
        F.when(F.size("_named_modes") > 0, F.col("_named_modes")).otherwise(text_modes).alias(
            "work_modes"
        ),
        employment_options(F.col("_relation"), F.col("_workload"), F.col("_hours")).alias(
            "employment_options"
        ),
        F.when(low.isNotNull() | high.isNotNull(), pay).alias("compensation"),
        F.coalesce(overflow, F.lit(False)).alias("_overflow"),
        skills.alias("skill_requirements"),
    )
    hours = F.col("_hours")
    value_error = F.coalesce(
        F.col("id_error"),
        F.when(F.col("company_name").isNull(), F.lit("Job has no company")),
        F.col("time_error"),
        hours_error(hours["hours_min"], hours["hours_max"], hours["hours_period"], limits),
    )
    error = (
        F.when(value_error.isNotNull(), _error("error_job_id", "parse", "ValueError", value_error))
        .when(
            F.col("salary_error").isNotNull(),
            _error("error_job_id", "parse", "InvalidOperation", F.col("salary_error")),
        )
        .when(
            F.col("_overflow"),
            _error("source_job_id", "database", "NumericValueOutOfRange", F.lit("numeric field overflow")),
        )
    )
    return records.withColumn("error", error).drop(
        "error_job_id", "id_error", "time_error", "salary_error", "_hours", "_overflow"
    )


def _error(job_id: str, stage: str, kind: str, message: Column) -> Column:
    return F.struct(
        F.col(job_id).alias("source_job_id"),
        F.lit(stage).alias("stage"),
        F.lit(kind).alias("error_type"),
        message.alias("error_message"),
    )
