"""Reports over silver tables, and the general forms they are built from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- general forms over star tables -------------------------------------------


def active(facts: DataFrame, status: str = "status", value: str = "active") -> DataFrame:
    return facts.where(F.col(status) == value)


def count_by_optional(
    facts: DataFrame, dimension: DataFrame, fact_key: str, key: str, name: str, unknown: str, out: str
) -> DataFrame:
    """Facts per dimension name; facts without a dimension row share one bucket.

    Facts are counted per key first, so only one row per key reaches the join.
    """
    counts = facts.groupBy(fact_key).agg(F.count("*").alias("_n"))
    named = counts.join(
        dimension.select(F.col(key).alias("_key"), F.col(name).alias("_name")),
        F.col(fact_key) == F.col("_key"),
        "left",
    )
    return (
        named.groupBy("_key", "_name")
        .agg(F.sum("_n").alias("active_postings"))
        .select(F.coalesce("_name", F.lit(unknown)).alias(out), "active_postings")
        .orderBy(F.desc("active_postings"), out)
    )


def count_by_required(
    facts: DataFrame, dimension: DataFrame, fact_key: str, key: str, name: str, out: str
) -> DataFrame:
    """Facts per dimension name; facts without a dimension row are left out."""
    counts = facts.groupBy(fact_key).agg(F.count("*").alias("_n"))
    named = counts.join(
        dimension.select(F.col(key).alias("_key"), F.col(name).alias("_name")),
        F.col(fact_key) == F.col("_key"),
    )
    return (
        named.groupBy("_key", "_name")
        .agg(F.sum("_n").alias("active_postings"))
        .select(F.col("_name").alias(out), "active_postings")
        .orderBy(F.desc("active_postings"), out)
    )


def count_by_bridge(
    bridge: DataFrame, facts: DataFrame, dimension: DataFrame, *,
    posting: str, fact_key: str, value: str, key: str, name: str, out: str,
) -> DataFrame:
    """Distinct facts per value of a many-to-many bridge.

    (value, fact) pairs are made unique before they meet the facts, so the count
    afterwards is a plain one and a frequent value is spread over all its facts.
    """
    pairs = bridge.select(F.col(value).alias("_value"), F.col(posting).alias("_fact")).distinct()
    kept = pairs.join(facts.select(F.col(fact_key).alias("_fact")), "_fact", "left_semi")
    counts = kept.groupBy("_value").agg(F.count("*").alias("active_postings"))
    names = dimension.select(F.col(key).alias("_value"), F.col(name).alias(out))
    return (
        counts.join(names, "_value")
        .select(out, "active_postings")
        .orderBy(F.desc("active_postings"), out)
    )


# --- reports over silver postings ----------------------------------------------


def active_by_company(postings: DataFrame) -> DataFrame:
    return _by_value(postings, F.coalesce("company_name", F.lit("[unknown company]")), "company")


def active_by_role(postings: DataFrame) -> DataFrame:
    return _by_value(postings, F.coalesce("role_name", F.lit("[unknown role]")), "role")


def top_skills(postings: DataFrame) -> DataFrame:
    return _by_item(postings, F.col("skill_requirements.name"), "skill")


def active_by_work_mode(postings: DataFrame) -> DataFrame:
    return _by_item(postings, F.col("work_modes"), "work_mode")


def active_by_location(postings: DataFrame) -> DataFrame:
    return _by_item(postings, F.col("locations"), "location")


def active_by_source(postings: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` has (source_key, name)."""
    return count_by_required(active(postings), sources, "source_key", "source_key", "name", "source")


def posting_detail(postings: DataFrame, sources: DataFrame) -> DataFrame:
    """One readable row per posting; every column but the source name is its own."""
    names = sources.select("source_key", F.col("name").alias("source"))
    keep_nulls = {"ignoreNullFields": "false"}
    options = F.transform(
        "employment_options",
        lambda o: F.struct(
            o["employment_relation_name"].alias("employment_relation"),
            o["workload_name"].alias("workload"),
            o["hours_min"].alias("hours_min"),
            o["hours_max"].alias("hours_max"),
            o["hours_period"].alias("hours_period"),
        ),
    )
    skills = F.transform(
        F.array_sort("skill_requirements"),
        lambda s: F.struct(
            s["name"].alias("skill"),
            s["proficiency_level_name"].alias("proficiency"),
            s["requirement_type_name"].alias("requirement_type"),
            s["priority"].alias("priority"),
        ),
    )
    return (
        postings.join(names, "source_key")
        .select(
            F.col("posting_key").alias("job_posting_id"),
            "status",
            "source",
            "source_job_id",
            F.col("company_name").alias("company"),
            F.col("role_name").alias("role"),
            F.col("seniority_level_name").alias("seniority_level"),
            _joined("locations"),
            _joined("work_modes"),
            _when_any("employment_options", F.to_json(options, keep_nulls)),
            F.when(F.size("skill_requirements") > 0, F.to_json(skills, keep_nulls)).alias("skills"),
            "compensation.salary_min",
            "compensation.salary_max",
            "compensation.salary_currency",
            "compensation.salary_period",
            "source_url",
            "source_published_at",
            "source_updated_at",
            "retrieved_at",
            "last_seen_at",
        )
        .orderBy(F.desc("last_seen_at"), "job_posting_id")
    )


# --- bridge views of the nested columns ----------------------------------------


def posting_skills(postings: DataFrame) -> DataFrame:
    return postings.select("posting_key", F.explode("skill_requirements").alias("s")).select(
        "posting_key", "s.*"
    )


def posting_locations(postings: DataFrame) -> DataFrame:
    return postings.select("posting_key", F.explode("locations").alias("location"))


def posting_work_modes(postings: DataFrame) -> DataFrame:
    return postings.select("posting_key", F.explode("work_modes").alias("work_mode"))


def posting_employment_options(postings: DataFrame) -> DataFrame:
    return postings.select("posting_key", F.explode("employment_options").alias("o")).select(
        "posting_key", "o.*"
    )


def posting_compensations(postings: DataFrame) -> DataFrame:
    return postings.where("compensation is not null").select("posting_key", "compensation.*")


def _by_value(postings: DataFrame, value: Column, out: str) -> DataFrame:
    return (
        active(postings)
        .groupBy(value.alias(out))
        .agg(F.count("*").alias("active_postings"))
        .orderBy(F.desc("active_postings"), out)
    )


def _by_item(postings: DataFrame, items: Column, out: str) -> DataFrame:
    """Items of a nested column are unique within a posting, so counting suffices."""
    return (
        active(postings)
        .select(F.explode(F.array_distinct(items)).alias(out))
        .groupBy(out)
        .agg(F.count("*").alias("active_postings"))
        .orderBy(F.desc("active_postings"), out)
    )


def _joined(column: str) -> Column:
    return _when_any(column, F.array_join(F.array_sort(column), ", "))


def _when_any(column: str, value: Column) -> Column:
    return F.when(F.size(column) > 0, value).alias(column)
