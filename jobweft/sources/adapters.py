"""Payload adapters: from a board's JSON to one common row per advertisement.

An adapter says where the job list sits and which members hold which field.
Everything after that (ids, times, salaries, dictionaries, hours, validation) is
shared and runs once over the union of all adapters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweft.functions import json_values as jv
from jobweft.functions.money import amount_is_bad, salary_period
from jobweft.functions.text import currency_code, optional_text, strip
from jobweft.functions.times import timestamp_error, timestamp_of

_RUN_KEYS = ["source_id", "run_id", "source_key", "retrieved_at"]
#: Columns of the run that every row keeps, so that runs can be told from rows.
RUN_FIELDS = ["adapter_id", "raw_path", "record_count", "payload_sha256", "run_error"]
_ITEM_KEYS = [
    *_RUN_KEYS, *RUN_FIELDS, "pos", "is_object", "raw_advertisement", "default_company",
]
_RAW_FALSY = ["", "[]", "{}", "0", "false", "null"]


@dataclass(frozen=True)
class Adapter:
    """Rules of one payload shape."""

    adapter_id: str
    #: (typed items, items as JSON text) of a payload; NULL when it has no list.
    job_list: Callable[[Column], tuple[Column, Column]]
    #: Adds the common fields to rows holding one job as JSON text.
    fields: Callable[[DataFrame], DataFrame]
    no_list_message: str
    no_id_message: str
    #: A list item that is no object spoils the whole run, or only itself.
    strict_items: bool

    def list_jobs(self, runs: DataFrame) -> DataFrame:
        """Runs with ``jobs`` (NULL if unusable) and the reason in ``run_error``."""
        typed, raw = self.job_list(F.col("payload"))
        listed = runs.withColumns({"_typed": typed, "_raw": raw})
        listed = listed.withColumn("_objects", F.transform("_typed", jv.is_object))
        usable = F.col("_objects").isNotNull()
        if self.strict_items:
            usable = usable & F.forall("_objects", lambda ok: ok)
        message = F.lit(self.no_list_message)
        if self.no_list_message.endswith(": "):
            message = F.concat(message, F.coalesce("raw_path", F.lit("")))
        listed = listed.withColumn("run_error", F.coalesce("run_error", F.when(~usable, message)))
        jobs = F.arrays_zip(F.col("_objects").alias("is_object"), F.col("_raw").alias("raw"))
        return listed.withColumn("jobs", F.when(F.col("run_error").isNull(), jobs)).drop(
            "_typed", "_raw", "_objects", "payload"
        )

    def read_fields(self, runs: DataFrame) -> DataFrame:
        """One row per advertisement, in the common fields.

        A run without a usable list, or with an empty one, has one row whose
        ``pos`` is NULL; its ``run_error`` tells which. A board is one payload, read by
        one task; its advertisements are dealt to all tasks before they are parsed.
        """
        items = runs.select(
            *_RUN_KEYS, *RUN_FIELDS,
            F.coalesce("context_company", F.lit("")).alias("default_company"),
            F.posexplode_outer("jobs").alias("pos", "_item"),
        ).select(
            *_RUN_KEYS, *RUN_FIELDS, "pos", "default_company",
            F.col("_item.is_object").alias("is_object"),
            F.col("_item.raw").alias("raw_advertisement"),
        ).repartition("run_id", "pos")
        return self.fields(items).withColumn("no_id_message", F.lit(self.no_id_message))


def _object_list(payload: Column) -> tuple[Column, Column]:
    return (
        F.from_json(payload, "struct<jobs: array<variant>>")["jobs"],
        F.from_json(payload, "struct<jobs: array<string>>")["jobs"],
    )


def _any_list(payload: Column) -> tuple[Column, Column]:
    """A list at the top, else the first non-empty of three members."""
    members = ("data", "postings", "jobs")

    def read(kind: str) -> Column:
        return F.from_json(payload, "struct<" + ", ".join(f"{m}: {kind}" for m in members) + ">")

    shown = read("string")

    def pick(kind: str) -> Column:
        lists = read(kind)
        choice = lists[members[-1]]
        for member in reversed(members[:-1]):
            given = F.coalesce(~shown[member].isin(_RAW_FALSY), F.lit(False))
            choice = F.when(given, lists[member]).otherwise(choice)
        return F.coalesce(F.from_json(payload, kind), choice)

    return pick("array<variant>"), pick("array<string>")


def _m(name: str) -> jv.Member:
    return jv.Member(name)


def _first_on(*names: str, part: str = "shown") -> Column:
    """The first truthy member, else the last one (as ``a or b or c`` gives)."""
    members = [_m(n) for n in names]
    return F.coalesce(
        *[F.when(m.on, getattr(m, part)) for m in members[:-1]], getattr(members[-1], part)
    )


def _body(*names: str) -> Column:
    """Text of the first truthy member, empty when there is none."""
    return F.coalesce(*[F.when(_m(n).on, _m(n).text) for n in names], F.lit(""))


def _stamps(published: str, updated: str) -> dict[str, Column]:
    return {
        "published_kind": _m(published).kind,
        "published_text": _m(published).shown,
        "updated_kind": _m(updated).kind,
        "updated_text": _m(updated).shown,
    }


def _no_pay() -> dict[str, Column]:
    names = ("low_text", "high_text", "currency_text", "pay_period_text")
    return {name: F.lit(None).cast("string") for name in names}


def _common(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    return df.select(*_ITEM_KEYS, *[column.alias(name) for name, column in fields.items()])


def _object_board(items: DataFrame) -> DataFrame:
    jobs = jv.with_members(
        items, "raw_advertisement", "id", "title", "content", "company_name", "location",
        "offices", "metadata", "absolute_url", "first_published", "updated_at",
    )
    jobs = jobs.withColumns(
        {
            "_place": _m("location").object_text,
            "_offices": F.from_json(_m("offices").array_text, "array<variant>"),
            "_entries": F.from_json(_m("metadata").array_text, "array<variant>"),
        }
    )
    jobs = jv.with_members(jobs, "_place", "name", prefix="place_")
    offices = F.transform("_offices", lambda o: F.try_variant_get(o, "$.location", "string"))
    return _common(
        jobs,
        {
            "id_text": _m("id").shown,
            "error_id_text": _m("id").shown,
            "title": F.when(_m("title").on, _m("title").shown).otherwise(""),
            "body": F.when(_m("content").on, _m("content").shown).otherwise(""),
            "company_value": F.when(_m("company_name").on, _m("company_name").shown),
            "places": F.concat(
                F.array(_m("place_name").shown),
                F.coalesce(offices, F.array().cast("array<string>")),
            ),
            "work_mode_text": jv.metadata_text(F.col("_entries"), "location type"),
            "employment_text": jv.metadata_text(F.col("_entries"), "employment type"),
            "url_text": _m("absolute_url").shown,
            **_stamps("first_published", "updated_at"),
            **_no_pay(),
        },
    )


def _list_board(items: DataFrame) -> DataFrame:
    jobs = jv.with_members(
        items, "raw_advertisement", "id", "hostedUrl", "applyUrl", "text", "company",
        "categories", "workplaceType", "descriptionPlain", "description", "descriptionHtml",
        "createdAt", "updatedAt", "salaryRange", "salary_range",
    )
    jobs = jobs.withColumns(
        {
            "_categories": _m("categories").object_text,
            "_range": F.when(_m("salaryRange").on, _m("salaryRange").object_text).otherwise(
                _m("salary_range").object_text
            ),
        }
    )
    jobs = jv.with_members(
        jobs, "_categories", "location", "allLocations", "commitment", "team", "department",
        "workplaceType", prefix="cat_",
    )
    jobs = jv.with_members(
        jobs, "_range", "min", "max", "currency", "interval", "period", prefix="pay_"
    )
    mode, own_mode = _m("cat_workplaceType").text, _m("workplaceType")
    return _common(
        jobs,
        {
            "id_text": F.coalesce(optional_text(_m("id").shown), optional_text(_m("hostedUrl").shown)),
            "error_id_text": _m("id").shown,
            "title": F.coalesce(strip(_m("text").shown), F.lit("")),
            "body": _body("descriptionPlain", "description", "descriptionHtml"),
            "company_value": F.when(_m("company").on, _m("company").shown),
            "places": F.array(
                F.when(_m("cat_location").on, _m("cat_location").shown),
                F.when(_m("cat_allLocations").on, _m("cat_allLocations").shown),
            ),
            "work_mode_text": F.when(own_mode.on, F.concat(mode, F.lit(" "), own_mode.text)).otherwise(mode),
            "employment_text": F.concat_ws(
                " ",
                *[_m(f"cat_{n}").text for n in ("commitment", "team", "department", "workplaceType")],
            ),
            "url_text": _first_on("hostedUrl", "applyUrl"),
            **_stamps("createdAt", "updatedAt"),
            "low_text": _m("pay_min").shown,
            "high_text": _m("pay_max").shown,
            "currency_text": _m("pay_currency").shown,
            "pay_period_text": _first_on("pay_interval", "pay_period", part="text"),
        },
    )


def _flagged_board(items: DataFrame) -> DataFrame:
    jobs = jv.with_members(
        items, "raw_advertisement", "id", "jobUrl", "applyUrl", "title", "company", "location",
        "secondaryLocations", "isRemote", "workplaceType", "employmentType", "descriptionPlain",
        "descriptionHtml", "description", "publishedAt", "updatedAt", "compensation",
    )
    jobs = jobs.withColumn("_pay", _m("compensation").object_text)
    jobs = jv.with_members(jobs, "_pay", "compensationRange", "range")
    jobs = jobs.withColumn(
        "_range",
        F.when(_m("compensationRange").on, _m("compensationRange").object_text).otherwise(
            _m("range").object_text
        ),
    )
    jobs = jv.with_members(
        jobs, "_range", "minValue", "min", "maxValue", "max", "currency", "salaryType", "interval",
        "period", prefix="pay_",
    )
    mode = _m("workplaceType").text
    return _common(
        jobs,
        {
            "id_text": F.coalesce(optional_text(_m("id").shown), optional_text(_m("jobUrl").shown)),
            "error_id_text": _m("id").shown,
            "title": F.coalesce(strip(_m("title").shown), F.lit("")),
            "body": _body("descriptionPlain", "descriptionHtml", "description"),
            "company_value": F.when(_m("company").on, _m("company").shown),
            "places": F.array(
                F.when(_m("location").on, _m("location").shown),
                F.when(_m("secondaryLocations").on, _m("secondaryLocations").shown),
            ),
            "work_mode_text": F.when(_m("isRemote").on, F.concat(mode, F.lit(" Remote"))).otherwise(mode),
            "employment_text": _m("employmentType").text,
            "url_text": _first_on("jobUrl", "applyUrl"),
            **_stamps("publishedAt", "updatedAt"),
            "low_text": _first_on("pay_minValue", "pay_min"),
            "high_text": _first_on("pay_maxValue", "pay_max"),
            "currency_text": _m("pay_currency").shown,
            "pay_period_text": _first_on("pay_salaryType", "pay_interval", "pay_period", part="text"),
        },
    )


#: Adapters by id; add an entry to read another payload shape.
ADAPTERS = {
    "greenhouse": Adapter(
        "greenhouse", _object_list, _object_board,
        "Greenhouse response has no jobs array: ", "Greenhouse job has no id", False,
    ),
    "lever": Adapter(
        "lever", _any_list, _list_board,
        "Lever response has no postings array", "Lever job has no id", True,
    ),
    "ashby": Adapter(
        "ashby", _object_list, _flagged_board,
        "Ashby response has no jobs array: ", "Ashby job has no id", True,
    ),
}


def read_jobs(
    runs: DataFrame, adapters: dict[str, Adapter] = ADAPTERS
) -> tuple[DataFrame, DataFrame]:
    """Split attributed runs into (advertisement rows, runs with their ``run_error``)."""
    rows = read_rows(runs, adapters)
    checked = [
        adapter.list_jobs(runs.where(F.col("adapter_id") == name)).drop("jobs")
        for name, adapter in adapters.items()
    ]
    return rows.where(F.col("pos").isNotNull()), reduce(DataFrame.unionByName, checked)


def read_rows(runs: DataFrame, adapters: dict[str, Adapter] = ADAPTERS) -> DataFrame:
    """Advertisement rows, with one row of NULL ``pos`` for every run that has none.

    One pass over the payloads yields both advertisements and run errors.
    """
    rows = [
        adapter.read_fields(adapter.list_jobs(runs.where(F.col("adapter_id") == name)))
        for name, adapter in adapters.items()
    ]
    return _finish(reduce(DataFrame.unionByName, rows))


def _finish(jobs: DataFrame) -> DataFrame:
    """Types and errors of the common fields, the same for every adapter."""
    published = timestamp_of(F.col("published_kind"), F.col("published_text"))
    updated = timestamp_of(F.col("updated_kind"), F.col("updated_text"))
    low, high = F.col("low_text"), F.col("high_text")
    places = F.filter(
        F.transform("places", lambda place: strip(place)), lambda place: place != ""
    )
    read = jobs.select(
        *_RUN_KEYS, *RUN_FIELDS, "pos", "raw_advertisement", "title", "body",
        F.col("id_text").alias("source_job_id"),
        optional_text(F.col("error_id_text")).alias("error_job_id"),
        F.when(~F.col("is_object"), F.lit("Job is not an object"))
        .when(F.col("id_text").isNull(), F.col("no_id_message"))
        .alias("id_error"),
        strip(F.coalesce("company_value", "default_company")).alias("company_text"),
        places.alias("location_texts"),
        "work_mode_text", "employment_text",
        optional_text(F.col("url_text")).alias("source_url"),
        published.alias("source_published_at"),
        updated.alias("source_updated_at"),
        "published_text", "updated_text",
        F.when(low != "", low).alias("salary_min_text"),
        F.when(high != "", high).alias("salary_max_text"),
        currency_code(F.col("currency_text")).alias("salary_currency"),
        salary_period(F.col("pay_period_text")).alias("salary_period"),
        F.when(amount_is_bad(low) | amount_is_bad(high), F.lit("Salary is not a number")).alias(
            "salary_error"
        ),
    )
    time_error = F.coalesce(
        timestamp_error(F.col("source_published_at"), F.col("published_text")),
        timestamp_error(F.col("source_updated_at"), F.col("updated_text")),
    )
    return read.withColumn("time_error", time_error).drop("published_text", "updated_text")
