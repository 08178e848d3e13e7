"""Run ledger: registration, what to skip, outcomes and error summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RUN = ["source_id", "run_id"]


def new_runs(runs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Runs the ledger does not know yet, to be registered as pending."""
    return runs.join(ledger, _RUN, "left_anti").withColumn("status", F.lit("pending"))


def runs_to_process(runs: DataFrame, ledger: DataFrame, *, retry_partial: bool = False) -> DataFrame:
    """Leave out finished runs; partly read ones come back only on request.

    Failed, pending and abandoned runs are always tried again.
    """
    done = ["processed"] if retry_partial else ["processed", "partial"]
    return runs.join(ledger.where(F.col("status").isin(done)).select(_RUN), _RUN, "left_anti")


def leased(ledger: DataFrame, attempt_id: str, now: Column, lease_seconds: int) -> DataFrame:
    """Runs that another attempt took up less than ``lease_seconds`` ago and has not finished."""
    age = F.unix_seconds(now) - F.unix_seconds("processing_started_at")
    held = (F.col("status") == "processing") & (F.col("attempt_id") != attempt_id) & (age < lease_seconds)
    return ledger.where(held).select(_RUN)


def register_runs(ledger: DataFrame, runs: DataFrame, attempt_id: str, now: Column) -> DataFrame:
    """Ledger in which ``runs`` are being processed by an attempt, written before the work.

    New runs get a row, known ones keep what they were registered with. A run that an
    earlier attempt left in ``processing`` belongs to this one from now on.
    """
    joined = ledger.alias("old").join(runs.withColumn("_taken", F.lit(True)).alias("new"), _RUN, "full_outer")
    taken = F.col("new._taken").isNotNull()

    def pick(column: str, fresh: Column) -> Column:
        return F.when(taken, fresh).otherwise(F.col(f"old.{column}")).alias(column)

    registered = ["source_key", "raw_path", "retrieved_at", "record_count", "payload_sha256"]
    return joined.select(
        *_RUN,
        *[F.coalesce(F.col(f"old.{c}"), F.col(f"new.{c}")).alias(c) for c in registered],
        pick("status", F.lit("processing")),
        F.coalesce(F.col("old.processed_records"), F.lit(0)).alias("processed_records"),
        F.col("old.parser_version").alias("parser_version"),
        pick("error_message", F.lit(None).cast("string")),
        pick("attempt_id", F.lit(attempt_id)),
        pick("processing_started_at", now),
        F.col("old.processed_at").alias("processed_at"),
        F.coalesce(F.col("old.created_at"), now).alias("created_at"),
        pick("updated_at", now),
    )


def owned_runs(ledger: DataFrame, attempt_id: str) -> DataFrame:
    """Runs that an attempt registered and nobody took over or finished since."""
    return ledger.where((F.col("status") == "processing") & (F.col("attempt_id") == attempt_id)).select(_RUN)


def run_status(successful: Column, errors: Column, expected: Column) -> Column:
    """Outcome of a run; without a single success it failed, even when empty."""
    return (
        F.when(successful == 0, "failed")
        .when((errors > 0) | (successful < expected), "partial")
        .otherwise("processed")
    )


def error_summaries(errors: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First three messages of every run joined by "; ", cut to 2,000 characters.

    The row-number limit is applied before the shuffle as well, so no task ever
    holds more than three rows of a run per input partition.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    first = (
        errors.select(*keys, *order, "error_message")
        .withColumn("_n", F.row_number().over(ranked))
        .where(F.col("_n") <= 3)
    )
    in_order = F.array_sort(F.collect_list(F.struct("_n", "error_message")))
    return first.groupBy(*keys).agg(
        F.substring(F.array_join(in_order["error_message"], "; "), 1, 2000).alias("error_message")
    )


def run_outcomes(runs: DataFrame, records: DataFrame, errors: DataFrame) -> DataFrame:
    """Status, processed count and message of every run.

    ``records`` holds the accepted rows before de-duplication and ``errors`` the
    rejected ones with ``stage`` and ``pos``. A run with a ``run_error`` failed.
    """
    good = records.groupBy(*_RUN).agg(F.count("*").alias("_good"))
    bad = errors.groupBy(*_RUN).agg(
        F.count("*").alias("_bad")
    )
    ordered = errors.withColumn("_late", (F.col("stage") == "database").cast("int"))
    messages = error_summaries(ordered, _RUN, ["_late", "pos"]).withColumnRenamed(
        "error_message", "_messages"
    )
    joined = runs.join(good, _RUN, "left").join(bad, _RUN, "left").join(messages, _RUN, "left")
    counted = joined.withColumns(
        {"_good": F.coalesce("_good", F.lit(0)), "_bad": F.coalesce("_bad", F.lit(0))}
    )
    expected = F.coalesce("record_count", F.col("_good") + F.col("_bad"))
    status = F.when(F.col("run_error").isNotNull(), "failed").otherwise(
        run_status(F.col("_good"), F.col("_bad"), expected)
    )
    message = (
        F.when(F.col("run_error").isNotNull(), F.substring("run_error", 1, 2000))
        .when(F.col("status") == "failed", F.coalesce("_messages", F.lit("No records were processed")))
        .when(
            F.col("status") == "partial",
            F.coalesce("_messages", F.lit("Some records were not processed")),
        )
    )
    return (
        counted.withColumn("status", status)
        .withColumn("error_message", message)
        .withColumn(
            "processed_records",
            F.when(F.col("status") == "failed", 0).otherwise(F.col("_good")).cast("int"),
        )
        .drop("_good", "_bad", "_messages", "run_error")
    )


def advance_ledger(ledger: DataFrame, outcomes: DataFrame, parser_version: str) -> DataFrame:
    """Ledger after the outcomes: one row per run, created_at kept.

    ``processed_at`` moves only for processed and partial runs; the parser version
    of an earlier attempt stays when this one failed.
    """
    finished = F.col("new.status").isin("processed", "partial")
    now = F.current_timestamp()
    old, new = ledger.alias("old"), outcomes.alias("new")
    joined = old.join(new, _RUN, "full_outer")
    tried = F.col("new.status").isNotNull()

    def pick(column: str, fresh: Column) -> Column:
        return F.when(tried, fresh).otherwise(F.col(f"old.{column}")).alias(column)

    registered = ["source_key", "raw_path", "retrieved_at", "record_count", "payload_sha256"]
    return joined.select(
        *_RUN,
        *[F.coalesce(F.col(f"old.{c}"), F.col(f"new.{c}")).alias(c) for c in registered],
        pick("status", F.col("new.status")),
        pick("processed_records", F.col("new.processed_records")),
        pick(
            "parser_version",
            F.when(finished, F.lit(parser_version)).otherwise(F.col("old.parser_version")),
        ),
        pick("error_message", F.col("new.error_message")),
        *[F.col(f"old.{c}").alias(c) for c in ("attempt_id",) if c in ledger.columns],
        # Registration set the start; a ledger without it starts now.
        pick("processing_started_at", F.coalesce(F.col("old.processing_started_at"), now)),
        pick("processed_at", F.when(finished, now).otherwise(F.col("old.processed_at"))),
        F.coalesce(F.col("old.created_at"), now).alias("created_at"),
        pick("updated_at", now),
    )


def load_summary(discovered: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row of counters for a load; ``exit_code`` is 1 unless all went well."""
    rows = discovered.select(
        F.lit(True).alias("is_found"), F.lit(None).cast("string").alias("status"), F.lit(0).alias("n")
    ).unionByName(
        outcomes.select(F.lit(False).alias("is_found"), "status", F.col("processed_records").alias("n"))
    )
    status = F.col("status")
    counted = rows.agg(
        F.count_if("is_found").alias("discovered"),
        F.count_if(~F.col("is_found")).alias("_tried"),
        *[F.count_if(status == name).alias(name) for name in ("processed", "partial", "failed")],
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("records"),
    )
    return counted.select(
        "discovered", "processed", "partial",
        (F.col("discovered") - F.col("_tried")).alias("skipped"),
        "failed", "records",
        F.when((F.col("failed") > 0) | (F.col("partial") > 0), 1).otherwise(0).alias("exit_code"),
    )


def link_errors(errors: DataFrame, ledger: DataFrame) -> DataFrame:
    """Error rows of known runs, ready to append to the error history."""
    return errors.join(ledger.select(_RUN), _RUN).select(
        *_RUN, "source_job_id", "stage", "error_type",
        F.substring("error_message", 1, 2000).alias("error_message"),
    )
