"""Attribute every run to the board its postings belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweft.functions.text import optional_text


def attribute_runs(runs: DataFrame, boards: DataFrame) -> DataFrame:
    """Add ``source_key``; a run of a foreign source gets a ``run_error``.

    The source in the metadata is a board key or just the adapter. For the
    adapter, the key named in the context counts, then the first board of that
    company (trimmed), then the adapter itself. Boards that are no longer fetched
    count too: their waiting runs belong to them.
    """
    by_key = boards.select("adapter_id", F.col("source_key").alias("source_id")).distinct()
    by_key = by_key.withColumn("_known", F.lit(True))
    by_company = boards.groupBy("adapter_id", F.col("company").alias("_company")).agg(
        F.min_by("source_key", "board_ord").alias("_company_key")
    )
    is_adapter = F.col("source_id") == F.col("adapter_id")
    mismatch = F.concat(
        F.lit("Raw run source mismatch: adapter="), F.col("adapter_id"),
        F.lit(", metadata="), F.col("source_id"),
    )
    return (
        runs.join(by_key, ["adapter_id", "source_id"], "left")
        .withColumn("_company", optional_text(F.col("context_company")))
        .join(by_company, ["adapter_id", "_company"], "left")
        .withColumn(
            "run_error",
            F.coalesce("run_error", F.when(F.col("_known").isNull() & ~is_adapter, mismatch)),
        )
        .withColumn(
            "source_key",
            F.when(~is_adapter, F.col("source_id")).otherwise(
                F.coalesce("context_source_key", "_company_key", "adapter_id")
            ),
        )
        .drop("_known", "_company", "_company_key")
    )
