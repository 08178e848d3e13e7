"""The incremental load as a stream over arriving snapshots.

The stream watches metadata files only: they are written after the response they
describe, so their arrival means the snapshot is complete. Each micro-batch runs
the same load as the batch job; its ledger makes a repeated batch harmless.

A file arrives once, but its run may fail or be left behind. The ledger is the queue
of such runs: every micro-batch, and every start without a new file, takes them up
again together with what arrived.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jobweft.plans.load import Rules, load_runs
from jobweft.sources.bronze import FACT_COLUMNS, RunFiles, folder_texts, parse_run_metadata
from jobweft.sources.silver import SilverTables


@dataclass(frozen=True)
class ArrivedRuns(RunFiles):
    """Runs whose metadata (run_dir, metadata_text) is at hand; folders without a response are no runs."""

    arrivals: DataFrame = None

    def facts(self) -> DataFrame:
        folders = [row.run_dir for row in self.arrivals.select("run_dir").distinct().collect()]
        bodies = folder_texts(self.spark, folders, "response.json", "payload").select("run_dir")
        return (
            parse_run_metadata(self.arrivals, F.col("metadata_text"))
            .join(F.broadcast(bodies), "run_dir", "left_semi")
            .withColumn("adapter_id", F.lit(self.adapter_id))
            .withColumnRenamed("run_dir", "raw_path")
            .select(FACT_COLUMNS)
        )


def waiting_folders(tables: SilverTables, bronze_root: str, retry_partial: bool, limit: int) -> list[str]:
    """Folders below the root of runs that are not done, those tried longest ago first."""
    states = ["failed", "pending", "processing", *(["partial"] if retry_partial else [])]
    below = F.contains(F.col("raw_path"), F.lit(bronze_root.rstrip("/") + "/"))
    rows = tables.ledger().where(F.col("status").isin(states) & below).orderBy("updated_at", "raw_path").limit(limit)
    return [row.raw_path for row in rows.select("raw_path").collect()]


def stream_loads(
    spark: SparkSession,
    bronze_root: str,
    adapter_id: str,
    silver_root: str,
    checkpoint: str,
    rules: Rules | None = None,
    *,
    max_files_per_trigger: int = 1000,
    retry_partial: bool = False,
) -> StreamingQuery:
    """Load all snapshots that arrived since the last start, and those that failed, then stop.

    At most ``max_files_per_trigger`` arrivals and as many waiting runs are taken up at
    a time. ``retry_partial`` also reads runs again of which some records were bad.
    """
    arrivals = (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("pathGlobFilter", "metadata.json")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(bronze_root)
        .select(
            F.regexp_replace(F.col("_metadata.file_path"), "/[^/]+$", "").alias("run_dir"),
            F.col("value").alias("metadata_text"),
        )
    )

    def take_up(session: SparkSession, batch: DataFrame | None) -> None:
        tables = SilverTables(session, silver_root)
        folders = waiting_folders(tables, bronze_root, retry_partial, max_files_per_trigger)
        again = folder_texts(session, folders, "metadata.json", "metadata_text")
        found = again if batch is None else batch.unionByName(again).dropDuplicates(["run_dir"])
        if found.isEmpty():
            return
        source = ArrivedRuns(session, bronze_root, adapter_id, found)
        load_runs(session, source, tables, rules, retry_partial=retry_partial)

    # Without a new file no micro-batch comes.
    take_up(spark, None)
    return (
        arrivals.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, _: take_up(batch.sparkSession, batch))
        .start()
    )
