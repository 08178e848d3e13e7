"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Adaptive execution splits hot join partitions and coalesces small ones; the
#: planner broadcasts a join side only while its measured size is below the
#: threshold and falls back to a shuffled join otherwise.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Files of checkpoints that nothing refers to any more are deleted.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "jobweft", master: str | None = None, **conf: str) -> SparkSession:
    """Create or reuse a session; values given by the cluster are kept."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from ``spark.checkpoint.dir``.

    Where that is not set, a folder in the warehouse serves, which driver and
    executors share on a cluster as well.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", f"{warehouse}/_checkpoints"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result outlives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_measured(df: DataFrame) -> DataFrame:
    """Reliable checkpoint that knows its size, for what a loop joins again in each round.

    The planner takes the product of both sides as the size of a join, and a checkpoint
    keeps that guess: after some rounds it is a number of millions of digits. What was
    persisted is measured, and the checkpoint made from it has the measured size.
    """
    held = df.persist()
    held.count()
    out = cut_lineage(held.select("*"))
    held.unpersist()
    return out
