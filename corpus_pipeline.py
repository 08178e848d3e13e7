"""A corpus from raw documents: five stages, each a table that the next one reads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from jobweft.llm import catalog, decontaminate, mixing, near_dedup, quality, sharding
from jobweft.llm.common import table
from jobweft.session import ensure_checkpoint_dir

#: Documents with a lower score are rejected.
LEAST_SCORE = 0.7

SHARDS = 40


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones."""
    scored = quality.score(docs, catalog.quality_model(spark, sf_dir), name="__score")
    return scored.where(f"__score >= {LEAST_SCORE}").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8)."""
    return near_dedup.keep_one(docs, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and place in it."""
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The classifier, the latent search and the draws of the mix are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read again.

    A stage's input is deleted once its result is written; the last result stays.
    """
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            place = spark._jvm.org.apache.hadoop.fs.Path(before)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        before = path
    return docs
