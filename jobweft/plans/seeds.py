"""Dimension seeds, derived from the dictionaries and the board registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobweft.operators.dictionary import AliasDictionary
from jobweft.settings import Board

#: Dimensions whose names have a fixed order.
_RANKED = ("seniority_levels", "proficiency_levels", "requirement_types")

#: All dimensions share one table; only sources have a key besides their name.
DIMENSIONS = "dimension string, name string, source_key string, sort_order smallint"


def seed_frame(
    spark: SparkSession, dictionaries: dict[str, AliasDictionary], boards: list[Board]
) -> DataFrame:
    """Seed rows of every dimension; ranked ones get sort_order 10, 20, 30, ..."""
    rows = [("sources", b.company, b.source_key, None) for b in boards]
    for table, dictionary in dictionaries.items():
        for i, name in enumerate(dictionary.names):
            rows.append((table, name, None, 10 * (i + 1) if table in _RANKED else None))
    return spark.createDataFrame(rows, DIMENSIONS).coalesce(1)


def missing_seeds(seed: DataFrame, dimension: DataFrame, *key: str) -> DataFrame:
    """Seed rows the dimension does not have yet, to be appended."""
    return seed.join(dimension.select(*key), list(key), "left_anti").select(seed.columns)
