"""Shards by jump consistent hashing, and a gapless place for each row in its shard.

Jump hashing follows a key through the shard counts at which it would move; the last
of these below the count is its shard. No ring or table is held, and with one shard
more exactly the keys whose next jump lands on the new one move, all of them there.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

#: Rows of a shard are numbered in so many parts, whose counts are then added up.
PARTS = 4096

#: Fixed values of jump consistent hashing: the multiplier of its generator and 2^31.
JUMP_MULTIPLIER, JUMP_SCALE = 2862933555777941757, float(1 << 31)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key among ``shards``; all keys still jumping go on together."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    at = np.zeros(len(state), np.int64)
    to = np.zeros(len(state), np.int64)
    going = np.arange(len(state))
    while len(going):
        at[going] = to[going]
        state[going] = state[going] * np.uint64(JUMP_MULTIPLIER) + np.uint64(1)
        step = JUMP_SCALE / ((state[going] >> np.uint64(33)).astype(np.float64) + 1.0)
        to[going] = np.minimum((at[going] + 1) * step, float(1 << 62)).astype(np.int64)
        going = going[to[going] < shards]
    return at


def shard_column(key, shards: int):
    """Arrow-batched column with the shard of an integer column."""

    def assign(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64), shards).astype(np.int32))

    return F.pandas_udf(assign, IntegerType())(key)


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``.

    The id and the number of shards alone decide the shard (law ``key``);
    ``grown_shard`` is the one among one shard more. ``size`` is the UTF-8 bytes of
    the text (none for null) plus 16, ``text_crc32`` is null for a null text. Slots
    number a shard's rows from 0 without gaps: rows are spread over ``PARTS`` parts
    by a hash of id and text, numbered there, and moved up by the rows of the parts
    before, so that no task holds a shard. Rows without id use key 0. Repeated rows
    go to the same shard and get slots of their own. Columns of ``docs`` with one of
    the new names are replaced. Only the new columns and the id are shuffled to
    number rows; an empty table gives an empty result.
    """
    new = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    key = F.coalesce(F.col(id_col), F.lit(0)).cast("bigint")
    marked = docs.select(
        *[F.col(c) for c in docs.columns if c not in new],
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.crc32(F.col(text_col).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_column(key, shards).alias("shard"),
        shard_column(key, shards + 1).alias("grown_shard"),
    ).withColumn("__part", F.pmod(F.xxhash64(id_col, "text_crc32", "size"), F.lit(PARTS)).cast("int"))
    sizes = marked.groupBy("shard", "__part").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "shard", "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start")
    )
    inside = Window.partitionBy("shard", "__part").orderBy(id_col, "text_crc32", "size")
    placed = marked.withColumn("__place", F.row_number().over(inside)).join(starts, ["shard", "__part"])
    kept = [c for c in docs.columns if c not in new]
    return placed.withColumn("slot", F.col("__start") + F.col("__place") - 1).select(*kept, *new)
