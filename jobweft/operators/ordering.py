"""Gapless numbers in a total order, without a sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobweft.session import cut_lineage


def with_ordinal(df: DataFrame, order: list[str | Column], name: str = "ordinal") -> DataFrame:
    """``df`` with the place of every row in the order of ``order``, from 0 without gaps.

    Rows are dealt to ranges of the order and sorted there; a row's number is its place
    in its range and the rows of the ranges before, which are counted first: one row for
    each range, however many rows there are. Nulls come first. Rows that are equal by
    ``order`` get successive numbers; a random number parts them, so that a value with a
    third of all rows is no single range.
    """
    ranges = df.withColumn("_tie", F.rand(11)).repartitionByRange(*order, "_tie")
    sorted_rows = ranges.sortWithinPartitions(*order, "_tie").drop("_tie")
    # The number of a range and the place in it, kept so that both steps see the same.
    placed = cut_lineage(sorted_rows.withColumn("_at", F.monotonically_increasing_id()))
    of = F.shiftright("_at", 33)
    sizes = placed.groupBy(of.alias("_range")).agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut_lineage(
        sizes.select("_range", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    )
    # One row for each range of the step before: as few as it had tasks.
    joined = placed.join(F.broadcast(starts), of == F.col("_range"))
    return joined.withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


def run_order(runs: DataFrame, sources: DataFrame) -> DataFrame:
    """``runs`` with ``ordinal``: by the configured order of their adapters, then by path.

    ``sources`` has (adapter_id, source_ord). Adapters that are not configured come
    last, by name.
    """
    placed = runs.join(F.broadcast(sources.select("adapter_id", "source_ord")), "adapter_id", "left")
    order = [F.col("source_ord").asc_nulls_last(), F.col("adapter_id"), F.col("raw_path")]
    return with_ordinal(placed, order).drop("source_ord")
