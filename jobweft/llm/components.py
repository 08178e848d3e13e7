"""Connected components by alternating stars, as joins and grouped minima."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobweft.llm.common import settled


def _oriented(edges: DataFrame) -> DataFrame:
    return (
        edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.union(edges.select("v", "u").toDF("u", "v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.toDF("u", "v"))


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        F.sum((F.col("v").cast("decimal(38,0)"))).alias("s"),
    ).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``edges(u, v)``, as ``(id, component)``.

    Nodes are integers; edges with a null end and loops say nothing and are left out,
    repeated ones count once. Nodes without an edge are not in the result. The
    number of rounds is logarithmic, as a round shortens every path; a round is two
    grouped minima (combined before their shuffle) and two joins whose hot keys
    adaptive execution splits. Only a row count and two sums come to the driver.
    """
    current = settled(_oriented(edges))
    before = _digest(current)
    while before[0]:
        current = settled(_oriented(_small_star(_oriented(_large_star(current)))))
        after = _digest(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        current.select("v", "v").distinct().toDF("id", "component")
    )


#: Members of a bucket up to which all are hubs at once, and hubs of a larger one.
WHOLE, FIRST_HUBS = 1024, 64


def labelled(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members with their component (``comp``), their own where nothing links them."""
    right = found.withColumnRenamed("id", "rep")
    return members.join(right, "rep", "left").withColumn("comp", F.coalesce("component", "rep")).drop("component")


def mixed_members(members: DataFrame) -> DataFrame:
    """Members with ``comp`` of the buckets that hold several, with their component's and bucket's sizes."""
    sizes = members.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("size"))
    mixed = (
        sizes.groupBy("bucket")
        .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.sum("size").alias("members"))
        .where("lo <> hi").select("bucket", "members")
    )
    return members.join(sizes.join(mixed, "bucket"), ["bucket", "comp"])


def _relabelled(rows: DataFrame, column: str, renamed: DataFrame) -> DataFrame:
    """``rows`` with components replaced by those that ``renamed(id, component)`` has for them."""
    names = renamed.toDF("__id", "__component")
    return rows.join(names, F.col(column) == F.col("__id"), "left").withColumn(
        column, F.coalesce("__component", column)
    ).drop("__id", "__component")


def linked_members(
    members: DataFrame,
    found: DataFrame,
    compare: Callable[[DataFrame], DataFrame],
    condition: str = "true",
    about: list[str] | None = None,
) -> DataFrame:
    """Components after linking ``members(bucket, rep, *about)`` of the same bucket.

    ``found(id, component)`` holds what is linked already; ``compare`` returns those
    of the pairs ``(a, b)`` that are links. Each round, a bucket that still holds
    several components takes hubs, those of its smallest components first: all members
    of a bucket of ``WHOLE`` or fewer, else ``FIRST_HUBS``, and four times as many
    each round. Hubs meet the members of other components for which ``condition``
    holds (their columns are named ``hub_*``) and then leave. A bucket ends when one
    component is left, so every pair of a bucket is either joined already, ruled out
    by the condition, or compared.

    New links unite components, not members: only they go through
    ``connected_components``, and members take the new names by a join. A task takes
    no more members of a large bucket to find its hubs than it has hubs.
    """
    about, hubs = about or [], FIRST_HUBS
    renamed = None
    members = settled(mixed_members(labelled(members, found)))
    while not members.isEmpty():
        order = Window.partitionBy("bucket").orderBy("size", F.xxhash64("rep"), "rep")
        crowded = members.where(F.col("members") > WHOLE).withColumn("place", F.row_number().over(order))
        hub_rows = members.where(F.col("members") <= WHOLE).unionByName(crowded.where(F.col("place") <= hubs).drop("place"))
        chosen = settled(hub_rows.select("bucket", *[F.col(c).alias(f"hub_{c}") for c in ["rep", "comp", *about]]))
        pairs = members.join(chosen, "bucket").where("comp <> hub_comp").where(condition)
        more = settled(compare(pairs.select(F.least("hub_rep", "rep").alias("a"), F.greatest("hub_rep", "rep").alias("b"))))
        left = members.join(
            chosen.select("bucket", F.col("hub_rep").alias("rep")), ["bucket", "rep"], "left_anti"
        ).select("bucket", "rep", "comp", *about)
        if not more.isEmpty():
            comps = members.select(F.col("rep").alias("id"), F.col("comp").alias("component")).distinct()
            edges = _relabelled(_relabelled(more.toDF("u", "v"), "u", comps), "v", comps)
            united = settled(connected_components(edges))
            left = _relabelled(left, "comp", united)
            renamed = united if renamed is None else settled(
                _relabelled(renamed, "component", united).unionByName(united.join(renamed, "id", "left_anti"))
            )
        members = settled(mixed_members(left))
        hubs *= 4
    if renamed is None:
        return found
    return _relabelled(found, "component", renamed).unionByName(
        renamed.join(found, "id", "left_anti").select("id", "component")
    )
