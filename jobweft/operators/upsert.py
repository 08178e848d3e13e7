"""Posting upsert and the snapshot lifecycle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def posting_key(source_key: Column, source_job_id: Column) -> Column:
    """Stable key of a posting, the same in every load."""
    return F.sha2(F.concat_ws("\u0001", source_key, source_job_id), 256)


def latest_per_key(
    rows: DataFrame, keys: list[str], order: list[str], *, first: dict[str, str] | None = None
) -> DataFrame:
    """The last row of every key by ``order``; ``first`` keeps the least of a column.

    Where several rows are last, a hash of the whole row decides. Each input partition
    passes on only its last row of a key, so a key repeated in a third of the input costs
    no more than others; least values go the same way, without the rows.
    """
    last = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order], F.xxhash64(*rows.columns))
    newest = rows.withColumn("_n", F.row_number().over(last)).where(F.col("_n") == 1).drop("_n")
    if not first:
        return newest
    least = rows.groupBy(*keys).agg(*[F.min(column).alias(f"_first_{name}") for name, column in first.items()])
    named = least.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[f"_first_{name}" for name in first])
    joined = newest.join(named, _same_keys(keys, "", "_key_"))
    return joined.select(*[F.col(f"_first_{c}").alias(c) if c in first else F.col(c) for c in rows.columns])


def _same_keys(keys: list[str], left: str, right: str) -> Column:
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"{left}{key}").eqNullSafe(F.col(f"{right}{key}"))
    return same


def merged_rows(state: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``old`` and ``new`` row of every key, and whether the new one replaces the old (``_replaces``).

    ``batch`` is reduced to its last row of each key first and meets the state in one full
    join by key: a state that is stored in buckets of the key is neither shuffled nor
    sorted for it. A new row that is older than the stored one does not replace it.
    """
    new = latest_per_key(batch, keys, order)
    left = state.select(*keys, F.struct(*state.columns).alias("old"))
    right = new.select(*keys, F.struct(*new.columns).alias("new"))

    def moment(row: str) -> Column:
        return F.struct(*[F.col(f"{row}.{c}") for c in order])

    replaces = F.col("new").isNotNull() & (F.col("old").isNull() | (moment("new") >= moment("old")))
    return left.join(right, keys, "full").withColumn("_replaces", F.coalesce(replaces, F.lit(False)))


def upsert(state: DataFrame, batch: DataFrame, keys: list[str], order: list[str], kept: list[str]) -> DataFrame:
    """Last write wins; columns in ``kept`` stay what they were first set to.

    Both frames have the same columns, and the state one row for each key, without null
    keys. A late row that is older than the stored one does not replace it.
    """
    first = batch.groupBy(*keys).agg(*[F.min(c).alias(f"_first_{c}") for c in kept]) if kept else None
    rows = merged_rows(state, batch, keys, order)
    if first is not None:
        rows = rows.join(first, keys, "left")
    columns = [
        F.least(F.col(f"old.{c}"), F.col(f"_first_{c}")).alias(c)
        if c in kept
        else F.when(F.col("_replaces"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
        for c in state.columns if c not in keys
    ]
    return rows.select(*keys, *columns)


def child_delta(
    state: DataFrame, batch: DataFrame, keys: list[str], order: list[str], children: str
) -> DataFrame:
    """What replacing the children of upserted rows does to a table of them: ``(*keys, child, op)``.

    ``children`` is an array column. A row that replaces another one deletes the children
    that only the old one had and inserts those that only the new one has; what both have
    is left alone, and so is everything of rows that are not replaced. Children are
    distinct; a null array has none.
    """
    rows = merged_rows(state, batch, keys, order).where("_replaces")
    kind = dict(state.dtypes)[children]
    none = F.array().cast(kind)
    old, new = (F.coalesce(F.col(f"{side}.{children}"), none) for side in ("old", "new"))

    def marked(found: Column, op: str) -> Column:
        return F.transform(found, lambda child: F.struct(child.alias("child"), F.lit(op).alias("op")))

    changes = F.concat(marked(F.array_except(old, new), "delete"), marked(F.array_except(new, old), "insert"))
    return rows.select(*keys, F.explode(changes).alias("_change")).select(*keys, "_change.*")


def snapshot_cutoffs(ledger: DataFrame) -> DataFrame:
    """Time of the newest complete snapshot per board (source_key, cutoff).

    Runs that failed or were only partly read do not count.
    """
    return (
        ledger.where(F.col("status") == "processed")
        .groupBy("source_key")
        .agg(F.max("retrieved_at").alias("cutoff"))
    )


def deactivate_missing(postings: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Active postings last seen before their board's cutoff become inactive."""
    gone = (F.col("status") == "active") & (F.col("last_seen_at") < F.col("cutoff"))
    return postings.join(cutoffs, "source_key", "left").select(
        *[
            F.when(gone, "inactive").otherwise(F.col("status")).alias("status")
            if c == "status"
            else F.when(gone, F.current_timestamp()).otherwise(F.col("updated_at")).alias(c)
            if c == "updated_at"
            else F.col(c)
            for c in postings.columns
        ]
    )
