"""Merkle manifest of a dataset: levels of a tree as hex strings, cut by fixed widths.

Leaves of a group (a language, say) are numbered in order and dealt to aligned blocks of
``BLOCK`` consecutive ones. A block holds one level of its part of the tree as a string
of 64 hex digits a node. Parents are the hashes of substrings of twice that width, so the
next level is again one string. Beside a node, the substrings left and right of it in its
run are its siblings. The roots of a group's blocks are the leaves of the next round, until
each group has one node; the groups' nodes are the leaves of the last tree.

All of it is SQL expressions. No task holds more of a group than a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobweft.llm.common import settled, sized

#: Consecutive nodes that become one, and nodes of a block, a power of it.
RUN, DEPTH = 2, 8
BLOCK = RUN**DEPTH

#: Hex digits of a hash.
WIDTH = 64


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: list[Column]) -> Column:
    return digest(F.concat(*map(framed, columns)))


def _parents(level: Column) -> Column:
    """The level above, by one hash for each run of nodes."""
    last = F.floor((F.length(level) - 1) / F.lit(RUN * WIDTH)).cast("int")
    run = F.lit(RUN * WIDTH)
    hashes = F.transform(F.sequence(F.lit(0), last), lambda k: digest(F.substring(level, k * run + 1, run)))
    return F.array_join(hashes, "")


def levels(level: Column, n: Column) -> Column:
    """Levels of a block from ``level`` up, in a group of ``n`` nodes.

    A group of several blocks goes through all ``DEPTH`` levels in each of them, also in
    the last, shorter one; a group of one block ends with one node.
    """
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(DEPTH - 1)),
        F.array(level),
        lambda held, k: F.when(
            n > F.pow(F.lit(RUN), k), F.concat(held, F.array(_parents(F.element_at(held, -1))))
        ).otherwise(held),
    )


def siblings(held: Column, at: Column) -> Column:
    """What stands left and right of the path from node ``at`` of the lowest level, level by level."""

    def flanks(level: Column, k: Column) -> Column:
        own = F.floor(at / F.pow(F.lit(RUN), k)).cast("int")
        first = own - own % RUN
        return F.struct(
            F.substring(level, first * WIDTH + 1, (own - first) * WIDTH).alias("before"),
            F.substring(level, (own + 1) * WIDTH + 1, (first + RUN - own - 1) * WIDTH).alias("after"),
        )

    return F.transform(F.slice(held, F.lit(1), F.size(held) - 1), flanks)


def folded(node: Column, path: Column) -> Column:
    """The root that a node and the siblings of its path give."""
    return F.aggregate(path, node, lambda held, s: digest(F.concat(s["before"], held, s["after"])))


def sibling_text(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with their place in their group by ``order`` (``at``) and the group's rows (``n``).

    Rows are dealt to ranges and sorted there; the rows of a group in the ranges before
    are added, which needs one row for each group and range. Equal rows may take each
    other's place; a random number parts them, so that they are no single range.
    """
    salted = rows.withColumn("__tie", F.rand(7))
    placed = settled(
        salted.repartitionByRange(F.col(group), *order, F.col("__tie")).sortWithinPartitions(group, *order)
        .drop("__tie").withColumn("__at", F.monotonically_increasing_id())
    )
    ranges = placed.groupBy(F.col(group).alias("__group"), F.shiftright("__at", 33).alias("__range")).agg(
        F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    per_group = Window.partitionBy("__group")
    earlier = per_group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = settled(ranges.select(
        "__group", "__range", (F.col("__first") - F.coalesce(F.sum("__rows").over(earlier), F.lit(0))).alias("__shift"),
        F.sum("__rows").over(per_group).alias("n"),
    ))
    joined = placed.join(
        sized(starts, 64), F.col(group).eqNullSafe(F.col("__group")) & (F.shiftright("__at", 33) == F.col("__range"))
    )
    return joined.withColumn("at", F.col("__at") - F.col("__shift")).drop("__at", "__group", "__range", "__first", "__shift")


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row a block of ``nodes(grp, at, n, hash, *rest)``: its lowest level, and the rest of its nodes in order."""
    rest = [c for c in nodes.columns if c not in ("grp", "at", "n")]
    return (
        nodes.groupBy("grp", F.floor(F.col("at") / BLOCK).alias("block"), "n")
        .agg(F.sort_array(F.collect_list(F.struct("at", *rest))).alias("nodes"))
        .withColumn("level", F.array_join("nodes.hash", ""))
    )


def _roots(blocks: DataFrame) -> DataFrame:
    """For each of ``blocks``, the siblings ``up`` of its root and the root ``top`` of its group."""
    top = F.element_at(levels(F.col("level"), F.col("n")), -1)
    # In two steps: inside a lambda, ``n`` would mean a new column of that name in the same select.
    roots = settled(
        blocks.select("grp", "block", "n", top.alias("hash"))
        .select("grp", F.col("block").alias("at"), F.ceil(F.col("n") / BLOCK).alias("n"), "hash")
    )
    none = F.array().cast("array<struct<before:string,after:string>>")
    single = roots.where("n = 1").select("grp", F.col("at").alias("block"), none.alias("up"), F.col("hash").alias("top"))
    several = roots.where("n > 1")
    if several.isEmpty():
        return single
    return single.union(_paths(several).select("grp", F.col("at").alias("block"), F.col("path").alias("up"), "top"))


def _paths(nodes: DataFrame, crowned: bool = False) -> DataFrame:
    """``nodes(grp, at, n, hash, *rest)`` with ``path`` and ``top``, the root of their group.

    If ``crowned``, paths go on to the root of all groups, ``root``.
    """
    blocks = settled(_blocks(nodes))
    roots = _roots(blocks)
    if crowned:
        roots = settled(roots)
        tops = numbered(roots.select("grp", "top").distinct().withColumn("all", F.lit(0)), "all", ["grp"])
        crowns = _paths(tops.select(F.col("all").alias("grp"), "at", "n", F.col("top").alias("hash"), F.col("grp").alias("of")))
        ends = crowns.select("of", F.col("path").alias("crown"), F.col("top").alias("root"))
        joined = roots.join(ends, F.col("grp").eqNullSafe(F.col("of")))
        roots = joined.select("grp", "block", F.concat("up", "crown").alias("up"), "top", "root")
    ends = [c for c in roots.columns if c not in ("grp", "block", "up")]
    right = roots.select(F.col("grp").alias("__grp"), F.col("block").alias("__block"), "up", *ends)
    met = blocks.join(right, F.col("grp").eqNullSafe(F.col("__grp")) & (F.col("block") == F.col("__block")))
    held = met.withColumn("held", levels(F.col("level"), F.col("n")))

    def proven(node: Column) -> Column:
        return F.struct(
            node.alias("node"), F.concat(siblings(F.col("held"), node["at"] % BLOCK), F.col("up")).alias("path")
        )

    each = held.select("grp", *ends, F.explode(F.transform("nodes", proven)).alias("each"))
    return each.select("grp", "each.node.*", "each.path", *ends)


def merkle_proofs(leaves: DataFrame, group: str, order: list[str], leaf: str) -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` and ``path``.

    Leaves of a group stand in ascending ``order`` (nulls first; ties by the hash), and
    every ``RUN`` consecutive nodes of a level become one, the last run having fewer or
    one, while there are several. The group's last node is ``subroot``; those, in order
    of their groups (null first), make the tree of ``root`` in the same way. ``path`` has
    the siblings of a leaf's path, ``before`` and ``after`` it, from its level to the
    root; a lone leaf has none. Repeated rows are leaves of their own. An empty table
    gives no rows. Columns of ``leaves`` must not be named like the new ones or ``grp``,
    ``at``, ``n`` and ``hash``.
    """
    rest = [c for c in leaves.columns if c not in (group, leaf)]
    named = leaves.select(F.col(group).alias("grp"), F.col(leaf).alias("hash"), *rest)
    nodes = numbered(named, "grp", [*order, "hash"])
    return _paths(nodes, crowned=True).select(
        *rest, F.col("grp").alias(group), F.col("hash").alias(leaf), F.col("top").alias("subroot"), "root", "path"
    )


def document_leaves(docs: DataFrame) -> DataFrame:
    """``(doc_id, lang, leaf, altered)`` of documents.

    A leaf hashes ``doc_id``, ``source``, ``lang``, ``n_chars`` and the whole text, null
    and empty values apart. ``altered`` is the leaf with one more in ``n_chars``, for the
    rows that a check of the proofs tampers with: 7 divides the CRC-32 of the id. It is
    null for others, and equal to the leaf if there is no ``n_chars``. Other columns are
    not read.
    """
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = [(c.cast("decimal(20,0)") + 1) if n == 3 else c for n, c in enumerate(columns)]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return docs.select(
        "doc_id", "lang", leaf_hash(columns).alias("leaf"), F.when(chosen, leaf_hash(more)).alias("altered")
    )


def document_proofs(docs: DataFrame) -> DataFrame:
    """``(doc_id, lang, leaf, altered, subroot, root, path)`` of documents, a tree for each language.

    Documents without language are a group before all others, those without id stand
    first in theirs.
    """
    return merkle_proofs(settled(document_leaves(docs)), "lang", ["doc_id"], "leaf")
