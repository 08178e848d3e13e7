"""Mixing sources to target weights by pivotal rounding, in DataFrame functions only.

Every row of a source is to be taken ``target / source size`` times. The whole part
is certain; the fraction is rounded in pairs. Of two fractional rows, words are moved
from one to the other, in a random direction whose odds keep both expectations, until
one of them is taken wholly or not at all. As words move and none are made, a
source's taken words change only when its very last row is rounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobweft.llm.common import WORD_PATTERN, same, settled

#: Weights of the sources in order, repeating, and their share of all words.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2

#: Rows, and then remainders, that one fold combines on average.
FOLD = 128


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame) -> DataFrame:
    """``sources(source, source_size, ...)`` with ``target``, the words to take.

    Sources are ordered by code point, null last, and get ``WEIGHTS`` in turn. A
    target stops at ``MOST`` times the source; what is above is shared again by
    weight. The level at which sharing ends is found from running sums over the
    sources sorted by the level that fills them. One row per source is sorted here.
    """
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    cap = F.col("source_size").cast("double") * MOST
    ranked = (
        sources.withColumn("__weight", weight)
        .withColumn("__cap", cap)
        .withColumn("__level", F.col("__cap") / F.col("__weight"))
        .withColumn("__total", F.sum("source_size").over(everything) * F.lit(SHARE))
    )
    before = Window.orderBy("__level", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("__cap").over(before), F.lit(0.0))
    heavy = F.sum("__weight").over(everything) - F.coalesce(F.sum("__weight").over(before), F.lit(0.0))
    levels = ranked.withColumn("__here", (F.col("__total") - filled) / heavy)
    level = F.max(F.when(F.col("__level") >= F.col("__here"), F.col("__here"))).over(everything)
    return levels.withColumn(
        "target", F.least(F.col("__cap"), F.coalesce(level, F.lit(0.0)) * F.col("__weight"))
    ).drop("__weight", "__cap", "__level", "__total", "__here")


def _chance(level: int, seed: int, a: Column, b: Column) -> Column:
    bits = F.xxhash64(F.lit(seed), F.lit(level), a["id"], a["size"], b["id"], b["size"])
    return F.pmod(bits, F.lit(1 << 53)).cast("double") / float(1 << 53)


def _folded(rows: DataFrame, level: int, seed: int) -> DataFrame:
    """Fold the units of each ``(source, block)``: decisions and one remainder."""
    unit = F.struct((-F.col("cap")).alias("order"), "id", "size", "copies_of", "cap", "mass")
    units = F.sort_array(F.collect_list(unit))
    decided = "array<struct<id:bigint,size:bigint,copies_of:bigint,taken:int>>"

    def step(acc: Column, b: Column) -> Column:
        a, done = acc["rest"], acc["done"]
        up = _chance(level, seed, a, b) * (
            F.least(a["cap"] - a["mass"], b["mass"]) + F.least(a["mass"], b["cap"] - b["mass"])
        ) <= F.least(a["mass"], b["cap"] - b["mass"])
        first = F.when(up, a["cap"] - a["mass"] <= b["mass"]).otherwise(a["mass"] <= b["cap"] - b["mass"])
        ended, going = F.when(first, a).otherwise(b), F.when(first, b).otherwise(a)
        taken = (up == first).cast("int")
        rest = F.struct(
            going["order"].alias("order"),
            going["id"].alias("id"),
            going["size"].alias("size"),
            going["copies_of"].alias("copies_of"),
            going["cap"].alias("cap"),
            (a["mass"] + b["mass"] - taken * ended["cap"]).alias("mass"),
        )
        entry = F.struct(
            ended["id"].alias("id"), ended["size"].alias("size"), ended["copies_of"].alias("copies_of"),
            taken.alias("taken"),
        )
        return F.struct(rest.alias("rest"), F.array_append(done, entry).alias("done"))

    grouped = rows.groupBy("source", "block").agg(units.alias("units"))
    start = F.struct(
        F.col("units")[0].alias("rest"), F.array().cast(decided).alias("done")
    )
    folded = F.aggregate(F.slice("units", 2, F.size("units")), start, step)
    return grouped.select("source", "block", folded.alias("f")).select("source", "block", "f.rest", "f.done")


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 1):
    """How often each row is taken: ``(id, source, size, copies_of, source_size, target, copies)``.

    ``size`` counts the words of the text (0 for null). Rows with equal id, source
    and size are one unit of ``copies_of`` rows that share one decision. ``copies``
    is the whole part of ``target / source_size`` plus the rounded fraction, so it
    never passes ``MOST``; units without words get the whole part only.

    A source's units are dealt to blocks of about ``FOLD`` units by a hash, however
    large the source; each block is folded into decisions and one remainder, the
    remainders are folded again by blocks of ``FOLD``, and so on up to one remainder
    per source, which goes to the nearer whole number. So a source misses its target
    by half of one unit at most. Chances come from hashes: reruns agree. A null
    source is a source, null ids count as one id; an empty table gives no rows.
    """
    units = settled(
        docs.select(
            F.col(id_col).cast("bigint").alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size")
        ).groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("copies_of"))
    )
    sources = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies_of")).alias("source_size"), F.count(F.lit(1)).alias("__units")
    )
    aimed = settled(targets(sources))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goals = aimed.select(
        F.col("source").alias("__source"), "source_size", "target", ratio.alias("__ratio"),
        F.ceil(F.col("__units") / FOLD).alias("__blocks"),
    )
    joined = units.join(goals, same("source", "__source")).drop("__source")
    fraction = F.col("__ratio") - F.floor("__ratio")
    cap = (F.col("size") * F.col("copies_of")).cast("double")
    open_units = joined.where((fraction > 0) & (F.col("size") > 0)).select(
        "source", "id", "size", "copies_of", cap.alias("cap"), (cap * fraction).alias("mass"),
        F.pmod(F.xxhash64(F.lit(seed), "id", "size"), F.col("__blocks")).alias("block"),
    )
    most = goals.agg(F.max("__blocks")).first()[0] or 0
    decisions, level = [], 0
    while True:
        folded = settled(_folded(open_units, level, seed))
        decisions.append(folded.select("source", F.explode("done").alias("d")).select("source", "d.*"))
        if most <= 1:
            break
        most, level = -(-most // FOLD), level + 1
        open_units = folded.select("source", F.expr(f"block div {FOLD}").alias("block"), "rest.*")
    last = folded.select("source", "rest.*").select(
        "source", "id", "size", "copies_of", (F.col("mass") * 2 >= F.col("cap")).cast("int").alias("taken")
    )
    for part in decisions:
        last = last.union(part)
    extra = last.select(
        F.col("id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), "taken"
    )
    return (
        joined.join(extra, same("id", "__id") & same("source", "__source") & (F.col("size") == F.col("__size")), "left")
        .select(
            "id", "source", "size", "copies_of", "source_size", "target",
            (F.floor("__ratio") + F.coalesce("taken", F.lit(0))).cast("bigint").alias("copies"),
        )
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 1):
    """``docs`` with every row as often as the mix takes it (see ``copies``)."""
    taken = copies(docs, id_col, text_col, source_col, seed).where("copies > 0").select(
        F.col("id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), "copies"
    ).withColumnRenamed("copies", "__copies")
    sized = docs.withColumn("__words", word_count(text_col)).withColumn("__key", F.col(id_col).cast("bigint"))
    return (
        sized.join(
            taken,
            same("__key", "__id") & F.col(source_col).eqNullSafe(F.col("__source")) & (F.col("__words") == F.col("__size")),
        )
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
        .select(*[F.col(c) for c in docs.columns])
    )
