"""Document fingerprints by consistent weighted sampling, in built-in expressions only.

For each of ``SAMPLES`` draws, every word gets a random cell size ``r``, a shift and a
cost from its hash alone (two gamma variables and a uniform one, Ioffe's scheme). A
word's count is rounded down to a cell of its own logarithmic grid, and the word with
the smallest cost for its cell is the sample. Two texts draw the same word and cell
with the probability of their generalised Jaccard similarity: the sum of the smaller
counts over that of the larger ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobweft.llm.common import settled, sized

#: Samples of a fingerprint.
SAMPLES = 32

#: Ids that are sorted together when the next document is looked up.
NEIGHBOURS = 256


def _uniform(bits: Column, first: int, width: int) -> Column:
    return (F.shiftrightunsigned(bits, first).bitwiseAND(F.lit((1 << width) - 1)) + F.lit(0.5)) / F.lit(float(1 << width))


def least_costs(counted: DataFrame, keys: list[str], weights: list[str]) -> DataFrame:
    """Least cost per ``keys`` and ``round``, one column ``v0, v1, ...`` for each weight column.

    A value holds the cost of a term's cell, and the cell's identity in its low 24
    bits. The logarithm of a weight is taken once for all draws, and a draw's random
    numbers once for all weights; a weight of 0 has no logarithm and no value.
    """
    logs = counted.select(*keys, "term", *[F.when(F.col(w) > 0, F.log(w)).alias(f"l_{w}") for w in weights])
    drawn = (
        logs.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(SAMPLES - 1))))
        .withColumn("one", F.xxhash64("term", "round"))
        .withColumn("two", F.xxhash64("one"))
    )
    one, two = F.col("one"), F.col("two")
    random = drawn.withColumns(
        {
            "size": -F.log(_uniform(one, 0, 21) * _uniform(one, 21, 21)),
            "shift": _uniform(one, 42, 22),
            "cost": F.log(-F.log(_uniform(two, 0, 32) * _uniform(two, 32, 32))),
        }
    )
    size, shift, cost = F.col("size"), F.col("shift"), F.col("cost")
    cells = random.withColumns({f"c_{w}": F.floor(F.col(f"l_{w}") / size + shift) for w in weights})
    values = {}
    for n, w in enumerate(weights):
        cell = F.col(f"c_{w}")
        scaled = ((cost - size * (cell - shift) - size + 128.0) * float(1 << 30)).cast("bigint")
        identity = F.xxhash64(two, cell).bitwiseAND(F.lit((1 << 24) - 1))
        values[f"v{n}"] = F.shiftleft(scaled, 24).bitwiseOR(identity)
    return cells.select(*keys, "round", *[v.alias(c) for c, v in values.items()]).groupBy(*keys, "round").agg(
        *[F.min(c).alias(c) for c in values]
    )


def weighted_samples(texts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``keys`` with one array of samples for each text column; no row where all are without words.

    Words are the terms and their numbers of occurrences the weights. ``texts`` should
    be partitioned by some of ``keys``: then nothing is shuffled, as words are counted
    and the least costs kept inside the task that holds the text. However long a text
    is, only its distinct words are held.
    """
    sides = F.array(*[F.struct(F.lit(n).alias("side"), F.col(c).alias("text")) for n, c in enumerate(columns)])
    words = (
        texts.select(*keys, F.explode(sides).alias("s"))
        .select(*keys, "s.side", F.explode(F.split("s.text", r"[\x20\x09-\x0D]+")).alias("word"))
        .where("word <> ''")
        .select(*keys, "side", F.xxhash64("word").alias("term"))
    )
    counted = words.groupBy(*keys, "term").agg(
        *[F.sum((F.col("side") == n).cast("bigint")).alias(f"w{n}") for n in range(len(columns))]
    )
    least = least_costs(counted, keys, [f"w{n}" for n in range(len(columns))])
    rounds = least.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("round", *[f"v{n}" for n in range(len(columns))]))).alias("rounds")
    )
    return rounds.select(
        *keys,
        *[
            F.transform(
                F.col(f"rounds.v{n}"),
                lambda v: F.when(v.isNotNull(), F.xxhash64(v).bitwiseAND(F.lit(0xFFFFFFFF))),
            ).alias(f"samples_{n}")
            for n in range(len(columns))
        ],
    )


def fingerprint_text(samples: Column) -> Column:
    """Eight hexadecimal digits for each sample; empty for a text without words."""
    digits = F.transform(samples, lambda v: F.lpad(F.lower(F.hex(v)), 8, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; texts without words equal each other and nothing else."""
    none_a, none_b = F.coalesce(a[0].isNull(), F.lit(True)), F.coalesce(b[0].isNull(), F.lit(True))
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return F.when(none_a | none_b, (none_a & none_b).cast("double")).otherwise(equal / F.lit(float(SAMPLES)))


def _next_blocks(blocks: DataFrame) -> DataFrame:
    """``(block, next_block)``; the first block follows the last.

    Blocks are taken in groups of ``NEIGHBOURS`` and the groups once more, so no task
    sorts more than one row per square of that many ids.
    """
    grouped = blocks.withColumn("group", F.floor(F.col("block") / NEIGHBOURS))
    groups = grouped.groupBy("group").agg(F.min("block").alias("head"))
    over = Window.orderBy("group")
    heads = groups.select("group", F.coalesce(F.lead("head").over(over), F.min("head").over(Window.partitionBy())).alias("after"))
    inside = F.lead("block").over(Window.partitionBy("group").orderBy("block"))
    return grouped.withColumn("inside", inside).join(heads, "group").select(
        "block", F.coalesce("inside", "after").alias("next_block")
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text, of an edited text, and their likeness.

    The edited text has the last half of the code points replaced by as many from the
    beginning of the next document by ascending id (after the last: the first).
    Returns ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)`` for every row.

    Texts are shuffled once, by ranges of ``NEIGHBOURS`` ids, inside which the next
    document is the following row; only the first of each range is fetched once more
    for the range before. Words are counted and sampled where the texts are. A null
    text counts as empty; rows without id come first. Rows that share an id follow
    each other by a hash of their texts, so a repeated row's next document is its
    copy. A lone document is its own next one. An empty table gives no rows.
    """
    first_block = -(1 << 60)
    placed = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).select(
        "doc_id", "text", F.xxhash64("text").alias("h"),
        F.coalesce(F.floor(F.col("doc_id") / NEIGHBOURS), F.lit(first_block)).cast("bigint").alias("block"),
    )
    heads = settled(
        placed.groupBy("block").agg(F.min(F.struct("doc_id", "h")).alias("f")).select("block", "f.doc_id", "f.h")
    )
    following = _next_blocks(heads.select("block"))
    wanted = following.join(heads.withColumnRenamed("block", "next_block"), "next_block").select(
        F.col("block").alias("o_block"), F.col("next_block").alias("n_block"), F.col("doc_id").alias("n_id"), F.col("h").alias("n_h")
    )
    head_texts = settled(
        placed.join(
            sized(settled(wanted), 48),
            (F.col("block") == F.col("n_block")) & F.col("doc_id").eqNullSafe(F.col("n_id")) & (F.col("h") == F.col("n_h")),
        ).select("o_block", F.col("text").alias("o_text")).dropDuplicates(["o_block"])
    )
    head_samples = weighted_samples(head_texts, ["o_block"], ["o_text"]).withColumnRenamed("samples_0", "o_samples")

    order = Window.partitionBy("block").orderBy("doc_id", "h")
    lined = placed.select(
        "block", "doc_id", "text", F.row_number().over(order).alias("seq"), F.lead("text").over(order).alias("in_text")
    )
    joined = lined.join(head_texts, (F.col("block") == F.col("o_block")) & F.col("in_text").isNull(), "left")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = joined.select(
        "block", "seq", "doc_id", "text", F.col("in_text").isNull().alias("last"),
        F.concat(
            F.substring("text", F.lit(1), F.length("text") - half),
            F.substring(F.coalesce("in_text", "o_text"), F.lit(1), half),
        ).alias("edited"),
    )
    facts = edited.select(
        "block", "seq", "doc_id", "last", F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
    )
    samples = weighted_samples(edited, ["block", "seq"], ["text", "edited"])
    own = facts.join(samples, ["block", "seq"], "left").withColumn(
        "following", F.lead("samples_0").over(Window.partitionBy("block").orderBy("seq"))
    )
    known = own.join(head_samples, (F.col("block") == F.col("o_block")) & F.col("last"), "left")
    return known.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint_text(F.col("samples_0")).alias("fingerprint"),
        fingerprint_text(F.col("samples_1")).alias("edited_fingerprint"),
        likeness(F.col("samples_0"), F.col("samples_1")).alias("near_edited"),
        likeness(F.col("samples_0"), F.when(F.col("last"), F.col("o_samples")).otherwise(F.col("following"))).alias("near_next"),
    )
