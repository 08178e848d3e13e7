"""Link postings of one vacancy to one canonical job.

Rule, for new postings in their order within a company: the canonical of linked
postings with the same content fingerprint, if it is exactly one; several mean a
new canonical; none means falling back to linked postings with the same role, the
same set of locations and a seniority that is equal or unknown on either side,
again only if that is exactly one. Otherwise the posting founds a canonical.

The rule is sequential, yet it is solved here with joins and aggregates only:

* Postings of one fingerprint follow the first of them (the *head*), because the
  head's canonical is the only candidate they ever see. Heads remain to be decided.
* In a *block* (company, role, location set) the candidates of a seniority level
  can change in two ways: from none to one, and from one to several. A head that
  comes before the first change or after the second founds a canonical, one in
  between joins. Both moments are minima over the block, so they are aggregates.
* A follower can carry a canonical into another block. Its value depends on
  strictly earlier postings only. Until it is known, a symbol stands for it, and
  chains of symbols are shortened by doubling.

No group is ever gathered in one task and no pairs are made: every step is a
grouped minimum, combined before its shuffle, or a join with one row per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweft.session import cut_lineage, cut_measured

_BLOCK = ["company", "role", "places"]
_ANY = "\u0000any"  # stands for an unknown seniority, which matches every level

#: Columns expected of postings, besides ``ord`` (new) or ``canonical_id`` (linked).
POSTING_COLUMNS = ["posting_key", "company", "fingerprint", "role", "seniority", "locations"]


def location_set(locations: Column) -> Column:
    """Comparable form of a set of locations; NULL when it is empty."""
    return F.when(
        F.size(locations) > 0, F.array_join(F.array_sort(F.array_distinct(locations)), "\u0001")
    )


def same_or_unknown(left: Column, right: Column) -> Column:
    """Equal, or unknown on either side (not the same as a null-safe comparison)."""
    return left.isNull() | right.isNull() | (left == right)


def exact_groups(postings: DataFrame) -> DataFrame:
    """Canonicals per (company, fingerprint): least, greatest and first posting.

    Equal ends mean exactly one canonical, so no distinct count is needed.
    """
    return (
        postings.where(F.col("fingerprint").isNotNull())
        .groupBy("company", "fingerprint")
        .agg(F.min("canonical_id").alias("c_low"), F.max("canonical_id").alias("c_high"))
    )


def fallback_candidates(new: DataFrame, linked: DataFrame) -> DataFrame:
    """For every new posting its fallback candidates among linked postings.

    Adds ``c_low`` and ``c_high``, the least and greatest canonical; both NULL
    without a candidate, equal for exactly one. Candidates are counted per block
    and level, never paired posting by posting.
    """
    levels = _block_levels(_with_block(linked))
    target = _with_block(new).select("posting_key", *_BLOCK, "level")
    block_all = levels.groupBy(*_BLOCK).agg(F.min("s_low").alias("a_low"), F.max("s_high").alias("a_high"))
    own = levels.select(*_BLOCK, "level", F.col("s_low").alias("o_low"), F.col("s_high").alias("o_high"))
    unknown = levels.where(F.col("level") == _ANY).select(
        *_BLOCK, F.col("s_low").alias("u_low"), F.col("s_high").alias("u_high")
    )
    joined = (
        target.join(own, [*_BLOCK, "level"], "left")
        .join(unknown, _BLOCK, "left")
        .join(block_all, _BLOCK, "left")
    )
    wild = F.col("level") == _ANY
    return joined.select(
        "posting_key",
        F.when(wild, F.col("a_low")).otherwise(F.least("o_low", "u_low")).alias("c_low"),
        F.when(wild, F.col("a_high")).otherwise(F.greatest("o_high", "u_high")).alias("c_high"),
    )


def assign_canonical(new: DataFrame, linked: DataFrame | None = None) -> DataFrame:
    """Links (posting_key, canonical_id, match_method) for all new postings.

    ``new`` has the posting columns and ``ord``, unique and comparable; ``linked``
    has the posting columns and ``canonical_id``. A founded canonical is named
    after its founding posting, so a replay gives the same links.
    """
    if linked is None:
        linked = new.where("false").withColumn("canonical_id", F.lit(None).cast("string"))
    events = cut_lineage(_classified(new, linked))
    state = cut_lineage(_block_levels(_with_block(linked)))
    heads = _decide_heads(events, state)

    decided = heads.select(
        F.col("posting_key").alias("head_key"), F.col("value").alias("head_value")
    )
    linked_to = events.join(decided, "head_key", "left").select(
        "posting_key",
        F.coalesce("value", "head_value", "head_key").alias("canonical_id"),
    )
    return linked_to.withColumn(
        "match_method",
        F.when(F.col("canonical_id") == F.col("posting_key"), "new_canonical_job").otherwise(
            "algorithmic_match"
        ),
    )


def _with_block(postings: DataFrame) -> DataFrame:
    """Postings that can take part in the fallback, with their block and level."""
    return (
        postings.withColumn("places", location_set(F.col("locations")))
        .withColumn("level", F.coalesce("seniority", F.lit(_ANY)))
        .where(F.col("company").isNotNull() & F.col("role").isNotNull() & F.col("places").isNotNull())
    )


def _block_levels(linked: DataFrame) -> DataFrame:
    return linked.groupBy(*_BLOCK, "level").agg(
        F.min("canonical_id").alias("s_low"), F.max("canonical_id").alias("s_high")
    )


def _classified(new: DataFrame, linked: DataFrame) -> DataFrame:
    """New postings with ``role_in_rule``: head, follower or fixed.

    ``value`` is the canonical where it is known at once, ``head_key`` the posting
    whose canonical counts.
    """
    known = exact_groups(linked)
    heads = (
        new.where(F.col("fingerprint").isNotNull())
        .groupBy("company", "fingerprint")
        .agg(F.min(F.struct("ord", "posting_key")).alias("_head"))
        .join(known, ["company", "fingerprint"], "left")
        .select("company", "fingerprint", F.col("_head.posting_key").alias("_head_key"), "c_low", "c_high")
    )
    joined = new.join(heads, ["company", "fingerprint"], "left").withColumns(
        {
            "places": location_set(F.col("locations")),
            "level": F.coalesce("seniority", F.lit(_ANY)),
        }
    )
    no_block = F.col("role").isNull() | F.col("places").isNull() | F.col("company").isNull()
    is_head = F.col("_head_key").isNull() | (F.col("_head_key") == F.col("posting_key"))
    value = (
        F.when(F.col("c_low") == F.col("c_high"), F.col("c_low"))
        .when(F.col("c_low") != F.col("c_high"), F.col("posting_key"))
        .when(is_head & no_block, F.col("posting_key"))
    )
    classified = joined.withColumn("value", value).withColumn(
        "head_key", F.coalesce("_head_key", "posting_key")
    )
    kind = (
        F.when(F.col("value").isNotNull(), "fixed")
        .when(is_head, "head")
        .otherwise("follower")
    )
    return classified.select(
        "posting_key", "ord", *_BLOCK, "level", "value", "head_key", kind.alias("kind"),
        (~no_block).alias("in_block"),
    )


def _decide_heads(events: DataFrame, state: DataFrame) -> DataFrame:
    """Canonical (``value``) of every head.

    A head that comes when its level has several final values founds a canonical at once;
    values that arrive after that are left out. Of the others, heads whose canonical a
    follower carries into another block wait for each other.
    A waiting head starts as a symbol for its own canonical. A round decides the heads
    that see no two symbols which may yet turn out to be one (``_unsure_since``): they
    found a canonical, or take one that is known, or the symbol of another head. Symbols
    of symbols are then replaced by doubling, so a chain of any length takes a
    logarithmic number of steps. Later rounds look only at blocks with an undecided
    head. The first undecided head of all sees decided ones only, so each round decides
    some.
    """
    in_blocks = events.where(F.col("in_block"))
    heads = in_blocks.where(F.col("kind") == "head").select("posting_key", "ord", *_BLOCK, "level")
    carried = _carried(in_blocks, heads)
    fixed = in_blocks.where(F.col("kind") == "fixed").select(*_BLOCK, "level", "ord", "value")
    if carried.isEmpty():
        return _resolve(heads, fixed, state)

    # A head that comes when its level has several canonicals founds one, whatever else
    # arrives. What others see of it is a value like those that were known at once.
    levels, blocks = _final_values(fixed, state)
    marked = cut_lineage(_with_several(heads, levels, blocks).withColumn("late", _past()).drop("several"))
    heads, late = marked.where(~F.col("late")).drop("late"), marked.where("late")
    founded = late.select("posting_key", F.col("posting_key").alias("value"))
    fixed = cut_lineage(fixed.unionByName(late.select(*_BLOCK, "level", "ord", F.col("posting_key").alias("value"))))
    levels, blocks = _final_values(fixed, state)
    fixed, carried = (cut_lineage(_telling(frame, levels, blocks)) for frame in (fixed, carried))

    # Heads that no follower carries elsewhere cannot influence another block.
    sources = carried.select("head_key").distinct()
    known = events.where(F.col("kind") == "fixed").select(F.col("posting_key").alias("head_key"), "value").unionByName(
        founded.withColumnRenamed("posting_key", "head_key")
    ).withColumn("done", F.lit(True)).join(sources, "head_key", "left_semi")
    undecided = cut_lineage(
        heads.join(sources.withColumnRenamed("head_key", "posting_key"), "posting_key", "left_semi")
    )
    while not undecided.isEmpty():
        waiting = undecided.select(
            F.col("posting_key").alias("head_key"), F.col("posting_key").alias("value"), F.lit(False).alias("done")
        )
        blocks = cut_lineage(undecided.select(*_BLOCK).distinct())
        near_heads, near_state = (frame.join(blocks, _BLOCK, "left_semi") for frame in (heads, state))
        arriving = carried.join(blocks, _BLOCK, "left_semi").join(known.unionByName(waiting), "head_key")
        given = cut_lineage(
            fixed.join(blocks, _BLOCK, "left_semi").withColumn("done", F.lit(True))
            .unionByName(arriving.select(*_BLOCK, "level", "ord", "value", "done"))
        )
        levels, blocks = _final_values(given.where("done"), near_state)
        given = cut_lineage(_telling(given, levels, blocks))
        unsure = _unsure_since(near_heads, given, near_state)
        values = _resolve(undecided, given.drop("done"), near_state, all_heads=near_heads)
        sure = F.col("unsure").isNull() | (F.col("ord") < F.col("unsure")) | _past()
        decided = cut_measured(
            _with_several(undecided, levels, blocks).join(unsure, _BLOCK, "left").where(sure)
            .select("posting_key").join(values, "posting_key").withColumnRenamed("posting_key", "head_key")
        )
        undecided = cut_lineage(
            undecided.join(decided.select(F.col("head_key").alias("posting_key")), "posting_key", "left_anti")
        )
        known = _followed(known, decided, undecided)
    arriving = carried.join(known, "head_key").select(*_BLOCK, "level", "ord", "value")
    return _resolve(heads, fixed.unionByName(arriving), state).unionByName(founded)


def _final_values(given: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """When values that are final and differ are there, per block and level and per block.

    ``several`` is the moment of the second value that a head of the level sees, one of
    unknown level in the frame of blocks; its ``ord`` is NULL for values from the start.
    It is NULL where there are no two. ``wide`` is the same for values of unknown level
    alone, which heads of all levels see.
    """
    key = [*_BLOCK, "level"]
    wild = F.col("level") == _ANY
    moment = F.struct("ord", "value")

    def second(first: str, *moments: str) -> Column:
        """The earliest of ``moments`` that has another value than ``first``."""
        return F.least(*[F.when(F.col(m)["value"] != F.col(first)["value"], F.col(m)) for m in moments], F.lit(None))

    start = state.select(*key, F.explode(F.array("s_low", "s_high")).alias("value")).where("value IS NOT NULL")
    values = start.withColumn("ord", F.lit(None).cast(given.schema["ord"].dataType)).unionByName(
        given.select(*key, "ord", "value")
    )
    firsts = values.groupBy(*key).agg(F.min(moment).alias("one"))
    own = cut_lineage(
        values.join(firsts, key).groupBy(*key).agg(
            F.min("one").alias("one"), F.min(F.when(F.col("value") != F.col("one.value"), moment)).alias("two")
        )
    )
    blocks = own.groupBy(*_BLOCK).agg(
        F.min("one").alias("b_one"), F.min(F.when(wild, F.col("one"))).alias("u_one"), F.min(F.when(wild, F.col("two"))).alias("wide")
    )
    met = own.join(blocks, _BLOCK)
    levels = met.where(~wild).withColumn("first", F.least("one", "u_one")).select(
        *key, second("first", "one", "two", "u_one", "wide").alias("several")
    )
    blocks = met.groupBy(*_BLOCK).agg(F.min(second("b_one", "one", "two")).alias("several"), F.min("wide").alias("wide"))
    return cut_lineage(levels), cut_lineage(blocks)


def _with_several(rows: DataFrame, levels: DataFrame, blocks: DataFrame) -> DataFrame:
    """``rows`` with the moment since which heads of their level see several final values."""
    named, whole = levels.withColumnRenamed("several", "_own"), blocks.withColumnsRenamed({"several": "_block", "wide": "_wide"})
    met = rows.join(named, [*_BLOCK, "level"], "left").join(whole, _BLOCK, "left")
    several = F.when(F.col("level") == _ANY, F.col("_block")).otherwise(F.coalesce("_own", "_wide"))
    return met.withColumn("several", several).drop("_own", "_block", "_wide")


def _past() -> Column:
    """Whether a row comes after ``several`` (NULL if that never is)."""
    several = F.col("several")
    after = several["ord"].isNull() | (F.col("ord") > several["ord"])
    return several.isNotNull() & F.coalesce(after, F.lit(False))


def _telling(values: DataFrame, levels: DataFrame, blocks: DataFrame) -> DataFrame:
    """Arriving ``values`` without those that come when all who see them see several already.

    A value of unknown level is seen by all levels, another by its own and by heads of
    unknown level, which see several no later than its own does.
    """
    seen = _with_several(values, levels, blocks.withColumn("several", F.col("wide")))
    return seen.where(~_past()).drop("several")


def _unsure_since(heads: DataFrame, given: DataFrame, state: DataFrame) -> DataFrame:
    """Per block, when two values are there that may be one (``unsure``, NULL if never).

    ``given`` says of its values whether they are final (``done``). Those from the start
    and those that heads found are. All earlier heads of the block are sure.
    """
    moment = F.struct("ord", "value", "done")
    own = heads.select(*_BLOCK, "ord", F.col("posting_key").alias("value"), F.lit(True).alias("done"))
    firsts = (
        own.unionByName(given.drop("level")).groupBy(*_BLOCK).agg(F.min(moment).alias("_first"))
        .join(state.groupBy(*_BLOCK).agg(F.min("s_low").alias("_low")), _BLOCK, "left")
        .select(
            *_BLOCK, F.coalesce("_low", "_first.value").alias("_value"),
            (F.col("_low").isNotNull() | F.col("_first.done")).alias("_done"),
        )
    )
    open_pair = (F.col("value") != F.col("_value")) & ~(F.col("done") & F.col("_done"))
    return given.join(firsts, _BLOCK).where(open_pair).groupBy(*_BLOCK).agg(F.min("ord").alias("unsure"))


def _followed(known: DataFrame, decided: DataFrame, undecided: DataFrame) -> DataFrame:
    """``known`` with the decided heads: symbols are followed to what they stand for.

    A value that is a symbol becomes what its head has, and that for all heads at once,
    so the way to the end halves in each step. What ends at an undecided head stays a
    symbol for it.
    """
    last = undecided.select(
        F.col("posting_key").alias("head_key"), F.col("posting_key").alias("value"), F.lit(False).alias("done")
    )
    own = F.col("value") == F.col("head_key")
    table = known.unionByName(decided.withColumn("done", own))
    moving = True
    while moving:
        table = cut_lineage(table)
        far = table.unionByName(last).select(
            F.col("head_key").alias("_at"), F.col("value").alias("_value"), F.col("done").alias("_done")
        )
        steps = table.where(~F.col("done")).join(far, F.col("value") == F.col("_at"), "left")
        # A value that is no head's is a canonical from before.
        stepped = cut_measured(
            steps.select(
                "head_key", "value", F.coalesce("_value", "value").alias("next"), F.coalesce("_done", F.lit(True)).alias("done")
            )
        )
        moving = not stepped.where(~F.col("done") & (F.col("next") != F.col("value"))).isEmpty()
        table = table.where("done").unionByName(stepped.select("head_key", F.col("next").alias("value"), "done"))
    return cut_lineage(table)


def _carried(in_blocks: DataFrame, heads: DataFrame) -> DataFrame:
    """First arrival of every head's canonical in a block level other than its own."""
    home = heads.select(
        F.col("posting_key").alias("head_key"),
        *[F.col(c).alias(f"_home_{c}") for c in (*_BLOCK, "level")],
    )
    arrivals = (
        in_blocks.where(F.col("kind") == "follower")
        .groupBy("head_key", *_BLOCK, "level")
        .agg(F.min("ord").alias("ord"))
    )
    same = F.lit(True)
    for column in (*_BLOCK, "level"):
        same = same & F.col(column).eqNullSafe(F.col(f"_home_{column}"))
    return cut_lineage(
        arrivals.join(home, "head_key", "left").where(~same).select(
            "head_key", *_BLOCK, "level", "ord"
        )
    )


def _resolve(
    heads: DataFrame, given: DataFrame, state: DataFrame, *, all_heads: DataFrame | None = None
) -> DataFrame:
    """Canonical of ``heads`` when all other values in their blocks are given.

    ``given`` are values arriving at a known moment, ``state`` those there from
    the start; ``all_heads`` are the heads taking part if more than ``heads``.
    """
    switches = _switches(all_heads if all_heads is not None else heads, given, state)
    joined = heads.join(switches, [*_BLOCK, "level"], "left")
    after_first = F.col("t1").isNull() | (F.col("ord") > F.col("t1"))
    before_second = ~F.col("many") & (F.col("t2").isNull() | (F.col("ord") < F.col("t2")))
    joins = F.col("c1").isNotNull() & after_first & before_second
    return joined.select(
        "posting_key", F.when(joins, F.col("c1")).otherwise(F.col("posting_key")).alias("value")
    )


def _switches(heads: DataFrame, given: DataFrame, state: DataFrame) -> DataFrame:
    """Per block and level: first candidate ``c1`` since ``t1``, several since ``t2``.

    ``t1`` is NULL when the candidate was there from the start, ``many`` tells that
    several were. ``t2`` is NULL while the candidate stays the only one.

    Levels and blocks are read several times below, each time by a plan that would
    hold all steps before them; both are kept, at one row per level and per block.
    """
    key = [*_BLOCK, "level"]
    wild = F.col("level") == _ANY
    events = heads.select(
        *key, "ord", F.col("posting_key").alias("value"), F.lit(True).alias("is_head")
    ).unionByName(given.select(*key, "ord", "value", F.lit(False).alias("is_head")))
    # Per level: earliest head, earliest given value, values from the start.
    moment = F.struct("ord", "value")
    levels = cut_lineage(
        events.withColumns({"s_low": F.lit(None).cast("string"), "s_high": F.lit(None).cast("string")})
        .unionByName(state.select(*key, "s_low", "s_high"), allowMissingColumns=True)
        .groupBy(*key)
        .agg(
            F.min(F.when(F.col("is_head"), moment)).alias("h"),
            F.min(F.when(~F.col("is_head"), moment)).alias("g"),
            F.min("s_low").alias("s_low"),
            F.max("s_high").alias("s_high"),
        )
        .withColumn("e", F.least("h", "g"))
    )
    block = levels.groupBy(*_BLOCK).agg(
        F.min("e").alias("b_e"),
        F.min("s_low").alias("b_low"),
        F.max("s_high").alias("b_high"),
        F.min(F.when(wild, F.col("e"))).alias("u_e"),
        F.min(F.when(wild, F.col("h"))).alias("u_h"),
        F.min(F.when(wild, F.col("g"))).alias("u_g"),
        F.min(F.when(wild, F.col("s_low"))).alias("u_low"),
        F.max(F.when(wild, F.col("s_high"))).alias("u_high"),
    )
    # The block's first candidate, which an unknown level sees.
    block = block.select(
        *_BLOCK, "u_e", "u_h", "u_g", "u_low", "u_high",
        F.coalesce("b_low", F.col("b_e.value")).alias("c"),
        F.when(F.col("b_low").isNull(), F.col("b_e.ord")).alias("t0"),
        F.coalesce(F.col("b_low") != F.col("b_high"), F.lit(False)).alias("many_any"),
    )
    # It stops being the only one with another given value, or with a head that
    # finds no candidate at its own level although the block has one.
    other = given.join(block.select(*_BLOCK, "c"), _BLOCK).where(F.col("value") != F.col("c"))
    lonely = (
        levels.where(~wild & F.col("h").isNotNull() & F.col("s_low").isNull())
        .join(block.select(*_BLOCK, "u_e", "u_low", "t0"), _BLOCK)
        .where(
            F.col("u_low").isNull()
            & (F.col("g").isNull() | (F.col("h") < F.col("g")))
            & (F.col("u_e").isNull() | (F.col("h") < F.col("u_e")))
            & (F.col("t0").isNull() | (F.col("h.ord") > F.col("t0")))
        )
        .select(*_BLOCK, F.col("h.ord").alias("ord"))
    )
    second = other.select(*_BLOCK, "ord").unionByName(lonely).groupBy(*_BLOCK)
    block = cut_lineage(block.join(second.agg(F.min("ord").alias("t_any")), _BLOCK, "left"))
    # First candidate of a level: from the start, else the earliest of its own and
    # the unknown level's events. A head of unknown level brings the block's
    # candidate while that is the only one.
    u_h = F.col("u_h")
    u_value = F.when(
        F.col("many_any") | (u_h["ord"] > F.col("t_any")), u_h["value"]
    ).otherwise(F.col("c"))
    u_first = F.when(u_h.isNotNull(), F.struct(u_h["ord"].alias("ord"), u_value.alias("value")))
    named = (
        levels.where(~wild)
        .join(block, _BLOCK)
        .withColumn("first", F.least("e", "u_g", u_first))
        .withColumn("l_low", F.least("s_low", "u_low"))
        .withColumn("l_high", F.greatest("s_high", "u_high"))
        .select(
            *key,
            F.coalesce("l_low", F.col("first.value")).alias("c1"),
            F.when(F.col("l_low").isNull(), F.col("first.ord")).alias("t1"),
            F.coalesce(F.col("l_low") != F.col("l_high"), F.lit(False)).alias("many"),
            "t_any", "many_any",
        )
    )
    # A level gets a second candidate with another value given to it or to the
    # unknown level, and with a head of unknown level that founds a canonical
    # because the block has several.
    reaching = events.where(~F.col("is_head") | wild).withColumnRenamed("level", "from_level")
    founds = (F.col("many_any") | (F.col("ord") > F.col("t_any"))) & (
        F.col("t1").isNull() | (F.col("ord") > F.col("t1"))
    )
    wide, own = reaching.where(F.col("from_level") == _ANY), reaching.where(F.col("from_level") != _ANY)
    met = wide.drop("from_level").join(named, _BLOCK).unionByName(
        own.withColumnRenamed("from_level", "level").join(named, key)
    )
    changes = (
        met.where(F.when(F.col("is_head"), founds).otherwise(F.col("value") != F.col("c1")))
        .groupBy(*key)
        .agg(F.min("ord").alias("t2"))
    )
    named = named.join(changes, key, "left").select(*key, "c1", "t1", "t2", "many")
    unknown = block.select(
        *_BLOCK, F.lit(_ANY).alias("level"), F.col("c").alias("c1"), F.col("t0").alias("t1"),
        F.col("t_any").alias("t2"), F.col("many_any").alias("many"),
    )
    return named.unionByName(unknown)
