"""Alias dictionaries of any size: aliases as a table, met over the words of the texts.

``AliasDictionary`` is an expression for each alias, which is fine for some hundreds.
Here the plan does not depend on their number: a text and an alias meet in an equi-join
if the text has the alias's first words next to each other, and only then the alias is
looked for. The rules and results are the same: no letter, digit or underscore touches
an alias on either side, case is ignored, and its first occurrence counts.

A regular expression for each alias would be compiled for each text and tried at each
of its letters. Where folding case is the same as lower case, letter by letter, the words
and gaps of the alias are compared with those of the text at the first word by which they
meet. Only if they differ there the alias is sought behind it, as a plain part of the text
with its words bounded by marks. All else is matched by its expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweft.session import cut_lineage

_WORD = r"\p{L}\p{N}_"

#: Neighbouring words by which an alias is met; longer ones are met by their first.
WORDS = 3

#: Aliases go to every task up to so many bytes; beyond, the texts' words are shuffled to them.
BROADCAST_BYTES = 8 << 20

#: Texts and aliases whose letters match without case exactly if their lower case is the same, of
#: one UTF-16 unit each. Micro sign, dotted and dotless I and long s are left out, and so is the mark.
_PLAIN = r"[\x00\x02-\xb4\xb6-\x{12f}\x{132}-\x{17e}\x{2000}-\x{206f}\x{20a0}-\x{20bf}\x{3000}-\x{30ff}\x{4e00}-\x{9fff}]"

#: Words of a text that are counted at once.
BLOCK = 64

#: Put before and after each word.
_MARK = "\x01"

HITS = "array<struct<start:int,rank:int,name:string>>"


def folded(text: Column) -> Column:
    """The same for all that matches without case; only for meeting, never for matching."""
    # The optimizer would drop an upper() right inside a lower(), which unites more letters.
    return F.translate(F.lower(F.translate(F.upper(F.translate(text, "ẞ", "ß")), "İ", "I")), "ς", "σ")


def _keys(words: Column, length: int) -> Column:
    """Hashes of all runs of ``length`` neighbouring words."""
    if length == 0:
        return F.array(F.xxhash64(F.lit("")))
    last = F.size(words) - length + 1
    places = F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda at: F.xxhash64(*[F.get(words, at + k) for k in range(length)]))


def _marked(text: Column) -> Column:
    """Lower case with a mark before and after each word; NULL if that does not decide a match."""
    return F.when(text.rlike(f"^{_PLAIN}*+$"), F.regexp_replace(F.lower(text), f"[{_WORD}]+", f"{_MARK}$0{_MARK}"))


def _cut(text: Column) -> Column:
    """Words of lower case, each with the gap before it."""
    unit, lower = f"([^{_WORD}]*+)([{_WORD}]++)", F.lower(text)
    return F.struct(
        F.regexp_extract_all(lower, F.lit(unit), 1).alias("gaps"), F.regexp_extract_all(lower, F.lit(unit), 2).alias("words")
    )


def _plain_hits(found: str) -> str:
    """Hits of the aliases met in a text that has ``_cut``, ``_marked`` and ``_blocks``, by ``found``.

    The start of a word is the length of all blocks of words before its own and of the
    words and gaps before it in its block.
    """
    at, block = "h.at + 1", f"(h.at div {BLOCK})"
    before = f"h.at % {BLOCK}"
    long = "(a, w) -> a + length(w)"
    start = (
        f"_blocks[{block}] + length(_cut.gaps[h.at]) + 1"
        f" + if({before} = 0, 0, aggregate(slice(_cut.gaps, {block} * {BLOCK} + 1, {before}), 0, {long})"
        f" + aggregate(slice(_cut.words, {block} * {BLOCK} + 1, {before}), 0, {long}))"
    )
    here = (
        f"slice(_cut.words, {at}, size(h.cut.words)) = h.cut.words"
        f" AND slice(_cut.gaps, {at} + 1, size(h.cut.words) - 1) = slice(h.cut.gaps, 2, size(h.cut.words) - 1)"
    )
    marks = f"if(p = 0, 0, 1 + length(replace(left(_marked, p - 1), '{_MARK}', '')))"
    return (
        f"transform({found}, h -> named_struct('start', if({here}, {start}, "
        f"transform(array(instr(_marked, h.marked)), p -> {marks})[0]), 'rank', h.rank, 'name', h.name))"
    )


def alias_keys(aliases: DataFrame) -> DataFrame:
    """``(key, length, pattern, marked, cut, rank, name)`` of ``aliases(name, alias)``; ``length`` is 0 without words.

    ``marked`` is NULL for an alias that only its ``pattern`` can find, such as one that ends
    in no word: a mark does not tell whether a word follows.
    """
    words = F.regexp_extract_all(folded(F.col("alias")), F.lit(f"[{_WORD}]+"), 0)
    quoted = F.concat(F.lit(r"\Q"), F.replace("alias", F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    named = aliases.where("alias <> '' AND name IS NOT NULL").select("name", "alias").distinct().withColumn("_words", words)
    return named.select(
        F.when(F.size("_words") == 0, F.xxhash64(F.lit("")))
        .otherwise(F.element_at(_first_keys(F.col("_words")), F.least(F.size("_words"), F.lit(WORDS)))).alias("key"),
        F.least(F.size("_words"), F.lit(WORDS)).alias("length"),
        F.concat(F.lit(rf"(?iu)(?<![{_WORD}])"), quoted, F.lit(rf"(?![{_WORD}])")).alias("pattern"),
        F.when(F.col("alias").rlike(rf"^[{_WORD}](?s:.*[{_WORD}])?\z"), _marked(F.col("alias"))).alias("marked"),
        _cut(F.col("alias")).alias("cut"),
        # Positions and widths are in UTF-16 units, as the JVM counts.
        (-F.octet_length(F.encode("alias", "UTF-16BE")) / 2).cast("int").alias("rank"),
        "name",
    )


def _first_keys(words: Column) -> Column:
    """Keys of the first word, the first two, and so on."""
    return F.array(*[F.xxhash64(*[F.get(words, F.lit(k)) for k in range(n)]) for n in range(1, WORDS + 1)])


def with_hits(texts: DataFrame, aliases: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``texts`` with ``hits``: the first hit of each of ``aliases(name, alias)``.

    ``id_col`` is unique. A hit has its start, the negated width of the alias (so that
    sorting gives position, then the longest alias, then the name) and the name. Null
    and empty texts, and texts without a hit, have none.

    Each text gives its distinct keys to a join with the aliases' keys. What met comes
    back to the text as one list, and only these aliases are looked for in it. Texts are
    shuffled by their id beforehand, so that what met need not be.
    """
    keys = cut_lineage(alias_keys(aliases))
    facts = keys.agg(F.sort_array(F.collect_set("length")), F.sum(F.octet_length("pattern") * 2 + 32)).first()
    lengths, size = facts[0], facts[1] or 0
    # Rows that repeat an id are told apart by their texts.
    texts = texts.repartition(id_col).withColumn("_text", F.xxhash64(text_col))
    words = F.split(folded(F.col(text_col)), f"[^{_WORD}]+")
    wordy = texts.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), "_text", words.alias("_split"))
    # A split leaves an empty word where a text starts or ends without one.
    wordy = wordy.select("_id", "_text", F.filter("_split", lambda w: w != "").alias("_words"))
    none = F.array().cast("array<struct<at:int,key:bigint>>")
    every = F.concat(none, *[
        F.transform(_keys(F.col("_words"), n), lambda key, at: F.struct(at.alias("at"), key.alias("key"))) for n in lengths
    ])

    def sent(side: DataFrame) -> DataFrame:
        return F.broadcast(side) if size <= BROADCAST_BYTES else side

    met = wordy.select("_id", "_text", F.inline(every)).join(sent(keys.select("key").distinct()), "key", "left_semi")
    met = met.groupBy("_id", "_text", "key").agg(F.min("at").alias("at")).join(sent(keys.drop("length")), "key")
    candidates = met.groupBy("_id").agg(
        F.collect_list(F.struct("_text", "at", "pattern", "marked", "cut", "rank", "name")).alias("_met")
    )
    joined = texts.join(candidates, texts[id_col] == F.col("_id"), "left")
    joined = joined.withColumn("_met", F.filter("_met", lambda a: a["_text"] == F.col("_text")))
    # Made once for a text: what an inner function refers to several times is not put into it.
    joined = joined.withColumn("_marked", _marked(F.col(text_col)))
    joined = joined.withColumn("_cut", F.when(F.col("_marked").isNotNull(), _cut(F.col(text_col))))
    units = "zip_with(_cut.gaps, _cut.words, (g, w) -> length(g) + length(w))"
    joined = joined.withColumn("_units", F.expr(units))
    blocks = (
        f"aggregate(if(size(_units) > 0, sequence(1, size(_units), {BLOCK}), array()), array(0), (held, first) -> "
        f"array_append(held, element_at(held, -1) + aggregate(slice(_units, first, {BLOCK}), 0, (n, u) -> n + u)))"
    )
    joined = joined.withColumn("_blocks", F.when(F.col("_marked").isNotNull(), F.expr(blocks)))
    plain = _plain_hits("filter(_met, a -> _blocks IS NOT NULL AND a.marked IS NOT NULL)")
    other = (
        "transform(filter(_met, a -> _blocks IS NULL OR a.marked IS NULL), a -> named_struct("
        f"'start', regexp_instr(`{text_col}`, a.pattern), 'rank', a.rank, 'name', a.name))"
    )
    found = f"filter(concat({plain}, {other}), h -> h.start > 0)"
    hits = F.coalesce(F.expr(found).cast(HITS), F.array().cast(HITS))
    return joined.withColumn("hits", hits).drop("_id", "_met", "_text", "_marked", "_cut", "_units", "_blocks")


def all_names(hits: str = "hits") -> Column:
    """All names in order of position, then name, each once."""
    by_place = F.transform(hits, lambda h: F.struct(h["start"].alias("start"), h["name"].alias("name")))
    return F.array_distinct(F.transform(F.array_sort(by_place), lambda h: h["name"]))


def first_name(hits: str = "hits") -> Column:
    """The earliest name; at one position the longest alias wins, then the name."""
    return F.array_min(hits)["name"]


def non_overlapping_names(hits: str = "hits") -> Column:
    """Names of hits left when every hit overlapping an earlier pick is dropped."""
    start = F.struct(F.lit(0).alias("stop"), F.array().cast("array<string>").alias("names"))

    def pick(held: Column, hit: Column) -> Column:
        taken = F.struct((hit["start"] - hit["rank"]).alias("stop"), F.array_append(held["names"], hit["name"]).alias("names"))
        return F.when(hit["start"] >= held["stop"], taken).otherwise(held)

    return F.array_distinct(F.aggregate(F.array_sort(hits), start, pick)["names"])
