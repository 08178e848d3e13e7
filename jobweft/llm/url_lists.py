"""Dated URL lists: which entries were active when a page was fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobweft.llm.common import settled, sized

#: Kinds of entries: one host, a host with all hosts below it, or a host and a path's beginning.
KINDS = ("host", "domain", "prefix")


def month(time):
    return F.year(time) * 12 + F.month(time)


def place_of(text, scheme: str):
    """Host and path segments of a URL or of an entry's pattern, for both in the same way.

    User, port, query, fragment, empty segments and the dot after a host are left out;
    hosts are in lower case, paths as they are. ``scheme`` is the pattern of what comes
    first. Without a host, the host is empty.
    """
    clean = F.regexp_extract(F.coalesce(text, F.lit("")), rf"^{scheme}(?:[^/?#@]*@)?([^?#]*)", 1)
    parts = F.split(clean, "/")
    host = F.regexp_replace(F.lower(parts[0]), r"\.?(?::\d*)?$", "")
    return host, F.filter(F.slice(parts, 2, F.size(parts)), lambda s: s != "")


SCHEME = r"[A-Za-z][A-Za-z0-9+.-]*://"


def entry_key(kind, pattern):
    """The key of an entry, null if its pattern has no host; a scheme may be left out."""
    host, segments = place_of(F.trim(pattern), f"(?:{SCHEME})?")
    path = F.when(kind == "prefix", F.concat(F.lit("/"), F.array_join(segments, "/"))).otherwise("")
    return F.when(host != "", F.concat(kind, F.lit(":"), host, path))


def intervals(entries: DataFrame) -> DataFrame:
    """``entries(list, kind, pattern, action, effective_at)`` as validity intervals.

    Every entry holds from its date to the next entry for the same list, kind and
    pattern (``valid_to``, null while open). ``action`` is ``block``, ``allow`` or
    ``remove``; a removal only ends what was before. Of entries with the same date
    the strictest counts: block, then allow, then remove. Patterns are read as URLs are
    (``place_of``), so entries that name the same place are one, as repeated ones are;
    entries without list, host or date, or with another kind or action, are void.
    """
    rank = F.when(F.col("action") == "block", 3).when(F.col("action") == "allow", 2).otherwise(1)
    valid = (
        entries.where(F.col("kind").isin(*KINDS) & F.col("action").isin("block", "allow", "remove"))
        .withColumn("key", entry_key(F.col("kind"), F.col("pattern")))
        .where("list IS NOT NULL AND key IS NOT NULL AND effective_at IS NOT NULL")
        .groupBy("list", "key", "effective_at").agg(F.max(rank).alias("rank"))
    )
    by_entry = Window.partitionBy("list", "key").orderBy("effective_at")
    return (
        valid.withColumn("valid_to", F.lead("effective_at").over(by_entry)).where("rank > 1")
        .select("list", "key", (F.col("rank") == 3).alias("blocks"), F.col("effective_at").alias("valid_from"), "valid_to")
    )


def keys_of(url):
    """Keys under which entries can name a URL: its host, the host's suffixes and the path's beginnings."""
    host, segments = place_of(url, SCHEME)
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    )
    beginnings = F.transform(
        F.sequence(F.lit(0), F.size(segments)),
        lambda i: F.concat(F.lit("prefix:"), host, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/")),
    )
    return F.when(host != "", F.concat(F.array(F.concat(F.lit("host:"), host)), suffixes, beginnings)).otherwise(
        F.array().cast("array<string>")
    )


def filter_urls(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """``captures`` with ``lists``, the lists with an entry active at fetch time, and ``blocked``.

    A capture is blocked if, of the entries active then, the one with the longest key
    blocks; between equally long ones an allowing entry wins. ``lists`` names all of
    them, sorted and joined by commas (empty if none).

    Captures are reduced to distinct pairs of URL and time first. Key and month of
    the time join them to the intervals, which are dealt to the months they reach
    into, up to the last fetch; so a host with a third of all captures is spread
    over its months, and an entry that changes often meets only the captures of its
    time. Adaptive execution splits what is still hot. A capture without URL, host
    or time matches nothing and is not blocked; repeated rows get equal results.
    Columns of ``captures`` called ``lists`` or ``blocked`` are replaced.
    """
    kept = [c for c in captures.columns if c not in ("lists", "blocked")]
    seen = captures.select(F.col(url_col).alias("__url"), F.col(time_col).alias("__at")).distinct()
    last = captures.agg(F.max(month(F.col(time_col)))).first()[0] or 0
    months = F.sequence(month(F.col("valid_from")), F.least(month(F.coalesce("valid_to", "valid_from")), F.lit(last)))
    open_months = F.sequence(month(F.col("valid_from")), F.lit(last))
    dealt = settled(
        intervals(entries).where(month(F.col("valid_from")) <= last).withColumn(
            "month", F.explode(F.when(F.col("valid_to").isNull(), open_months).otherwise(months))
        )
    )
    asked = seen.where("__at IS NOT NULL").select(
        "__url", "__at", month(F.col("__at")).alias("month"), F.explode(keys_of(F.col("__url"))).alias("key")
    )
    active = asked.join(sized(dealt, 200), ["key", "month"]).where(
        "valid_from <= __at AND (valid_to IS NULL OR __at < valid_to)"
    )
    length = F.length("key")
    decided = active.groupBy("__url", "__at").agg(
        F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"),
        F.coalesce(F.max(F.when(F.col("blocks"), length)), F.lit(0)).alias("__block"),
        F.coalesce(F.max(F.when(~F.col("blocks"), length)), F.lit(0)).alias("__allow"),
    )
    rows = captures.select(*kept).withColumns({"__u": F.col(url_col), "__t": F.col(time_col)})
    return rows.join(
        decided, F.col("__u").eqNullSafe(F.col("__url")) & F.col("__t").eqNullSafe(F.col("__at")), "left"
    ).select(
        *kept,
        F.coalesce("lists", F.lit("")).alias("lists"),
        F.coalesce(F.col("__block") > F.col("__allow"), F.lit(False)).alias("blocked"),
    )
