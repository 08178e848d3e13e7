"""Text columns: trimming, fallbacks, slugs and content fingerprints."""

from __future__ import annotations

import functools
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# White space as Python's str.strip and the \s of its re module see it; the JVM's
# own classes differ on the separators U+001C..U+001F. The first part of the
# intersection tells letters apart after three tests instead of all.
SPACE = (
    r"\x09-\x20\x85\xa0\x{1680}-\x{3000}&&"
    r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# Letters up to U+017E whose case fold is their lower case (not micro sign, sharp
# s, dotted capital I, n with apostrophe or long s).
_JVM_SAFE = r"^[\x00-\xb4\xb6-\xde\xe0-\x{12f}\x{131}-\x{148}\x{14a}-\x{17e}]*$"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def optional_text(text: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def first_non_empty(*texts: Column) -> Column:
    """First value that is neither NULL nor empty text."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def first_non_zero(*numbers: Column) -> Column:
    """First value that is neither NULL nor zero."""
    return F.coalesce(*[F.nullif(n, F.lit(0)) for n in numbers])


def collapse_spaces(text: Column) -> Column:
    """Runs of white space become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(text, rf"[{SPACE}]+", " "))


def slug(text: Column) -> Column:
    """Lower-case key with every run of other characters as one underscore."""
    return F.lower(F.regexp_replace(text, "[^a-zA-Z0-9]+", "_"))


def currency_code(text: Column) -> Column:
    return F.upper(optional_text(text))


@functools.cache
def _plain_text_udf():
    """Arrow-batched function: the text between the tags, decoded and case folded.

    Built once, so that every use of it on a column is the same expression and the
    planner evaluates it once. One parser serves a whole batch. All that it needs is
    local to it and travels with it.
    """

    def plain(texts: pd.Series) -> pd.Series:
        parser = HTMLParser()
        parts: list[str] = []
        parser.handle_data = parts.append

        def between_tags(text: str | None) -> str | None:
            if text is None:
                return None
            parts.clear()
            parser.reset()
            parser.feed(text)
            parser.close()
            return " ".join(parts).casefold()

        return texts.map(between_tags)

    return F.pandas_udf(plain, StringType())


def normalized_content(text: Column) -> Column:
    """Text of an advertisement without markup, spaces collapsed, case folded.

    Plain text in Latin letters folds the same on the JVM; only texts with markup,
    character references or other scripts travel to the Python worker (the rest
    reach it as NULL).
    """
    simple = (
        ~F.contains(text, F.lit("<")) & ~F.contains(text, F.lit("&")) & text.rlike(_JVM_SAFE)
    )
    folded = _plain_text_udf()(F.when(~simple, text))
    return collapse_spaces(F.when(simple, F.lower(text)).otherwise(folded))


def content_fingerprint(text: Column) -> Column:
    """SHA-256 of the normalised content, NULL for an empty body."""
    return F.when(text != "", F.sha2(normalized_content(text), 256))
