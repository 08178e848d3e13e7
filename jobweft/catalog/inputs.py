"""Reading the given tables, and the small dictionaries used on their texts.

The texts are invented prose, so the job-market aliases hardly occur in them; the
dictionaries here hold common words of the same languages instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobweft.operators.dictionary import AliasDictionary


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TERMS = AliasDictionary(
    "terms",
    [
        ("article", ["the", "der", "die", "das", "le", "la", "el"]),
        ("of", ["of", "of the", "de", "de la"]),
        ("and", ["and", "and the", "und", "y"]),
        ("in", ["in", "in the", "en"]),
        ("by the way", ["by the", "by"]),
        ("question", ["was", "que", "how"]),
        ("für", ["für", "for"]),
        ("où", ["où", "là"]),
    ],
)

TOPICS = AliasDictionary(
    "topics",
    [
        ("english", ["the", "of", "with"]),
        ("german", ["der", "und", "mit"]),
        ("french", ["le", "des", "une"]),
        ("spanish", ["el", "los", "con"]),
    ],
)


def hits_cte(name: str, texts: str, dictionary: AliasDictionary) -> str:
    """First hit of each alias in ``texts(id, body)`` as (id, name, start, width).

    One branch per alias, so that its pattern is a constant.
    """
    branches = []
    for a in dictionary.aliases:
        pattern = f"(?is)^(|.*?[^\\p{{L}}\\p{{N}}_])({a.alias})(?:$|[^\\p{{L}}\\p{{N}}_])"
        branches.append(
            f"SELECT id, '{a.name}' AS name, length(regexp_extract(body, '{pattern}', 1)) + 1 AS start, "
            f"{len(a.alias)} AS width FROM {texts} WHERE regexp_matches(body, '{pattern}')"
        )
    return f"{name} AS (" + " UNION ALL ".join(branches) + ")"
