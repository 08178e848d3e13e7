"""Dictionary matching on documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweft.catalog.inputs import TERMS, TOPICS, hits_cte, table
from jobweft.operators.alias_index import all_names, first_name, with_hits
from jobweft.operators.dictionary import find_first_of, key_tokens

_TEXTS = "texts AS (SELECT doc_id AS id, text AS body FROM documents)"
_HITS = f"{_TEXTS}, {hits_cte('hits', 'texts', TERMS)}"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.withColumn("_keys", key_tokens("text", [TERMS, TOPICS]))


def dict_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select(
        "doc_id", TERMS.find_first("text", "_keys").alias("term")
    )


DICT_FIRST = f"""
WITH {_HITS},
ranked AS (SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY start, width DESC, name) AS n FROM hits)
SELECT doc_id, name AS term FROM documents LEFT JOIN ranked ON id = doc_id AND n = 1
"""


def dict_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = TERMS.find_all("text", "_keys")
    return _documents(spark, sf_dir).select("doc_id", F.array_join(found, "|").alias("terms"))


DICT_ALL = f"""
WITH {_HITS},
firsts AS (SELECT id, name, MIN(start) AS start FROM hits GROUP BY id, name),
lists AS (SELECT id, string_agg(name, '|' ORDER BY start, name) AS terms FROM firsts GROUP BY id)
SELECT doc_id, COALESCE(terms, '') AS terms FROM documents LEFT JOIN lists ON id = doc_id
"""


def dict_nonoverlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = TERMS.find_non_overlapping("text", "_keys")
    return _documents(spark, sf_dir).select("doc_id", F.array_join(found, "|").alias("terms"))


DICT_NONOVERLAP = f"""
WITH {_HITS},
lists AS (
  SELECT id, list({{'start': start, 'stop': start + width, 'name': name}}
    ORDER BY start, width DESC, name) AS found FROM hits GROUP BY id),
picked AS (
  SELECT id, list_reduce(found,
    lambda acc, h: CASE WHEN h.start >= acc.stop
      THEN {{'stop': h.stop, 'names': CASE WHEN list_contains(acc.names, h.name) THEN acc.names
             ELSE list_append(acc.names, h.name) END}} ELSE acc END,
    {{'stop': 0::BIGINT, 'names': []::VARCHAR[]}}).names AS names
  FROM lists)
SELECT doc_id, COALESCE(array_to_string(names, '|'), '') AS terms
FROM documents LEFT JOIN picked ON id = doc_id
"""


def title_first_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic of the first line, else of the whole document."""
    docs = _documents(spark, sf_dir).withColumn("title", F.substring_index("text", "\n", 1))
    return docs.select(
        "doc_id", find_first_of(TOPICS, "_keys", "title", "text").alias("role")
    )


TITLE_FIRST_FALLBACK = f"""
WITH {_TEXTS},
titles AS (SELECT doc_id AS id, string_split(text, chr(10))[1] AS body FROM documents),
{hits_cte("in_title", "titles", TOPICS)},
{hits_cte("in_text", "texts", TOPICS)},
t AS (SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY start, width DESC, name) AS n FROM in_title),
b AS (SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY start, width DESC, name) AS n FROM in_text)
SELECT doc_id, COALESCE(t.name, b.name) AS role FROM documents
LEFT JOIN t ON t.id = doc_id AND t.n = 1 LEFT JOIN b ON b.id = doc_id AND b.n = 1
"""


def dict_names_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work modes of the first line; only if it has none, those of the document."""
    docs = _documents(spark, sf_dir).withColumn("title", F.substring_index("text", "\n", 1))
    docs = docs.withColumn("_named", TOPICS.find_all("title", "_keys"))
    chosen = F.when(F.size("_named") > 0, F.col("_named")).otherwise(TOPICS.find_all("text", "_keys"))
    return docs.select("doc_id", F.array_join(chosen, "|").alias("work_modes"))


DICT_NAMES_MISSING = f"""
WITH {_TEXTS},
titles AS (SELECT doc_id AS id, string_split(text, chr(10))[1] AS body FROM documents),
{hits_cte("in_title", "titles", TOPICS)},
{hits_cte("in_text", "texts", TOPICS)},
t AS (SELECT id, string_agg(name, '|' ORDER BY start, name) AS names
      FROM (SELECT id, name, MIN(start) AS start FROM in_title GROUP BY id, name) GROUP BY id),
b AS (SELECT id, string_agg(name, '|' ORDER BY start, name) AS names
      FROM (SELECT id, name, MIN(start) AS start FROM in_text GROUP BY id, name) GROUP BY id)
SELECT doc_id, COALESCE(t.names, b.names, '') AS work_modes FROM documents
LEFT JOIN t ON t.id = doc_id LEFT JOIN b ON b.id = doc_id
"""


def dict_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names found in every document with the words and word pairs of all benchmark items as aliases.

    The name of an alias is the first item that has it.
    """
    items = table(spark, sf_dir, "benchmark").select("item_id", F.lower("text").alias("text"))
    word = r"([\p{L}\p{N}_]+)([^\p{L}\p{N}_]*)"
    words, gaps = (F.regexp_extract_all("text", F.lit(word), n) for n in (1, 2))
    cut = items.select("item_id", words.alias("w"), gaps.alias("g"))
    pairs = F.filter(
        F.transform("w", lambda w, i: F.when((F.get("g", i) == " ") & (i < F.size("w") - 1), F.concat(w, F.lit(" "), F.get("w", i + 1)))),
        lambda p: p.isNotNull(),
    )
    aliases = cut.select("item_id", F.explode(F.concat("w", pairs)).alias("alias")).groupBy("alias").agg(
        F.concat(F.lit("item "), F.min("item_id").cast("string")).alias("name")
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_hits(docs, aliases, "doc_id", "text")
    return found.select(
        "doc_id", F.size("hits").alias("n_aliases"), first_name().alias("first"), F.array_join(all_names(), "|").alias("names"),
    )


_CUT = r"""SELECT {id}, regexp_extract_all(lower(text), '([\p{{L}}\p{{N}}_]+)([^\p{{L}}\p{{N}}_]*)', 1) AS w,
    regexp_extract_all(lower(text), '([\p{{L}}\p{{N}}_]+)([^\p{{L}}\p{{N}}_]*)', 2) AS g FROM {table}"""
_GRAMS = """SELECT {id}, i, w[i] AS gram, 1 AS n FROM (SELECT {id}, w, unnest(range(1, len(w) + 1)) AS i FROM {cut})
  UNION ALL SELECT {id}, i, w[i] || ' ' || w[i + 1], 2
  FROM (SELECT {id}, w, g, unnest(range(1, len(w))) AS i FROM {cut}) WHERE g[i] = ' '"""

DICT_LARGE = f"""
WITH item_cut AS ({_CUT.format(id="item_id", table="benchmark")}),
doc_cut AS ({_CUT.format(id="doc_id", table="documents")}),
item_grams AS ({_GRAMS.format(id="item_id", cut="item_cut")}),
doc_grams AS ({_GRAMS.format(id="doc_id", cut="doc_cut")}),
aliases AS (SELECT gram, 'item ' || MIN(item_id) AS name FROM item_grams GROUP BY gram),
hits AS (SELECT doc_id, gram, name, n, MIN(i) AS i FROM doc_grams JOIN aliases USING (gram) GROUP BY ALL),
firsts AS (SELECT doc_id, name, MIN(i) AS i FROM hits GROUP BY ALL),
lists AS (SELECT doc_id, string_agg(name, '|' ORDER BY i, name) AS names FROM firsts GROUP BY doc_id),
best AS (SELECT doc_id, name, row_number() OVER (PARTITION BY doc_id ORDER BY i, n DESC, name) AS k FROM hits),
counts AS (SELECT doc_id, COUNT(*) AS n FROM hits GROUP BY doc_id)
SELECT doc_id, COALESCE(c.n, 0)::INT AS n_aliases, b.name AS first, COALESCE(names, '') AS names
FROM documents LEFT JOIN counts c USING (doc_id) LEFT JOIN lists USING (doc_id) LEFT JOIN (SELECT * FROM best WHERE k = 1) b USING (doc_id)
"""


QUERIES = {
    "dict_first": (dict_first, DICT_FIRST),
    "dict_all": (dict_all, DICT_ALL),
    "dict_nonoverlap": (dict_nonoverlap, DICT_NONOVERLAP),
    "title_first_fallback": (title_first_fallback, TITLE_FIRST_FALLBACK),
    "dict_large": (dict_large, DICT_LARGE),
    "modes_metadata_first": (dict_names_missing, DICT_NAMES_MISSING),
}
