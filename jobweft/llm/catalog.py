"""Registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweft.llm import (
    bpe, decontaminate, fingerprints, lexical_search, line_dedup, main_text, manifest, mixing, near_dedup, pseudonyms,
    quality, sharding, url_lists,
)
from jobweft.llm.common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents at 85 % of joint 5-word shingles."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85, width=5)


#: Groups of near-duplicates among ``docs(doc_id, text)``: ``grouped`` has their results.
NEAR_SQL = rf"""
worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM docs),
runs AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM worded),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM runs),
single AS (SELECT doc_id, unnest(s) AS s FROM runs),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM single a JOIN single b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= PERCENT * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM docs UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a),
grouped AS (
  SELECT s.doc_id, s.n AS n_shingles, c.least AS component_id, s.doc_id = c.least AS kept
  FROM sizes s JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) c ON c.a = s.doc_id)
"""

OP1_SQL = f"""
WITH RECURSIVE docs AS (SELECT doc_id, text FROM documents), {NEAR_SQL.replace('PERCENT', '85')}
SELECT doc_id, n_shingles, component_id, kept FROM grouped
"""


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of nearly equal lines of all documents, and which line is kept."""
    return line_dedup.similar_lines(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, literally or paraphrased."""
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Stands for the secret a deployment keeps outside the code and passes in.
SAMPLE_KEY = b"replace this key"


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by pseudonyms of the same form."""
    return pseudonyms.replace_personal_data(table(spark, sf_dir, "documents"), SAMPLE_KEY)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text.main_text(table(spark, sf_dir, "pages"))


def _held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def quality_model(spark: SparkSession, sf_dir: str) -> quality.CompressionModel:
    """The classifier learned from the labelled documents that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~_held_out()).select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return quality.train(table(spark, sf_dir, "documents"), labels)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; good from 0.7 on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality_model(spark, sf_dir))
    return scored.select(
        "doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards by their id."""
    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op9_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against three dated lists, as they were when the page was fetched.

    The tables have no lists and no fetch times; both are derived from ``pages``: the
    hour of a fetch from the page's number, and the entries of the lists from the
    hosts and their paths by the first digits of an MD5 hash.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    captures = pages.withColumn("fetched_at", F.timestamp_add("HOUR", F.pmod(F.col("page_id") * 7919, F.lit(8760)), start))
    place = F.regexp_extract("url", r"^[a-z]+://(([^/?#]*)(/[a-z]+)?)", 2)
    hosts = pages.select(place.alias("host"), F.regexp_extract("url", r"^[a-z]+://([^/?#]*/[a-z]+)", 1).alias("path")).distinct()
    h = F.conv(F.substring(F.md5(F.col("pattern").cast("binary")), 1, 4), 16, 10).cast("int")
    kinds = F.array(
        F.struct(F.lit("spam").alias("list"), F.lit("host").alias("kind"), F.col("host").alias("pattern")),
        F.struct(F.lit("crawl").alias("list"), F.lit("domain").alias("kind"), F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("pattern")),
        F.struct(F.lit("language").alias("list"), F.lit("prefix").alias("kind"), F.col("path").alias("pattern")),
    )
    named = hosts.select(F.explode(kinds).alias("e")).select("e.*").where("pattern <> ''").distinct().withColumn("h", h)
    steps = F.array(
        *[
            F.struct(F.lit(action).alias("action"), F.timestamp_add("DAY", (F.col("h") % modulus + offset).cast("bigint"), start).alias("effective_at"))
            for action, modulus, offset in (("block", 97, 0), ("remove", 89, 120), ("allow", 61, 210), ("block", 53, 280))
        ]
    )
    entries = named.where("h % 3 > 0").withColumn("step", F.explode(steps)).select("list", "kind", "pattern", "step.*")
    return url_lists.filter_urls(captures, entries)


OP9_SQL = r"""
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_hours((page_id * 7919 % 8760)::INT) AS fetched_at,
    regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://([^/?#]*/[a-z]+)', 1) AS path
  FROM pages),
named AS (
  SELECT DISTINCT 'spam' AS list, 'host' AS kind, host AS pattern FROM captures
  UNION SELECT DISTINCT 'crawl', 'domain', regexp_extract(host, '([^.]+\.[^.]+)$', 1) FROM captures
  UNION SELECT DISTINCT 'language', 'prefix', path FROM captures),
hashed AS (SELECT *, ('0x' || substr(md5(pattern), 1, 4))::INT AS h FROM named WHERE pattern <> ''),
steps AS (
  SELECT *, unnest([{'a': 'block', 'd': h % 97}, {'a': 'remove', 'd': h % 89 + 120}, {'a': 'allow', 'd': h % 61 + 210},
    {'a': 'block', 'd': h % 53 + 280}]) AS s FROM hashed WHERE h % 3 > 0),
spans AS (
  SELECT list, kind, pattern, s.a AS action, s.d AS start,
    lead(s.d) OVER (PARTITION BY list, kind, pattern ORDER BY s.d) AS stop FROM steps),
hits AS (
  SELECT c.page_id, list, action, length(kind || ':' || pattern) AS n
  FROM captures c JOIN spans e ON
    (kind = 'host' AND pattern = host OR kind = 'domain' AND (host = pattern OR ends_with(host, '.' || pattern))
     OR kind = 'prefix' AND pattern = path)
    AND fetched_at >= TIMESTAMP '2024-01-01' + to_days(start::INT)
    AND (stop IS NULL OR fetched_at < TIMESTAMP '2024-01-01' + to_days(stop::INT))
  WHERE action <> 'remove'),
decided AS (
  SELECT page_id, array_to_string(list_sort(list_distinct(list(list))), ',') AS lists,
    coalesce(max(n) FILTER (action = 'block'), 0) > coalesce(max(n) FILTER (action = 'allow'), 0) AS blocked
  FROM hits GROUP BY page_id)
SELECT c.page_id, c.url, c.fetched_at, coalesce(lists, '') AS lists, coalesce(blocked, false) AS blocked
FROM captures c LEFT JOIN decided d ON c.page_id = d.page_id
"""


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150 % of all words takes from each document."""
    units = mixing.copies(table(spark, sf_dir, "documents"))
    return units.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        F.explode(F.sequence(F.lit(1), F.col("copies_of").cast("int"))).alias("row"),
    ).drop("row")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty documents that rank highest for each benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=20)


OP11_SQL = rf"""
WITH cut AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
totals AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS terms FROM cut WHERE len(w) > 0),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM cut) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
wanted AS (
  SELECT item_id, term, count(*) * floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
  FROM asked JOIN df USING (term), totals GROUP BY item_id, term, docs, df),
scored AS (
  SELECT item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms))))::BIGINT AS score
  FROM wanted JOIN tf USING (term), totals GROUP BY item_id, r, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def tokenizer_path() -> str:
    """The public byte-level vocabulary that op12 is stated for."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as byte-pair ids and back."""
    path = tokenizer_path()
    rows = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), manifest.digest(joined).alias("ids_sha256"),
        manifest.digest(F.col("decoded")).alias("decoded_sha256"),
    )


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof in a Merkle tree by language, and which tampered ones it gives away."""
    proofs = manifest.document_proofs(table(spark, sf_dir, "documents"))
    folded = manifest.folded(F.coalesce("altered", "leaf"), F.col("path"))
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", manifest.digest(manifest.sibling_text(F.col("path"))).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _framed(column: str) -> str:
    return f"coalesce(octet_length(encode(({column})::VARCHAR))::VARCHAR || ':' || ({column})::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_framed(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


#: CRC-32 bit by bit, levels as lists of hashes, and one sibling a level.
OP13_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda x, b: list_reduce(list_concat([xor(x, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda y, z: xor(y >> 1, (y & 1) * 3988292384))),
    4294967295::BIGINT) AS crc FROM documents),
leaves AS (
  SELECT doc_id, lang, {_leaf('n_chars')} AS leaf, CASE WHEN crc % 7 = 0 THEN {_leaf('n_chars + 1')} ELSE {_leaf('n_chars')} END AS altered
  FROM crc),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
tree(lang, k, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY pos) FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, k + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM tree WHERE len(nodes) > 1),
tops AS (SELECT lang, nodes[1] AS top, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM tree WHERE len(nodes) = 1),
crown(k, nodes) AS (
  SELECT 0, list(top ORDER BY pos) FROM tops
  UNION ALL
  SELECT k + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM crown WHERE len(nodes) > 1),
steps AS (
  SELECT p.lang, p.pos, k, p.pos // (1 << k) AS own, nodes FROM placed p JOIN tree t ON t.lang IS NOT DISTINCT FROM p.lang WHERE len(nodes) > 1
  UNION ALL
  SELECT p.lang, p.pos, 1000 + k, t.pos // (1 << k), nodes FROM placed p JOIN tops t ON t.lang IS NOT DISTINCT FROM p.lang, crown
  WHERE len(nodes) > 1),
sides AS (
  SELECT lang, pos, list((CASE WHEN own % 2 = 1 THEN 'L' ELSE 'R' END) || coalesce(nodes[xor(own, 1) + 1], '') ORDER BY k) AS path
  FROM steps GROUP BY lang, pos),
proofs AS (
  SELECT doc_id, leaf, top AS subroot, (SELECT nodes[1] FROM crown WHERE len(nodes) = 1) AS root, coalesce(path, []::VARCHAR[]) AS path, altered
  FROM placed p JOIN tops t ON t.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN sides s ON s.lang IS NOT DISTINCT FROM p.lang AND s.pos = p.pos),
folded AS (
  SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256,
    list_reduce(list_concat([altered], path), lambda x, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || x ELSE x || s[2:] END)) AS folded_root
  FROM proofs)
SELECT *, folded_root = root AS verified FROM folded
"""


QUERIES = {
    "op1_near_dedup": (op1_near_dedup, OP1_SQL),
    "op2_line_dedup": (op2_line_dedup, None),
    "op3_decontamination": (op3_decontamination, None),
    "op4_pseudonyms": (op4_pseudonyms, None),
    "op5_main_text": (op5_main_text, None),
    "op6_quality": (op6_quality, None),
    "op7_sharding": (op7_sharding, None),
    "op8_fingerprints": (op8_fingerprints, None),
    "op9_url_lists": (op9_url_lists, OP9_SQL),
    "op10_mixing": (op10_mixing, None),
    "op11_lexical_search": (op11_lexical_search, OP11_SQL),
    "op12_bpe": (op12_bpe, None),
    "op13_manifest": (op13_manifest, OP13_SQL),
}


def registered() -> dict:
    return {name: query for name, (query, _) in QUERIES.items()}


def equivalent_sql() -> dict:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql is not None}
