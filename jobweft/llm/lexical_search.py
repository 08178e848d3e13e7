"""Ranked lexical search: bundles of items go from term owner to term owner.

Postings are held by blocks of documents. Terms belong to owners by how many documents
hold them, rare terms to the first. A bundle of items starts without scores in each
block; at every owner it is cogrouped with the block's postings of that owner, which add
their contributions, as integers, to the items' sparse accumulators. After an owner, an
item knows its best scores in the block so far and what the owners to come can add at
most. A document that cannot reach the best ones any more leaves the accumulators: it is
below as many others as are asked for, whatever comes. So no result is lost.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobweft.llm.common import settled, sized, text_blocks

#: Documents and postings at which a task closes a block.
BLOCK_DOCS, BLOCK_POSTINGS = 8192, 1 << 21

#: Items that travel together.
BUNDLE_ITEMS = 256

#: A term belongs to the first owner whose number times its documents is at most all documents.
OWNER_SHARES = [256, 32, 8, 1]

#: The items' terms go to every task up to so many bytes; beyond, all terms are indexed and joined.
VOCABULARY_BYTES = 8 << 20

#: Letters of terms: digits, A-Z in lower case, and all bytes of characters beyond ASCII.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

#: Fixed values of the score: parts of a thousand, and the share of the length in it.
SCALE, UNIT, FLAT, SLOPE, SATURATION = 1_000_000_000, 1000, 75, 25, 12


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of letters and digits of a text, A-Z in lower case."""
    return text.translate(_TERM_BYTES).split() if text else []


def _totals(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = total = 0
        for batch in batches:
            for _, texts in text_blocks(batch, "text"):
                for text in texts:
                    n = len(terms(text))
                    held, total = held + (n > 0), total + n
        yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([total])], names=["n", "l"])

    row = docs.select("text").mapInArrow(count, "n bigint, l bigint").agg(F.sum("n"), F.sum("l")).first()
    return row[0] or 0, row[1] or 0


def _item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term, times)``."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_blocks(batch, "text"):
                found = [Counter(terms(text)) for text in texts]
                of = np.repeat(np.arange(start, start + len(texts)), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("item_id").take(pa.array(of)),
                        pa.array([t.decode("utf-8", "replace") for f in found for t in f], pa.string()),
                        pa.array([n for f in found for n in f.values()], pa.int64()),
                    ],
                    names=["item_id", "term", "times"],
                )

    rows = items.mapInArrow(split, "item_id bigint, term string, times bigint")
    return settled(rows.groupBy("item_id", "term").agg(F.sum("times").alias("times")))


class _Block:
    """Postings of some documents, by term."""

    def __init__(self):
        self.ids, self.docs, self.parts, self.size = [], {}, {}, 0

    def add(self, doc_id: int | None, counts: dict[bytes, int], found, length: int) -> None:
        at = len(self.ids)
        self.ids.append(doc_id)
        for term in found:
            if term not in self.docs:
                self.docs[term], self.parts[term] = array("H"), array("i")
            n = counts[term]
            self.docs[term].append(at)
            self.parts[term].append(SCALE * n // (UNIT * n + length))
            self.size += 1

    def rows(self, number: int) -> pa.RecordBatch:
        """One row a term, documents in order of their ids (those without last); one more row has the ids."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        place = np.empty(len(order), np.uint16)
        place[order] = np.arange(len(order))
        names, docs, parts, held, most = [None], [None], [None], [0], [0]
        for term, at in self.docs.items():
            now = place[np.frombuffer(at, np.uint16)]
            by = np.argsort(now)
            part = np.frombuffer(self.parts[term], np.int32)[by]
            names.append(term.decode("utf-8", "replace"))
            docs.append(now[by].tobytes())
            parts.append(part.tobytes())
            held.append(len(by))
            most.append(int(part.max()))
        ids = [[self.ids[i] for i in order]] + [None] * (len(names) - 1)
        columns = [
            pa.array([number] * len(names), pa.int64()), pa.array(names, pa.string()), pa.array(docs, pa.binary()),
            pa.array(parts, pa.binary()), pa.array(held, pa.int64()), pa.array(most, pa.int64()),
            pa.array(ids, pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["block", "term", "docs", "parts", "held", "most", "ids"])


def _postings(docs: DataFrame, vocabulary, n: int, total: int) -> DataFrame:
    """``(block, term, docs, parts, held, most, ids)``; with a vocabulary, only of its terms."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = vocabulary.value if vocabulary else None
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            ids = batch.column("doc_id")
            for start, texts in text_blocks(batch, "text"):
                for at, text in enumerate(texts, start):
                    words = terms(text)
                    if not words:
                        continue
                    counts = Counter(words)
                    found = counts.keys() if wanted is None else wanted.intersection(counts)
                    length = SATURATION * (FLAT + SLOPE * len(words) * n // total)
                    block.add(ids[at].as_py(), counts, found, length)
                    if len(block.ids) >= BLOCK_DOCS or block.size >= BLOCK_POSTINGS:
                        yield block.rows(number)
                        number, block = number + 1, _Block()
        if block.ids:
            yield block.rows(number)

    schema = "block bigint, term string, docs binary, parts binary, held bigint, most bigint, ids array<bigint>"
    return settled(docs.mapInArrow(index, schema))


def _stage(owner: int, last: bool, top: int):
    """What happens to a block's bundle at one owner."""

    def add(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        held = {}
        ids = None
        for term, docs, parts, some in zip(*(postings.column(c).to_pylist() for c in ("term", "docs", "parts", "ids"))):
            if term is None:
                ids = some
            else:
                held[term] = (np.frombuffer(docs, np.uint16), np.frombuffer(parts, np.int32))
        out = {"docs": [], "scores": []}
        dense = np.zeros(1 << 16, np.int64)
        columns = ("docs", "scores", "terms", "weights", "later")
        for docs, scores, names, weights, later in zip(*(bundle.column(c).to_pylist() for c in columns)):
            dense[:] = 0
            if docs:
                dense[np.frombuffer(docs, np.uint16)] = np.frombuffer(scores, np.int64)
            for name, weight in zip(names, weights):
                if name in held:
                    at, part = held[name]
                    dense[at] += part * np.int64(weight)
            found = np.flatnonzero(dense)
            if len(found) > top:
                values = dense[found]
                least = np.partition(values, -top)[-top] - (0 if last else later[owner])
                found = found[values >= least]
            out["docs"].append(found.astype(np.uint16))
            out["scores"].append(dense[found])
        if not last:
            packed = {c: pa.array([v.tobytes() for v in values], pa.binary()) for c, values in out.items()}
            for c, kind in (("terms", pa.string()), ("weights", pa.int64()), ("later", pa.int64())):
                packed[c] = pa.array(bundle.column(c).to_pylist(), pa.list_(kind))
            return pa.table({c: packed.get(c, bundle.column(c)) for c in bundle.column_names})
        of = np.repeat(np.arange(bundle.num_rows), [len(d) for d in out["docs"]])
        return pa.table(
            {
                "item_id": bundle.column("item_id").take(pa.array(of)),
                "doc_id": pa.array([ids[d] for row in out["docs"] for d in row], pa.int64()),
                "score": pa.array(np.concatenate(out["scores"]) if out["scores"] else [], pa.int64()),
            }
        )

    return add


def search(
    docs: DataFrame, items: DataFrame, top: int = 20,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of each item with a score above 0.

    The weight of a term is ``floor(1000 ln((2 N + 2) / (2 df + 1)))`` for ``N``
    documents with terms, ``df`` of which hold it. It counts ``1e9 tf div (1000 tf +
    12 m)`` times for a document with ``tf`` of it, where ``m`` is 75 plus 25 times the
    document's terms by the mean of all; an item's repeated term counts again. Ranks go
    by score, then by ascending id, documents without id last.

    Null and empty texts have no terms: such documents are in no result, and such items
    have none. Rows that repeat a document's id are documents of their own; rows that
    repeat an item's id (or have none) are one item with all their terms. Other columns
    are not read. An empty table on either side gives no rows.

    A task holds one block of postings (at most ``BLOCK_DOCS`` documents) and a bundle of
    at most about ``BUNDLE_ITEMS`` items with their accumulators there.
    """
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = _item_terms(items.select(F.col(item_id_col).cast("bigint").alias("item_id"), F.col(item_text_col).cast("string").alias("text")))
    n, total = _totals(plain)
    session = docs.sparkSession
    wanted = asked.select("term").distinct()
    size = wanted.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    if not n or not size:
        return session.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    vocabulary = None
    if size <= VOCABULARY_BYTES:
        vocabulary = session.sparkContext.broadcast({t.encode() for t in wanted.toArrow().column("term").to_pylist()})
    postings = _postings(plain, vocabulary, n, total)

    # Weights and owners of the items' terms.
    counted = postings.where("term IS NOT NULL").groupBy("term").agg(F.sum("held").alias("df"), F.max("most").alias("most"))
    owner = F.coalesce(*[F.when(F.col("df") * share <= n, k) for k, share in enumerate(OWNER_SHARES)])
    weight = F.floor(1000 * F.ln(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1).cast("double")))
    bundles = -(-asked.select("item_id").distinct().count() // BUNDLE_ITEMS)
    weighed = settled(
        asked.join(counted, "term")
        .withColumn("weight", weight * F.col("times")).where("weight > 0")
        .select("item_id", "term", owner.alias("owner"), "weight", (F.col("weight") * F.col("most")).alias("bound"))
        .withColumn("bundle", F.pmod(F.xxhash64("item_id"), F.lit(bundles)).cast("int"))
    )
    owners = range(len(OWNER_SHARES))
    found = F.sort_array(F.collect_list(F.struct("term", "weight")))
    grouped = settled(
        weighed.groupBy("bundle", "item_id").agg(
            found["term"].alias("terms"), found["weight"].alias("weights"),
            F.array(*[F.coalesce(F.sum(F.when(F.col("owner") > k, F.col("bound"))), F.lit(0)) for k in owners]).alias("later"),
        )
    )
    places = settled(weighed.select("bundle", "term", "owner").distinct())

    every = F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle")
    blocks = postings.where("term IS NULL").select("block", every).toDF("block", "bundle")
    none = F.lit(None).cast("binary")
    state = blocks.join(grouped, "bundle").withColumns({"docs": none, "scores": none})
    schema = "bundle int, item_id bigint, block bigint, terms array<string>, weights array<bigint>, later array<bigint>, docs binary, scores binary"
    state = state.select("bundle", "item_id", "block", "terms", "weights", "later", "docs", "scores")
    columns = ["bundle", "block", "term", "docs", "parts", "ids"]
    owned = postings.join(sized(places, 64), "term")
    for k in owners:
        last = k == owners[-1]
        right = owned.where(F.col("owner") == k).select(*columns)
        if last:
            right = right.union(postings.where("term IS NULL").select(every, "block", "term", "docs", "parts", "ids"))
        state = (
            state.groupBy("bundle", "block").cogroup(right.toDF(*columns).groupBy("bundle", "block"))
            .applyInArrow(_stage(k, last, top), "item_id bigint, doc_id bigint, score bigint" if last else schema)
        )
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return state.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
