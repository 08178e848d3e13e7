"""Benchmark passages in documents: latent semantic search, then word-order checks.

Passages are TF-IDF vectors over hashed words, with document frequencies of the whole
corpus. A distributed randomised SVD of the benchmark's passages gives the latent space
that a match can lie in at all. A window of a document is compared with a passage by
their cosine there; close pairs are then checked for their longest common subsequence
of words and for the passage's answer, which finds paraphrases that keep some words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweft.llm.common import map_batches, settled, sized, text_blocks, text_bytes

#: Hashed words: 2 to this power. Bounds the tables that every task gets.
HASH_BITS = 18

#: Directions of the latent space, and those drawn in excess to find them.
RANK, EXCESS, POWER_STEPS = 256, 16, 2

#: Rows of a product that one task adds up.
SUMMED_ROWS = 16

#: A longer benchmark text is cut into passages of so many words.
PASSAGE_WORDS = 64

#: Benchmark passages that are searched for in one pass over the documents.
QUERY_BLOCK = 20_000

#: Least cosine of a candidate, and least share of a passage's words in order: alone,
#: or together with the answer.
LEAST_COSINE, LEAST_ORDER, ORDER_WITH_ANSWER = 0.45, 0.7, 0.5

#: Bytes to bytes: ASCII punctuation and controls become spaces.
FOLD = bytes(c if c >= 128 or chr(c).isalnum() or c == 95 else 32 for c in range(256))

#: The answer is what follows the last of these; a text without any has its last sentence.
ANSWER = re.compile(rb"(?i)\b(?:answer|solution)\s*:\s*")
SENTENCE = re.compile(rb"(?<=[.!?])\s+|\n")


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of letters, digits and underscores, in lower case; only ASCII characters part words."""
    return text.decode("utf-8", "replace").lower().encode().translate(FOLD).split() if text else []


def places(words: list[bytes]) -> np.ndarray:
    """Hashed place of each word."""
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) >> np.uint32(32 - HASH_BITS)


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Documents that hold each hashed word, and the number of documents.

    Each task adds up its own documents; what comes to the driver is one number per
    hashed word at most, whatever the corpus holds.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = np.zeros(1 << HASH_BITS, np.int64), 0
        for batch in batches:
            for _, texts in text_blocks(batch, "text"):
                total += len(texts)
                for text in texts:
                    held[np.unique(places(words_of(text)))] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(held[at], total))], names=["place", "n"]
        )

    rows = (
        docs.select(F.col(text_col).alias("text")).mapInArrow(count, "place bigint, n bigint")
        .groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    )
    at, n = rows.column("place").to_numpy(), rows.column("n").to_numpy()
    frequencies = np.zeros(1 << HASH_BITS, np.int64)
    frequencies[at[at >= 0]] = n[at >= 0]
    return frequencies, int(n[at < 0].sum())


def passages(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item_id, part, words, answer)``: the benchmark's texts in runs of ``PASSAGE_WORDS``."""

    def cut(batch: pa.RecordBatch):
        rows = []
        for item, text in zip(batch.column("item_id").to_pylist(), text_bytes(batch, "text"), strict=True):
            words = words_of(text)
            marked = ANSWER.split(text)[-1] if text and ANSWER.search(text) else None
            ends = [s for s in SENTENCE.split(text.strip()) if words_of(s)] if text else []
            answer = words_of(marked) if marked else words_of(ends[-1]) if len(ends) > 1 else []
            count = max(1, round(len(words) / PASSAGE_WORDS))
            bounds = np.linspace(0, len(words), count + 1).astype(int)
            rows += [
                (item, part, words[a:b], answer)
                for part, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if b > a
            ]
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.binary()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["item_id", "part", "words", "answer"]
        )

    return map_batches(
        benchmark.where(F.col(id_col).isNotNull()).select(
            F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).alias("text")
        ).distinct(),
        cut, "item_id bigint, part bigint, words array<binary>, answer array<binary>",
    )


def _vectors(batch: pa.RecordBatch, weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """TF-IDF vectors of unit length: places and values."""
    found = []
    for words in batch.column("words").to_pylist():
        at, counts = np.unique(places(words), return_counts=True)
        values = counts * weights[at]
        found.append((at, values / (np.linalg.norm(values) or 1.0)))
    return found


@dataclass
class LatentSpace:
    """Directions as rows of ``basis`` for the places in ``vocabulary`` (sorted)."""

    vocabulary: np.ndarray
    basis: np.ndarray
    weights: np.ndarray = field(repr=False)

    def project(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        known = np.minimum(np.searchsorted(self.vocabulary, at), len(self.vocabulary) - 1)
        hit = self.vocabulary[known] == at
        return values[hit] @ self.basis[known[hit]]


def latent_space(parts: DataFrame, weights: np.ndarray, seed: int = 1) -> LatentSpace:
    """Randomised SVD of the passages' TF-IDF matrix A, kept in rows over the cluster.

    The range of A' is found by multiplying random directions by A'A a few times;
    each product is summed inside the tasks and only ``places x directions`` numbers
    come to the driver, which orthonormalises them. The last product rotates the
    directions to the singular ones. Places outside the benchmark take no part.
    """
    vocabulary = np.array(
        [r.place for r in _places(parts).distinct().collect()] or [0], np.int64
    )
    vocabulary.sort()
    width = min(RANK + EXCESS, len(vocabulary))
    directions = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(vocabulary), width)))[0]

    def product(current: np.ndarray) -> np.ndarray:
        space = LatentSpace(vocabulary, current, weights)

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(current)
            for batch in batches:
                for at, values in _vectors(batch, weights):
                    total[np.searchsorted(vocabulary, at)] += np.outer(values, space.project(at, values))
            for start in range(0, len(total), SUMMED_ROWS):
                some = total[start : start + SUMMED_ROWS]
                if some.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([start]), pa.array([some.tobytes()], pa.binary())], names=["start", "sums"]
                    )

        def add_up(table: pa.Table) -> pa.Table:
            sums = [np.frombuffer(x, np.float64) for x in table.column("sums").to_pylist()]
            return pa.table({"start": table.column("start")[:1], "sums": pa.array([np.sum(sums, axis=0).tobytes()], pa.binary())})

        out = np.zeros_like(current)
        added = parts.mapInArrow(multiply, "start bigint, sums binary").groupBy("start").applyInArrow(
            add_up, "start bigint, sums binary"
        )
        for row in added.toLocalIterator():
            some = np.frombuffer(row.sums, np.float64).reshape(-1, width)
            out[row.start : row.start + len(some)] = some
        return out

    for _ in range(POWER_STEPS):
        directions = np.linalg.qr(product(directions))[0]
    values, turns = np.linalg.eigh(directions.T @ product(directions))
    kept = np.argsort(values)[::-1][:RANK]
    kept = kept[values[kept] > 1e-9 * max(values.max(), 1e-30)]
    return LatentSpace(vocabulary, (directions @ turns[:, kept]).astype(np.float32), weights)


def _places(parts: DataFrame) -> DataFrame:
    def list_places(batch: pa.RecordBatch):
        found = [places(w) for w in batch.column("words").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.unique(np.concatenate(found)) if found else np.empty(0), pa.int64())], names=["place"]
        )

    return map_batches(parts.select("words"), list_places, "place bigint")


def common_order(words: list[bytes], masks: dict[bytes, int], size: int) -> int:
    """Length of the longest common subsequence, all lengths of the passage at once in bits."""
    full = (1 << size) - 1
    state = full
    for word in words:
        mask = masks.get(word)
        if mask:
            hit = state & mask
            state = ((state + hit) | (state - hit)) & full
    return size - bin(state).count("1")


class Searcher:
    """Finds the passages of one query block in a document."""

    def __init__(self, rows: list[tuple[int, list[bytes], list[bytes]]], space: LatentSpace):
        self.items = [r[0] for r in rows]
        self.words = [r[1] for r in rows]
        self.answers = [r[2] for r in rows]
        self.masks = []
        for words in self.words:
            masks: dict[bytes, int] = {}
            for i, word in enumerate(words):
                masks[word] = masks.get(word, 0) | 1 << i
            self.masks.append(masks)
        self.weights = space.weights
        self.row_of = np.full(1 << HASH_BITS, -1, np.int32)
        self.row_of[space.vocabulary] = np.arange(len(space.vocabulary))
        self.vectors = space.basis * space.weights[space.vocabulary, None].astype(np.float32)
        latent = np.zeros((len(rows), space.basis.shape[1]), np.float32)
        for i, words in enumerate(self.words):
            at, counts = np.unique(places(words), return_counts=True)
            values = counts * self.weights[at]
            latent[i] = space.project(at, values / (np.linalg.norm(values) or 1.0))
        # A window equal to the passage gets 1, however much of it the space keeps.
        self.queries = latent / np.maximum((latent**2).sum(axis=1, keepdims=True), 1e-12)
        # Windows of each size serve the passages of about that many words.
        counts = np.maximum([len(w) for w in self.words], 4)
        sizes = np.rint(2 ** (np.rint(2 * np.log2(counts)) / 2)).astype(int)
        self.classes = []
        for size in np.unique(sizes):
            members = np.flatnonzero(sizes == size)
            self.classes.append((int(size), members, self._best(members)))

    def _best(self, members: np.ndarray) -> np.ndarray:
        """The most that each known word adds to a product with any of the passages."""
        best = np.zeros(len(self.vectors))
        for start in range(0, len(members), 1024):
            part = self.queries[members[start : start + 1024]]
            np.maximum(best, (self.vectors @ part.T).max(axis=1), out=best)
        return best

    def find(self, texts: list[bytes | None]) -> list[dict[int, tuple[int, float, float, bool]]]:
        """For each text the best ``(start word, cosine, order, answer)`` of the passages it holds."""
        worded = [words_of(t) for t in texts]
        found: list[dict[int, tuple[int, float, float, bool]]] = [{} for _ in texts]
        counts = np.array([len(w) for w in worded], np.int64)
        total = int(counts.sum())
        if not total or not self.items:
            return found
        at = np.fromiter((c for words in worded for c in map(zlib.crc32, words)), np.uint32, total)
        at >>= np.uint32(32 - HASH_BITS)
        rows, weights = self.row_of[at], self.weights[at]
        begin = np.cumsum(counts) - counts
        energy = np.concatenate([[0.0], np.cumsum(weights * weights)])
        hit = np.flatnonzero(rows >= 0)
        for size, members, best in self.classes:
            gain = np.zeros(total)
            gain[hit] = best[rows[hit]]
            gains = np.concatenate([[0.0], np.cumsum(gain)])
            stride = max(1, size // 4)
            windows = np.maximum(1, -(-(counts - size) // stride) + 1) * (counts > 0)
            owner = np.repeat(np.arange(len(texts)), windows)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
            starts = begin[owner] + nth * stride
            ends = np.minimum(starts + size, begin[owner] + counts[owner])
            # ``energy`` takes repeated words as different ones, so it is a lower bound of the length.
            lengths = np.sqrt(np.maximum(energy[ends] - energy[starts], 0.0))
            for w in np.flatnonzero(gains[ends] - gains[starts] >= LEAST_COSINE * lengths - 1e-6):
                places_in, times = np.unique(at[starts[w] : ends[w]], return_counts=True)
                values = times * self.weights[places_in]
                length = float(np.linalg.norm(values))
                known = self.row_of[places_in]
                if (values > 0).any() and (times[known >= 0] @ best[known[known >= 0]]) >= LEAST_COSINE * length:
                    inside = known >= 0
                    cosines = self.queries[members] @ (times[inside] @ self.vectors[known[inside]]) / length
                    doc, start = owner[w], int(starts[w] - begin[owner[w]])
                    for m in np.flatnonzero(cosines >= LEAST_COSINE):
                        self._check(int(members[m]), float(cosines[m]), start, size, worded[doc], found[doc])
        return found

    def _check(self, member: int, cosine: float, start: int, size: int, words: list[bytes], found: dict) -> None:
        wanted = self.words[member]
        margin = max(len(wanted), size) // 2
        around = words[max(0, start - margin) : start + size + margin]
        order = common_order(around, self.masks[member], len(wanted)) / len(wanted)
        answer = self._has_answer(member, around)
        if order >= LEAST_ORDER or answer and order >= ORDER_WITH_ANSWER:
            known = found.get(member)
            if known is None or (order, cosine) > (known[2], known[1]):
                found[member] = (start, cosine, order, answer)

    def _has_answer(self, member: int, around: list[bytes]) -> bool:
        answer = self.answers[member]
        size = len(answer)
        return size > 0 and any(around[i : i + size] == answer for i in range(len(around) - size + 1))


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(doc_id, item_id, word_start, cosine, word_order, answer)`` of every passage found.

    One row per document row and benchmark item: the best place (counted in words),
    the cosine there, the share of the item's words in order around it, and whether
    its answer follows literally. Documents without a finding have no row. The
    documents are read once for the word counts and once per ``QUERY_BLOCK`` passages;
    nothing of them is shuffled. The benchmark is a query set: a block of it goes to
    every task.

    Null and empty texts hold nothing; items without id, text or words are looked
    for nowhere; equal items are one; rows without document id are searched and get
    a null id. Other columns of either table are not read.
    """
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    parts = settled(passages(benchmark, item_id_col, item_text_col))
    frequencies, total = document_frequencies(plain, "text")
    weights = np.log((total + 1) / (frequencies + 1)) + 1e-3
    space = latent_space(parts, weights)
    results = None
    wanted = parts.orderBy("item_id", "part").toLocalIterator(prefetchPartitions=True)
    for rows in _in_blocks(wanted):
        found = map_batches(plain, _search(rows, space), SCHEMA)
        results = found if results is None else results.union(found)
    if results is None:
        return plain.sparkSession.createDataFrame([], SCHEMA)
    return results


def _in_blocks(rows) -> Iterator[list[tuple[int, list[bytes], list[bytes]]]]:
    """Blocks of passages; the parts of an item stay together."""
    held: list = []
    for row in rows:
        if len(held) >= QUERY_BLOCK and row.item_id != held[-1][0]:
            yield held
            held = []
        held.append((row.item_id, [bytes(w) for w in row.words], [bytes(w) for w in row.answer]))
    if held:
        yield held


SCHEMA = "doc_id bigint, item_id bigint, word_start bigint, cosine double, word_order double, answer boolean"


def _search(rows: list, space: LatentSpace):
    made: list[Searcher] = []

    def search(batch: pa.RecordBatch):
        if not made:
            made.append(Searcher(rows, space))
        searcher, out = made[0], []
        docs = batch.column("doc_id").to_pylist()
        for first, texts in text_blocks(batch, "text"):
            for doc, hits in zip(docs[first : first + len(texts)], searcher.find(texts), strict=True):
                best: dict[int, tuple] = {}
                for member, (start, cosine, order, answer) in hits.items():
                    item = searcher.items[member]
                    if item not in best or (order, cosine) > (best[item][2], best[item][1]):
                        best[item] = (start, cosine, order, answer)
                out += [(doc, item, *values) for item, values in best.items()]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)],
            names=["doc_id", "item_id", "word_start", "cosine", "word_order", "answer"],
        )

    return search


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose document holds no benchmark item. Rows without id are kept."""
    found = contaminations(docs, benchmark, id_col, text_col, item_id_col, item_text_col)
    held = settled(found.select(F.col("doc_id").alias("__held")).where("__held IS NOT NULL").distinct())
    return docs.join(sized(held, 16), docs[id_col] == F.col("__held"), "left_anti")
