"""Near-duplicate documents: SuperMinHash signatures, banding, verification, union.

Ertl's SuperMinHash gives every element one permutation of the signature's slots;
the element's value in a slot is its rank there plus a random fraction. A slot keeps
the smallest value of all elements. As an element meets every slot at another rank,
slots are filled evenly and estimates vary less than with independent hashes, and
ranks beyond the largest value held need not be drawn at all.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweft.llm.common import (
    PLACES,
    U64,
    lower_words,
    map_batches,
    mix,
    same,
    settled,
    shingle_set,
    sized,
    text_blocks,
    text_bytes,
)
from jobweft.llm.components import connected_components, labelled, linked_members, mixed_members

#: Bits of a slot's value that hold the random fraction; the rank stands above them.
FRACTION_BITS = 48


#: Shingles are counted by so many bits of their hash when crowded buckets are split.
COUNT_BITS = 18


def super_minhash(elements: np.ndarray, owner: np.ndarray, owners: int, slots: int, seed: int = 0) -> np.ndarray:
    """Signatures of ``owners`` sets, as an array of ``owners`` rows and ``slots`` columns.

    ``elements`` are distinct hashes within a set, ``owner`` the set of each. Rank by
    rank, all elements of all sets take one step of their own Fisher-Yates shuffle;
    those of a set drop out when no value of that rank can lower any of its slots.
    A set without elements keeps the largest value everywhere.
    """
    held = np.full(owners * slots, np.iinfo(np.uint64).max, U64)
    stream = mix(elements + U64(seed) * U64(0x9E3779B97F4A7C15))
    drawn = np.empty((len(elements), 0), np.int64)
    moved = np.empty((len(elements), 0), np.int64)
    base = owner.astype(np.int64) * slots
    for rank in range(slots):
        if not len(stream):
            break
        bits = mix(stream + PLACES[rank % 64 : rank % 64 + 1] * U64(rank + 1))
        pick = rank + ((mix(bits) >> U64(32)) * U64(slots - rank) >> U64(32)).astype(np.int64)
        # What lies at a place is what the last earlier swap with that place put there.
        slot, here = pick.copy(), np.full(len(pick), rank)
        for step in range(rank):
            np.copyto(slot, moved[:, step], where=drawn[:, step] == pick)
            np.copyto(here, moved[:, step], where=drawn[:, step] == rank)
        value = U64(rank << FRACTION_BITS) | (bits >> U64(64 - FRACTION_BITS))
        np.minimum.at(held, base + slot, value)
        worst = (held.reshape(owners, slots).max(axis=1) >> U64(FRACTION_BITS)).astype(np.int64)
        stay = worst[base // slots] > rank
        if not stay.all():
            stream, base, pick, here = stream[stay], base[stay], pick[stay], here[stay]
            drawn, moved = drawn[stay], moved[stay]
        drawn = np.concatenate([drawn, pick[:, None]], axis=1)
        moved = np.concatenate([moved, here[:, None]], axis=1)
    return held.reshape(owners, slots)


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each run of ``rows`` slots, different from band to band."""
    owners, slots = signatures.shape
    bands = slots // rows
    parts = mix(signatures[:, : bands * rows].reshape(owners, bands, rows))
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=U64) * U64(0x9E3779B97F4A7C15), (owners, bands)).copy()
    for row in range(rows):
        key += parts[:, :, row] * PLACES[row]
    return mix(key)


def banding(percent: int) -> tuple[int, int]:
    """``(bands, rows)`` for a threshold: a link at the threshold is missed with p < 1e-6."""
    similarity = percent / 100
    rows = 5 if percent >= 85 else 4 if percent >= 75 else 3
    return math.ceil(math.log(1e-6) / math.log1p(-(similarity**rows))), rows


def _sketcher(id_col: str, text_col: str, width: int, bands: int, rows: int):
    def sketch(batch: pa.RecordBatch):
        ids = batch.column(id_col).cast(pa.int64())
        for start, texts in text_blocks(batch, text_col):
            words = [lower_words(t) for t in texts]
            sets = [shingle_set(w, width) for w in words]
            sizes = np.array([len(s) for s in sets])
            owner = np.repeat(np.arange(len(sets)), sizes)
            held = super_minhash(np.concatenate(sets), owner, len(sets), bands * rows)
            keys = band_keys(held, rows).view(np.int64)
            low = (mix(held) & U64(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(start, len(texts)),
                    pa.array(sizes, pa.int64()),
                    pa.array([hashlib.blake2b(b" ".join(w), digest_size=16).digest() for w in words], pa.binary()),
                    pa.array([low[i].tobytes() for i in range(len(sets))], pa.binary()),
                    pa.array([keys[i] if sizes[i] else [] for i in range(len(sets))], pa.list_(pa.int64())),
                ],
                names=["id", "n", "content", "sketch", "bands"],
            )

    return sketch


def _sketch_filter(slots: int, percent: int):
    """Drop pairs whose sketches agree in too few slots (6.5 standard deviations)."""
    similarity = percent / 100
    least = math.floor(slots * similarity - 6.5 * math.sqrt(slots * similarity * (1 - similarity)))

    def keep(batch: pa.RecordBatch):
        a, b = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, slots)
            for c in ("sketch_a", "sketch_b")
        )
        chosen = pa.array((a == b).sum(axis=1) >= least)
        yield batch.select(["a", "b"]).filter(chosen)

    return keep


def _verifier(percent: int, width: int):
    """Keep the pairs whose full shingle sets reach the threshold."""

    def keep(batch: pa.RecordBatch):
        last, hub = None, None
        for start, right in text_blocks(batch, "text_b"):
            some = batch.slice(start, len(right))
            hubs, chosen = some.column("a").to_pylist(), []
            for i, text in enumerate(right):
                mine = some.column("text_a")[i].as_py()
                if last != (hubs[i], mine):
                    last, hub = (hubs[i], mine), shingle_set(lower_words(mine.encode()), width)
                other = shingle_set(lower_words(text), width)
                shared = len(np.intersect1d(hub, other, assume_unique=True))
                chosen.append(100 * shared >= percent * (len(hub) + len(other) - shared) and shared > 0)
            yield some.select(["a", "b"]).filter(pa.array(chosen, pa.bool_()))

    return keep


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 85,
    width: int = 5,
) -> DataFrame:
    """Group documents that share at least ``percent`` of their joint shingles.

    Returns for every row ``(doc_id, n_shingles, component_id, kept)``: the size of
    its set of ``width``-word shingles, the smallest id linked to it directly or over
    others, and whether that is its own id.

    1. Rows with the same words are one class; its smallest id stands for it.
    2. Signatures of the classes are cut into bands; classes with an equal band are
       candidates. In a band's bucket all members meet the bucket's smallest id.
    3. Candidates whose sketches nearly agree are compared on their full sets.
    4. Members of buckets that still hold several components may be linked to others
       than the hub. Sets that reach the threshold share one of their rarest
       shingles (``percent`` of the set is left out), so these members are dealt to
       buckets anew by those, with the largest size that a partner can have if they
       agree from there on; this parts the many moderately similar members of a
       crowd. Each such bucket goes on with further hubs (``linked_members``).
    5. Links are united by alternating stars.

    Null or empty texts, and texts without words, have no shingle and are linked
    with nothing (``component_id`` is the row's own id). Rows without id are never
    linked; their component and ``kept`` are null. Repeated rows are one class and
    get equal results. Other columns are not read, so their names do not matter.
    An empty table gives an empty result.
    """
    bands, rows = banding(percent)
    plain = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    marked = settled(
        map_batches(
            plain,
            _sketcher("id", "text", width, bands, rows),
            "id bigint, n bigint, content binary, sketch binary, bands array<bigint>",
        )
    )
    classes = marked.where("n > 0 AND id IS NOT NULL").groupBy("content").agg(F.min("id").alias("rep"))
    heads = settled(
        marked.alias("m")
        .join(classes.alias("c"), F.expr("m.content = c.content AND m.id = c.rep"))
        .select("rep", "m.n", "m.sketch", "m.bands", "m.content")
        .dropDuplicates(["rep", "content"])
    )
    keyed = heads.select("rep", F.explode("bands").alias("bucket"))
    first = keyed.groupBy("bucket").agg(F.min("rep").alias("hub"))
    members = settled(
        keyed.join(first, "bucket").where("rep <> hub").select("bucket", "rep", "hub").distinct()
    )
    compared = _Comparison(heads, plain, members, percent, width)
    links = compared.links(members.select(F.col("hub").alias("a"), F.col("rep").alias("b")))
    found = connected_components(links.toDF("u", "v"))
    mixed = settled(mixed_members(labelled(members.select("bucket", "rep"), found)).select("rep").distinct())
    found = linked_members(
        compared.crowds(mixed), found, compared.links, "n <= hub_n_reach AND hub_n <= n_reach", ["n", "n_reach"]
    )
    labels = (
        classes.join(found, classes.rep == found.id, "left")
        .select("content", F.coalesce("component", "rep").alias("component_id"))
    )
    grouped = marked.select("id", "n", "content").join(labels, "content", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return grouped.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), component).alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )


class _Comparison:
    """Compares candidate pairs: lengths and sketches first, then full sets of shingles."""

    def __init__(self, heads: DataFrame, plain: DataFrame, members: DataFrame, percent: int, width: int):
        bands, rows = banding(percent)
        self.slots, self.percent, self.width = bands * rows, percent, width
        wanted = settled(members.select("rep").union(members.select("hub")).distinct().toDF("id"))
        small = sized(wanted, 16)
        self.sketches = settled(
            heads.join(small, heads.rep == small.id, "left_semi").select(F.col("rep").alias("id"), "n", "sketch")
        )
        self.texts = settled(plain.join(small, "id", "left_semi"))

    def crowds(self, reps: DataFrame) -> DataFrame:
        """``(bucket, rep, n, n_reach)``: the members in buckets of their rarest shingles.

        Any common order of the shingles keeps every link; rarity is taken from a
        table of counts by hash, whose size is fixed. If the bucket's shingle is the
        first that two sets share, they share no more than what follows it in
        either: a partner's size is at most ``n_reach``.
        """
        texts = settled(
            self.texts.join(sized(reps, 16), self.texts.id == reps.rep, "left_semi").select("id", "text")
        )
        width, percent = self.width, self.percent

        def count(batches):
            held = np.zeros(1 << COUNT_BITS, np.int64)
            for batch in batches:
                for text in text_bytes(batch, "text"):
                    np.add.at(held, shingle_set(lower_words(text), width) >> U64(64 - COUNT_BITS), 1)
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["place", "n"])

        counted = texts.mapInArrow(count, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros(1 << COUNT_BITS, np.int64)
        counts[counted.column("place").to_numpy()] = counted.column("n").to_numpy()

        def rarest(batch: pa.RecordBatch):
            for rep, text in zip(batch.column("id").to_pylist(), text_bytes(batch, "text"), strict=True):
                found = shingle_set(lower_words(text), width)
                order = np.lexsort((found, counts[found >> U64(64 - COUNT_BITS)]))
                n = len(found)
                head = found[order[: n - -(-percent * n // 100) + 1]]
                reach = (n - np.arange(len(head))) * (100 + percent) // percent - n
                columns = [head.view(np.int64), np.full(len(head), rep), np.full(len(head), n), reach]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["bucket", "rep", "n", "n_reach"]
                )

        rows = settled(map_batches(texts, rarest, "bucket bigint, rep bigint, n bigint, n_reach bigint"))
        least = rows.groupBy("bucket").agg(F.min("n").alias("least"), F.max("n_reach").alias("most"))
        return rows.join(least, "bucket").where("least <= n_reach AND n <= most").drop("least", "most")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs ``(a, b)`` that reach the threshold."""
        left, right = (
            self.sketches.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
            for c in ("a", "b")
        )
        near = (
            pairs.where("a <> b").distinct().join(right, "b").join(left, "a")
            .where(f"100 * least(n_a, n_b) >= {self.percent} * greatest(n_a, n_b)")
            .select("a", "b", "sketch_a", "sketch_b")
        )
        close = settled(map_batches(near, _sketch_filter(self.slots, self.percent), "a bigint, b bigint").distinct())
        first = sized(close, 24).join(self.texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        ends = sized(settled(close.select("a").distinct()), 16)
        hubs = settled(self.texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")).join(ends, "a", "left_semi"))
        both = first.join(hubs, "a").select("a", "b", "text_a", "text_b")
        return settled(map_batches(both, _verifier(self.percent, self.width), "a bigint, b bigint").distinct())


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those that a near copy with a smaller id stands for.

    Rows without id are kept. Of rows that repeat an id, all are kept or none.
    """
    gone = near_duplicates(docs, id_col, text_col, percent).where("NOT kept").select(
        F.col("doc_id").alias("__gone")
    ).distinct()
    return docs.join(sized(settled(gone), 16), docs[id_col] == F.col("__gone"), "left_anti")
