"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweft.session import cut_lineage

#: A word of the contracts: a run of anything but the six ASCII white spaces.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one vectorised step works on.
BLOCK_BYTES = 1 << 20

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """The rows in a reliable checkpoint, so that later jobs neither repeat nor lose them."""
    return cut_lineage(df)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | list], schema: str) -> DataFrame:
    """Apply ``fn`` to Arrow batches, inside the tasks that hold the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(run, schema)


def text_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """UTF-8 bytes of a text column, without decoding."""
    return batch.column(name).cast(pa.large_binary()).to_pylist()


def text_blocks(batch: pa.RecordBatch, name: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes | None]]]:
    """A text column in runs of rows holding about ``limit`` bytes, with their first row.

    Only one run at a time is turned into Python objects; a longer text is a run alone.
    """
    column = batch.column(name)
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = 0
    while start < len(sizes):
        end = start + max(1, int(np.searchsorted(np.cumsum(sizes[start : start + 4096]), limit)))
        yield start, column.slice(start, end - start).cast(pa.large_binary()).to_pylist()
        start = end


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))


#: Odd multipliers, one per place in a shingle.
PLACES = mix(np.arange(1, 65, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def lower_words(text: bytes | None) -> list[bytes]:
    """Words of a text with A-Z in lower case; ``bytes`` knows exactly the six white spaces."""
    return text.lower().split() if text else []


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of ``width`` words; a shorter text is one run."""
    if not words:
        return np.empty(0, U64)
    hashes = word_hashes(words)
    n = min(width, len(words))
    total = np.full(len(words) - n + 1, U64(n))
    for place in range(n):
        total += hashes[place : len(words) - n + 1 + place] * PLACES[place]
    return np.unique(mix(total))


#: A join side of at most so many bytes goes to every task; a larger one is shuffled.
BROADCAST_BYTES = 8 << 20


def sized(side: DataFrame, row_bytes: int) -> DataFrame:
    """``side`` (settled, rows of ``row_bytes``) for a join: counted, and sent out whole if small."""
    return F.broadcast(side) if side.count() * row_bytes <= BROADCAST_BYTES else side


def same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))
