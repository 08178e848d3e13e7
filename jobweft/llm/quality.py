"""Quality scores from compression: which of two dictionaries shortens a text more.

A zstandard dictionary is built from pieces of good texts and one from pieces of bad
texts. A text is compressed with each; the difference of the sizes, divided by the
size without a dictionary, says which kind it resembles, and a logistic curve fitted
on labelled texts turns it into a probability.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweft.llm.common import map_batches, settled, text_bytes

#: Bytes of one compressed piece: a dictionary helps most at a text's beginning, so
#: a long text is compressed in pieces, all of it.
PIECE = 2048

#: Bounds of the fit: pieces per label for the dictionaries, and rows for the curve.
TRAIN_PIECES, TRAIN_ROWS = 6000, 20000

DICTIONARY_BYTES, LEVEL = 64 << 10, 3


def pieces(text: bytes, size: int = PIECE) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)]


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, text: bytes | None) -> float:
        """Share of the compressed size that the good dictionary saves beyond the bad one."""
        if not text:
            return 0.0
        plain, good, bad = _compressors(self.good, self.bad)
        sizes = np.zeros(3)
        for piece in pieces(text):
            sizes += [len(c.compress(piece)) for c in (plain, good, bad)]
        return float((sizes[2] - sizes[1]) / sizes[0])

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


@functools.lru_cache(maxsize=2)
def _compressors(good: bytes, bad: bytes):
    options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}

    def with_dictionary(content: bytes):
        data = zstandard.ZstdCompressionDict(content)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=data, **options)

    return zstandard.ZstdCompressor(**options), with_dictionary(good), with_dictionary(bad)


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary of the pieces, or their plain bytes if there are too few."""
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 4)), samples).as_bytes()
    except zstandard.ZstdError:
        return (b"\n".join(samples) or b"\n" * 8)[-size:].rjust(8, b"\n")


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset by Newton's method, with a weak pull to zero for separable data."""
    if not len(x):
        return 0.0, 0.0
    scale = x.std() or 1.0
    design, weights = np.column_stack([x / scale, np.ones(len(x))]), np.zeros(2)
    pull = np.array([1e-2, 1e-2])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (y - p) - pull * weights
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag(pull)
        change = np.linalg.solve(hessian, gradient)
        weights += change
        if np.abs(change).max() < 1e-9:
            break
    return float(weights[0] / scale), float(weights[1])


def _piece_table(labelled: DataFrame, text_col: str) -> DataFrame:
    def cut(batch: pa.RecordBatch):
        labels, ids = batch.column("label").to_pylist(), batch.column("id").to_pylist()
        rows = [
            (ids[i], labels[i], n, piece)
            for i, text in enumerate(text_bytes(batch, text_col)) if text
            for n, piece in enumerate(pieces(text))
        ]
        for start in range(0, len(rows), 5000):
            some = rows[start : start + 5000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in some], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                names=["id", "label", "n", "piece"],
            )

    return map_batches(labelled.select("id", "label", text_col), cut, "id bigint, label int, n bigint, piece binary")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> CompressionModel:
    """Fit on the texts of ``docs`` that ``labels(id, label)`` marks 0 or 1.

    ``TRAIN_ROWS`` labels are chosen by a hash before any text is read, so their
    texts need no shuffle. Half of them give ``TRAIN_PIECES`` pieces of each label
    for the dictionaries, the other half the points of the curve. These bounds, not
    the tables, decide what comes to the driver (some 25 MB of pieces, and numbers).
    Other labels, and rows without text, teach nothing. Without any labelled row all
    scores are one half.
    """
    chosen = settled(
        labels.where(F.col("label").isin(0, 1) & F.col("id").isNotNull())
        .select(F.col("id").cast("bigint").alias("id"), F.col("label").cast("int").alias("label"))
        .orderBy(F.xxhash64(F.lit(seed), "id"), "id", "label").limit(TRAIN_ROWS)
    )
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    usable = rows.join(F.broadcast(chosen), "id")
    first_half = F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.lit(2)) == 0
    cut = _piece_table(usable.where(first_half), "text")
    kept = []
    for label in (1, 0):
        some = (
            cut.where(F.col("label") == label)
            .orderBy(F.xxhash64(F.lit(seed), "id", "n"), "piece").limit(TRAIN_PIECES).select("piece").toArrow()
        )
        kept.append(build_dictionary([bytes(p) for p in some.column("piece").to_pylist()]))
    model = CompressionModel(*kept)

    def measure(batch: pa.RecordBatch):
        values = [model.margin(t) for t in text_bytes(batch, "text")]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(values, pa.float64())], names=["label", "margin"])

    points = map_batches(usable.where(~first_half).select("label", "text"), measure, "label int, margin double").toArrow()
    slope, offset = fit_logistic(
        points.column("margin").to_numpy(), points.column("label").to_numpy().astype(float)
    )
    return CompressionModel(model.good, model.bad, slope, offset)


def score(docs: DataFrame, model: CompressionModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is good; the text alone decides it.

    A null or empty text has margin 0 and gets the curve's value there. A column of
    ``docs`` that is called ``name`` is replaced.
    """
    @F.pandas_udf("double")
    def scored(texts):
        margins = np.array([model.margin(t.encode() if t else None) for t in texts], dtype=float)
        return pd.Series(model.score(margins))

    return docs.select(*[F.col(c) for c in docs.columns if c != name], scored(F.col(text_col)).alias(name))
