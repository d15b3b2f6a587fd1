"""Quality classifier by compression.

One zstandard dictionary is trained on good labelled texts and one on bad
ones. A text that compresses better with the good dictionary is likelier
good: the difference of both sizes over their sum, together with the mean size
over the plain size (repetitive junk shrinks with either), goes through a
logistic curve calibrated on labelled texts outside the dictionaries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Model:
    """Dictionaries and the calibrated curve 1 / (1 + exp(-(slopes . x + offset)))."""

    good: bytes
    bad: bytes
    slopes: tuple[float, float]
    offset: float
    piece_bytes: int = 512
    level: int = 3


@lru_cache(maxsize=4)
def compressors(good: bytes, bad: bytes, level: int):
    return tuple(
        zstandard.ZstdCompressor(
            level=level,
            dict_data=zstandard.ZstdCompressionDict(d),
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        for d in (good, bad)
    )


def measures(text: str | None, model: Model) -> tuple[float, float]:
    """(bad - good) / (bad + good) and (bad + good) / (2 * plain), in bytes; 0, 0 if empty.

    The text is compressed piece by piece, so the dictionaries count for all
    of a long text and not for its beginning alone.
    """
    raw = (text or "").encode("utf-8")
    if not raw or not model.good:
        return 0.0, 0.0
    good, bad = compressors(model.good, model.bad, model.level)
    g = b = 0
    for at in range(0, len(raw), model.piece_bytes):
        piece = raw[at : at + model.piece_bytes]
        g += len(good.compress(piece))
        b += len(bad.compress(piece))
    return (b - g) / (b + g), (b + g) / (2 * len(raw))


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    x = np.array([measures(t.as_py(), model) for t in texts], dtype=float).reshape(-1, 2)
    return 1 / (1 + np.exp(-np.clip(x @ np.array(model.slopes) + model.offset, -30, 30)))


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[tuple, float]:
    """Slopes and offset by Newton steps, on standardised columns."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    design = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - ridge * beta
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + ridge * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    slopes = beta[:-1] / spread
    return tuple(map(float, slopes)), float(beta[-1] - slopes @ mean)


def build_dictionary(texts: list[str], size: int, piece_bytes: int) -> bytes:
    """Dictionary trained on pieces of the texts; their plain bytes if they are too few."""
    raw = [t.encode("utf-8") for t in texts]
    pieces = [r[at : at + piece_bytes] for r in raw for at in range(0, len(r), piece_bytes)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(raw)[-size:]


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 1500,
    most_bytes: int = 32_768,
    dictionary_bytes: int = 112_640,
) -> Model:
    """Fits on at most ``per_class`` labelled rows of each class.

    The rows are those of smallest id hash among labels that are not held out
    (remainder 1) and texts of at most ``most_bytes``; so the driver gets at most
    2 * per_class * most_bytes bytes. Half of each class makes its dictionary,
    the other half calibrates. Contradicting labels of one id and null labels
    are left out. Without rows of both classes every score is 0.5, or leans to
    the class there is.
    """
    agreed = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
        .where(F.col("label") == F.col("other"))
        .select("doc_id", "label")
    )
    # Some rows more than needed: texts may be missing, empty or too long.
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = agreed.where("label = 0").orderBy(*order).limit(2 * per_class).unionAll(
        agreed.where("label = 1").orderBy(*order).limit(2 * per_class)
    )
    size = F.octet_length("text")
    texts = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .where((size > 0) & (size <= most_bytes))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )
    rows = []
    for label in (0, 1):
        rows += texts.where(F.col("label") == label).orderBy(*order).limit(per_class).collect()
    return train([(r["label"], r["text"]) for r in rows], dictionary_bytes)


def train(rows: list[tuple[int, str]], dictionary_bytes: int = 112_640) -> Model:
    """Model of (label, text) rows; every second row of a class calibrates."""
    by_class = {label: [t for y, t in rows if y == label] for label in (0, 1)}
    if not by_class[0] or not by_class[1]:
        lean = (len(by_class[1]) > 0) - (len(by_class[0]) > 0)
        return Model(b"", b"", (0.0, 0.0), math.log(3.0) * lean)
    piece = Model.piece_bytes
    made = {y: build_dictionary(texts[::2], dictionary_bytes, piece) for y, texts in by_class.items()}
    model = Model(made[1], made[0], (0.0, 0.0), 0.0)
    rest = [(y, t) for y, texts in by_class.items() for t in (texts[1::2] or texts)]
    x = np.array([measures(t, model) for _, t in rest])
    slopes, offset = logistic_fit(x, np.array([float(y) for y, _ in rest]))
    return replace(model, slopes=slopes, offset=offset)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: likelier good) of every row.

    Only the text enters the score. Null and empty texts have measures 0, 0.
    Rows are scored one by one; the model travels with the task (two
    dictionaries of bounded size).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = pa.array(scores(batch.column(1), model), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), p], names=["doc_id", "score"])

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, score double")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with all their columns."""
    position = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(position), model) >= threshold))

    return docs.mapInArrow(run, docs.schema)
