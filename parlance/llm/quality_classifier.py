"""Operator 6, quality classifier: compression with dictionaries built from good and from bad text.

Each text is cut into pieces of `PIECE` bytes, every piece is compressed with either zstandard dictionary, and the sizes are
summed over the whole text. The normalised difference (bad - good) / (bad + good), and nothing else, becomes a score through a
logistic curve of two numbers, fitted on labelled rows that gave no text to the dictionaries. Pieces are short, so that what a
text repeats is compressed by what the dictionaries know rather than by itself.

Learning takes bounded samples: `PIECES` pieces of labelled text for each dictionary and `CALIBRATION` labelled rows, chosen
by hashes of their keys. Only the pieces, and one number for each calibration row, reach the driver. Scoring reads every
whole text.

Edge cases: null and empty texts have a difference of 0 and get the curve's value there. Repeated rows are scored one by one.
Null labels are left out. Without labels of both kinds every score is the share of label 1, or 0 without any. Extra columns
stay; where one is called like the output, the output's name gets underscores. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import fresh

PIECE = 512
PIECES = 6_000
CALIBRATION = 8_000
DICTIONARY = 112_640
LEVEL = 3


@dataclass
class Model:
    good: bytes
    bad: bytes
    raw: tuple[bool, bool]
    weights: np.ndarray
    prior: float | None = None


def dictionary(samples: list[bytes], size: int = DICTIONARY) -> tuple[bytes, bool]:
    """A trained dictionary, or the samples themselves (True) where they are too few for training."""
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=8).as_bytes(), False
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or b"\n" * 8, True


class Sizes:
    """Compressed sizes of a text's pieces under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes, raw: tuple[bool, bool]) -> None:
        kinds = {True: zstandard.DICT_TYPE_RAWCONTENT, False: zstandard.DICT_TYPE_AUTO}
        self.packers = []
        for data, plain in zip((good, bad), raw, strict=True):
            d = zstandard.ZstdCompressionDict(data, dict_type=kinds[plain])
            d.precompute_compress(level=LEVEL)
            self.packers.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))

    def __call__(self, text: str | None) -> float:
        """The normalised difference of both sizes, above 0 for text that the good dictionary fits better."""
        data = (text or "").encode()
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        good, bad = (sum(len(p.compress(x)) for x in pieces) for p in self.packers)
        return (bad - good) / max(1, bad + good)


def curve(x: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(x)), 10 * x], 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """labels: columns key and label (0 or 1, one per key). Odd hashes of the key go to the dictionaries, even ones to the curve."""
    known = labels.where(F.col("label").isNotNull()).groupBy(F.col("key").alias("_key")).agg(F.max("label").cast("int").alias("label"))
    ones = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < ones[1] < ones[0]:
        return Model(b"", b"", (True, True), np.zeros(2), float(ones[1] / ones[0]) if ones[0] else 0.0)
    known = known.withColumn("_hash", F.xxhash64("_key")).withColumn("_part", F.pmod("_hash", F.lit(2)))
    body = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    # rows enough for all pieces even where each has one only; pieces are then chosen among theirs. What is broadcast is as bounded
    found = []
    for label in (1, 0):
        rows = body.join(F.broadcast(known.where((F.col("_part") == 1) & (F.col("label") == label)).orderBy("_hash", "_key").limit(PIECES)), "_key")
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("text")), F.lit(PIECE))
        pieces = rows.select("_key", "text", F.explode(starts).alias("at")).select("_key", "at", F.substring(F.col("text"), F.col("at"), F.lit(PIECE)).alias("piece"))
        chosen = pieces.where(F.length("piece") > 7).orderBy(F.xxhash64("_key", "at"), "_key", "at").limit(PIECES).collect()
        found.append(dictionary([r["piece"].encode() for r in chosen]))
    (good, plain_good), (bad, plain_bad) = found
    model = Model(good, bad, (plain_good, plain_bad), np.zeros(2))

    rows = body.join(F.broadcast(known.where(F.col("_part") == 0).orderBy("_hash", "_key").limit(CALIBRATION)), "_key")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good, model.bad, model.raw)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sizes(t) for t in b.column(1).to_pylist()], pa.float64())], ["label", "x"])

    seen = np.array(sorted(rows.select("label", "text").mapInArrow(measure, "label int, x double").collect()), float)  # CALIBRATION rows at most
    if len(seen):
        model.weights = logistic(curve(seen[:, 1]), seen[:, 0])
    return model


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """docs with a column `out`, 0 to 1 and higher for better text."""
    (out,) = fresh(docs, [out])
    if model.prior is not None:
        return docs.withColumn(out, F.lit(model.prior))

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizes = Sizes(model.good, model.bad, model.raw)
        for batch in texts:
            x = curve(np.array([sizes(t) for t in batch], float))
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30))))

    return docs.withColumn(out, run(F.col(text)))
