"""Operator 11, periodic runs: stretches of words that repeat with a period four times or more.

All lags are scanned: a document's words become numbers, and the array is compared with itself shifted by every lag up to a quarter
of its length. A stretch of equal words at lag q, q words longer, is a run of period q if it spans four periods and six words.
Stretches that a multiple of the smallest period finds again have the same bounds and are dropped.

Most lags need no full comparison. A run of period q has at least 3q equal places in a row, so among the multiples of any step up
to q three neighbours in a row are equal. Lags are taken by octaves, from a step to twice the step, and only those with three such
neighbours are compared whole. What is left out holds no run, so nothing is lost.

Short texts are scanned where they are read. A text that may have many words is cut by lags: each range of lags goes to another
task with the document's numbers (four bytes a word), and its runs meet again by the text's digest. Equal long texts are scanned
once.

Edge cases: a null, empty or blank text has no runs and an empty collapsed text. Repeated rows give repeated results. Extra columns
stay as they are; if one is called runs or collapsed, give other names by out. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Runs span so many periods, and so many words.
PERIODS, LEAST = 4, 6
#: Texts of fewer characters (half as many words at most) are scanned in place.
SHORT_CHARS = 2**17
#: Comparisons of words in one range of lags.
LAG_WORK = 2**30
#: Numbers held at once in a full comparison.
CELLS = 2**20

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def numbered(words: list[bytes]) -> np.ndarray:
    """The words as numbers, equal ones alike."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int32, len(words))


def _likely(ids: np.ndarray, lags: np.ndarray) -> np.ndarray:
    """The lags (from a step to twice the step) at which three multiples of the step in a row are equal."""
    step = int(lags[0])
    at = np.arange(0, len(ids) - step, step)
    shifted = np.concatenate([ids, np.full(lags[-1] + 1, -1, np.int32)])
    same = shifted[np.add.outer(lags, at)] == ids[at]
    return lags[(same[:, :-2] & same[:, 1:-1] & same[:, 2:]).any(axis=1)]


def _compared(ids: np.ndarray, lags: np.ndarray) -> np.ndarray:
    """start, length, period of what repeats at some of the lags, each compared whole."""
    n = len(ids)
    own = np.append(ids, np.int32(-2))  # differs from all, so that each row ends unequal
    shifted = np.concatenate([ids, np.full(lags[-1] + 1, -1, np.int32)])
    same = np.zeros(len(lags) * (n + 1) + 1, bool)
    same[1:] = (np.lib.stride_tricks.sliding_window_view(shifted, n + 1)[lags] == own).ravel()
    edges = np.flatnonzero(same[1:] != same[:-1])
    begin, end = edges[0::2], edges[1::2]
    period = lags[begin // (n + 1)]
    length = end - begin + period
    long = length >= np.maximum(LEAST, PERIODS * period)
    return np.column_stack([begin % (n + 1), length, period])[long]


def scan(ids: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """start, length, period of what repeats at the lags lo to hi - 1."""
    n, found = len(ids), [np.empty((0, 3), np.int64)]
    while lo < hi:
        top = min(hi, 2 * lo)
        lags = np.arange(lo, top)
        if lo >= 8:
            lags = _likely(ids, lags)
        wide = max(1, CELLS // (n + 1))
        found += [_compared(ids, lags[k : k + wide]) for k in range(0, len(lags), wide)]
        lo = top
    return np.concatenate(found)


def smallest(runs: np.ndarray) -> np.ndarray:
    """One row for each stretch, with its smallest period, ordered by start and period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs.tolist():
        kept[start + period : start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(kept).tolist())


def _described(runs: np.ndarray) -> list[dict]:
    return [{"start": s, "length": n, "period": p} for s, n, p in runs.tolist()]


def last_lag(n: int) -> int:
    return n // PERIODS


def _with(df: DataFrame, text: str, out: tuple[str, str]) -> DataFrame:
    """df with the runs and the collapsed text of every row, each scanned whole in its own task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, texts = [], []
            for t in batch.column(text).to_pylist():
                words = (t or "").encode().split()
                ids = numbered(words)
                found = smallest(scan(ids, 1, last_lag(len(ids)) + 1))
                runs.append(_described(found))
                texts.append(collapsed(words, found).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(runs, _RUNS), pa.array(texts, pa.string())], names=[*batch.schema.names, *out])

    return df.mapInArrow(run, StructType([*df.schema.fields, *StructType.fromDDL(f"{out[0]} {RUNS}, {out[1]} string").fields]))


def _ranges(texts: DataFrame) -> DataFrame:
    """Rows of digest and text as ranges of lags with the document's numbers; the first range keeps the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, text in zip(batch.column("digest").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = numbered(text.encode().split())
                top, wide = last_lag(len(ids)) + 1, max(1, LAG_WORK // max(1, len(ids)))
                for lo in range(1, max(2, top), wide):
                    one = {"digest": digest, "lo": lo, "hi": min(top, lo + wide), "ids": ids.tobytes(), "text": text if lo == 1 else None}
                    yield pa.RecordBatch.from_pylist([one], pa.schema([("digest", pa.string()), ("lo", pa.int64()), ("hi", pa.int64()), ("ids", pa.binary()), ("text", pa.string())]))

    return texts.mapInArrow(run, "digest string, lo bigint, hi bigint, ids binary, text string")


def _scanned(ranges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_described(scan(np.frombuffer(r["ids"], np.int32), r["lo"], r["hi"])) for r in batch.select(["ids", "lo", "hi"]).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("text"), pa.array(found, _RUNS)], names=["digest", "text", "runs"])

    return ranges.mapInArrow(run, f"digest string, text string, runs {RUNS}")


def _finished(whole: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, texts = [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                rows = smallest(np.array([(r["start"], r["length"], r["period"]) for r in found], np.int64).reshape(-1, 3))
                runs.append(_described(rows))
                texts.append(collapsed(text.encode().split(), rows).decode())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(runs, _RUNS), pa.array(texts, pa.string())], names=["digest", "runs", "collapsed"])

    return whole.mapInArrow(run, f"digest string, runs {RUNS}, collapsed string")


def find_runs(df: DataFrame, text: str = "text", out: tuple[str, str] = ("runs", "collapsed")) -> DataFrame:
    """df with two columns more: the runs (start, length, period; by start, then period) and the text without their repetitions."""
    if taken := {c.lower() for c in df.columns} & {c.lower() for c in out}:
        raise ValueError(f"taken: {sorted(taken)}")
    is_long = F.coalesce(F.length(text), F.lit(0)) >= SHORT_CHARS
    short = _with(df.where(~is_long), text, out)
    rows = df.where(is_long).withColumn("_digest", F.sha2(F.col(text).cast("binary"), 256))
    texts = rows.groupBy(F.col("_digest").alias("digest")).agg(F.min(text).alias("text"))
    found = _scanned(_ranges(texts).repartition("digest", "lo")).groupBy("digest").agg(F.max("text").alias("text"), F.flatten(F.collect_list("runs")).alias("runs"))
    done = _finished(found).select(F.col("digest").alias("_digest"), F.col("runs").alias(out[0]), F.col("collapsed").alias(out[1]))
    return short.unionByName(rows.join(done, "_digest").drop("_digest"))
