"""Operator 5, toxicity: a factorization machine over hashed terms.

Terms are a text's distinct lower-case words and their first four and five letters, hashed into 2^18 buckets. Every bucket is a
feature. Its value says how well it tells the labels apart in the learning rows: chi / (chi + SHRINK), with chi its chi-square
there; so a rare or even-handed term counts little, whatever its weight, and none is left out. A text's values are scaled to
length 1. Beside a weight for each bucket the machine learns a short vector, and the products of two buckets' vectors add what
they say together, such as an insult and the mention of a group.

Learning takes a bounded sample: `sample` labelled rows, chosen by a hash of their key; their terms reach the driver. A tenth of
them decides when learning stops. Scoring reads every whole text.

Edge cases: null and empty texts have no features and get the machine's bias as score. Repeated rows are scored one by one.
Labels that are null are left out. Without labels of both kinds every score is the share of label 1, or 0 without any. Extra
columns are ignored. An empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 18
SAMPLE = 20_000
SHRINK = 40.0
FACTORS = 4
EPOCHS = 12
PATIENCE = 2
_WORD = re.compile(r"[^\W\d_]+")


def word_buckets(word: str) -> set[int]:
    parts = {word} | {f"{n}:{word[:n]}" for n in (4, 5) if len(word) >= n}
    return {zlib.crc32(p.encode()) % BUCKETS for p in parts}


class Terms:
    """Buckets of a text's terms. Words seen before are remembered, up to a bound."""

    def __init__(self, memory: int = 500_000) -> None:
        self.memory, self.known = memory, {}

    def _of(self, word: str) -> set[int]:
        if len(self.known) >= self.memory:
            self.known.clear()
        self.known[word] = out = word_buckets(word)
        return out

    def __call__(self, text: str | None) -> list[int]:
        known, out = self.known, set()
        for w in set(_WORD.findall((text or "").lower())):
            got = known.get(w)
            out.update(self._of(w) if got is None else got)
        return sorted(out)


def values(rows: list[np.ndarray], labels: np.ndarray, n: int, shrink: float = SHRINK) -> np.ndarray:
    """The value of each of n buckets: chi / (chi + shrink)."""
    of = lambda some: np.bincount(np.concatenate([np.zeros(0, int), *some]), minlength=n)
    every, ones, p = of(rows), of([r for r, y in zip(rows, labels, strict=True) if y]), labels.mean()
    chi = (ones - every * p) ** 2 / np.maximum(every * p * (1 - p), 1e-9)
    return (chi / (chi + shrink)).astype(np.float32)


@dataclass
class Machine:
    bias: float
    values: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def _logits(self, f: np.ndarray, starts: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of rows that aren't empty: f holds their features one after the other, r the row of each, starts where rows begin."""
        x = self.values[f]
        x = x / np.sqrt(np.add.reduceat(x * x, starts) + 1e-3)[r]
        vx = self.factors[f] * x[:, None]
        total = np.add.reduceat(vx, starts)
        z = self.bias + np.add.reduceat(self.weights[f] * x, starts) + 0.5 * ((total**2).sum(1) - np.add.reduceat((vx**2).sum(1), starts))
        return z, x, vx, total

    def score(self, rows: list[list[int]] | list[np.ndarray]) -> np.ndarray:
        """Scores of many rows of buckets at once."""
        long = np.array([len(r) for r in rows], int)
        z, some = np.full(len(rows), self.bias), np.flatnonzero(long)
        if len(some):
            f = np.concatenate([np.asarray(rows[i], int) for i in some])
            starts = np.cumsum([0, *long[some][:-1]])
            z[some] = self._logits(f, starts, np.repeat(np.arange(len(some)), long[some]))[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(rows: list[np.ndarray], labels: np.ndarray, n: int, factors: int = FACTORS, epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-4, batch: int = 64, seed: int = 1) -> Machine:
    """A machine over n buckets, by mini-batches with per-parameter step sizes; that of the epoch which fits a tenth of the rows best."""
    rng = np.random.default_rng(seed)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    m = Machine(float(np.log(share / (1 - share))), values(rows, labels, n), np.zeros(n, np.float32), rng.normal(0, 0.01, (n, factors)).astype(np.float32))
    sw, sv, sb = np.full(n, 1e-6), np.full((n, factors), 1e-6), 1e-6
    order = rng.permutation(len(rows))
    aside, learn = order[: len(rows) // 10], np.array([i for i in order[len(rows) // 10 :] if len(rows[i])], int)
    best, at_best, waited = (m.bias, m.weights.copy(), m.factors.copy()), np.inf, 0
    for _ in range(epochs):
        order = rng.permutation(learn)
        for s in range(0, len(order), batch):
            ids = order[s : s + batch]
            long = np.array([len(rows[i]) for i in ids])
            f, r, starts = np.concatenate([rows[i] for i in ids]), np.repeat(np.arange(len(ids)), long), np.cumsum([0, *long[:-1]])
            z, x, vx, total = m._logits(f, starts, r)
            off = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[ids]
            at, slot = np.unique(f, return_inverse=True)
            step = off[r] * x
            dw = np.bincount(slot, step) + decay * m.weights[at]
            each = step[:, None] * (total[r] - vx)
            dv = np.stack([np.bincount(slot, each[:, k]) for k in range(factors)], 1) + decay * m.factors[at]
            sw[at] += dw**2
            sv[at] += dv**2
            m.weights[at] -= rate * dw / np.sqrt(sw[at])
            m.factors[at] -= 0.3 * rate * dv / np.sqrt(sv[at])
            sb += off.sum() ** 2
            m.bias -= rate * off.sum() / np.sqrt(sb)
        p, y = np.clip(m.score([rows[i] for i in aside]), 1e-9, 1 - 1e-9), labels[aside]
        loss = -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean() if len(aside) else -np.inf
        if loss < at_best or not len(aside):
            best, at_best, waited = (m.bias, m.weights.copy(), m.factors.copy()), loss, 0
        elif (waited := waited + 1) >= PATIENCE:
            break
    m.bias, m.weights, m.factors = best
    return m


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Machine:
    """labels: columns key and label (0 or 1, one per key)."""
    chosen = labels.where(F.col("label").isNotNull()).groupBy(F.col("key").alias("_key")).agg(F.max("label").cast("int").alias("label"))
    # at most `sample` keys are broadcast, and the terms of their rows reach the driver
    chosen = chosen.withColumn("_hash", F.xxhash64("_key")).orderBy("_hash", "_key").limit(sample)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(chosen), "_key").select("_hash", "label", "text")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([terms(t) for t in b.column(2).to_pylist()], pa.list_(pa.int32()))], ["hash", "label", "terms"])

    found = rows.mapInArrow(listed, "hash long, label int, terms array<int>").toArrow()
    hashes, y, lists = found.column("hash").to_numpy(), found.column("label").to_numpy().astype(float), found.column("terms").combine_chunks()
    if not 0 < y.sum() < len(y):
        return Machine(30.0 if y.sum() else -30.0, *[np.zeros(1, np.float32)] * 2, np.zeros((1, FACTORS), np.float32))
    flat, at = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    # the order of rows comes from their keys, that of rows with one key from their terms
    order = sorted(range(len(y)), key=lambda i: (hashes[i], hashlib.blake2b(flat[at[i] : at[i + 1]].tobytes()).digest()))
    return train([flat[at[i] : at[i + 1]] for i in order], y[order], BUCKETS)


def score(docs: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score (0 to 1) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for b in batches:
            lists = [terms(t) for t in b.column(1).to_pylist()]
            f = machine.score(lists if len(machine.values) > 1 else [[]] * len(lists))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(f, pa.float64())], ["key", "score"])

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)
