"""Many small blocks in one task: rows come sorted by their block's keys, and one block is in memory at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

Step = Callable[[pa.Table], pa.Table]


def _starts(batch: pa.RecordBatch, keys: Sequence[str]) -> list[int]:
    """Where a row's keys differ from those of the row before."""
    differs = np.zeros(max(0, batch.num_rows - 1), bool)
    for k in keys:
        x = batch.column(k).to_numpy(zero_copy_only=False)
        differs |= x[1:] != x[:-1]
    return [0, *(np.flatnonzero(differs) + 1).tolist()]


def each_block(df: DataFrame, keys: Sequence[str], step: Step, schema: str) -> DataFrame:
    """step's rows for each block of df, a block being the rows with equal keys. step: a function of a table that isn't empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        now: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = _starts(batch, keys)
            for lo, hi in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                key = tuple(batch.column(k)[lo].as_py() for k in keys)
                if parts and key != now:
                    yield from step(pa.Table.from_batches(parts)).to_batches()
                    parts = []
                now = key
                parts.append(batch.slice(lo, hi - lo))
        if parts:
            yield from step(pa.Table.from_batches(parts)).to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
