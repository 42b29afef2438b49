"""Days and the spans that cover them, without a join by range."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_covering(days: DataFrame, spans: DataFrame, keys: Sequence[str], day: str, value: str, since: date, until: date, out: str) -> DataFrame:
    """days (all within since..until) with the greatest value of the spans (keys, start, end, value) that cover each day, else null.

    A span is clipped to since..until; one without start covers all of it. It counts as two runs of the largest power of two that
    fits, one from its start and one up to its end. Runs of one length that cover a day start in a frame of that length, so one
    window over a key's days and run starts answers every day, with a frame for each power of two. Runs are reduced to the
    greatest value for each key, start and length before they are shuffled: a key with any number of spans sends one row for each
    day and length at most, and no day is multiplied.
    """
    lo, hi = F.lit(since).cast("date"), F.lit(until).cast("date")
    levels = ((until - since).days + 1).bit_length()
    first, last = F.greatest(F.coalesce("start", lo), lo), F.least(F.coalesce("end", hi), hi)
    clipped = spans.select(*keys, first.alias("_first"), last.alias("_last"), value).where("_first <= _last")
    level = F.expr(f"floor(log2(datediff(_last, _first) + 1 + 1e-6))").cast("int")
    ended = F.expr("date_sub(_last, shiftleft(1, _level) - 1)")
    runs = clipped.withColumn("_level", level).select(*keys, "_level", value, F.explode(F.array("_first", ended)).alias("_at"))
    runs = runs.groupBy(*keys, "_at", "_level").agg(F.max(value).alias(value))
    named = [c for c in days.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in named]).alias("_row")
    both = days.select(*keys, F.col(day).alias("_at"), row, F.lit(None).cast("int").alias("_level"), F.lit(None).cast(spans.schema[value].dataType).alias(value))
    both = both.unionByName(runs, allowMissingColumns=True).withColumn("_number", F.datediff("_at", lo))
    order = Window.partitionBy(*keys).orderBy("_number")
    framed = [F.max(F.when(F.col("_level") == k, F.col(value))).over(order.rangeBetween(1 - (1 << k), 0)) for k in range(levels)]
    best = F.greatest(*framed) if levels > 1 else framed[0]
    out_rows = both.withColumn("_best", best).where("_row is not null")
    return out_rows.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in named], F.col("_best").alias(out)).select(*days.columns, out)
