"""Exact nearest-rank quantiles: of n values in order, the one at (0-based) min(n - 1, floor(n * p)).

Values are counted first, so what a group's window orders is its distinct values (work seconds of a bounded time range), never
its rows; a group that holds a third of all rows is summed on the map side like any other.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POINTS = {"p50": 0.5, "p90": 0.9}


def of_sorted(values: Column, p: float) -> Column:
    """Of a sorted array; null where it is empty."""
    n = F.size(values)
    return F.get(values, F.least(n - 1, F.floor(n * F.lit(p))).cast("int"))


def nearest_rank(df: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float] = POINTS) -> DataFrame:
    """One row for each key with a value that isn't null: keys and one column per point. Without keys, exactly one row."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    up_to = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumns({"_upto": F.sum("_n").over(up_to), "_all": F.sum("_n").over(group)})
    pick = lambda p: F.min(F.when(F.col("_upto") >= F.least(F.col("_all"), F.floor(F.col("_all") * F.lit(p)) + 1), F.col(value)))
    return ranked.groupBy(*keys).agg(*[pick(p).alias(name) for name, p in points.items()])


def counted(df: DataFrame, keys: Sequence[str], value: str, counts: Mapping[str, Column], points: Mapping[str, float] = POINTS, weight: str | None = None) -> DataFrame:
    """keys, the counts and the quantiles of a value, from one grouping by the keys and the value. Counts are sums over rows.

    Rows without value count but give no quantile. weight: how many values a row stands for, one if it isn't named. Without keys
    there is one row, also of nothing, where counts are 0.
    """
    per = df.groupBy(*keys, value).agg(*[c.alias(n) for n, c in counts.items()], (F.sum(F.when(F.col(value).isNotNull(), F.col(weight))) if weight else F.count(value)).alias("_n"))
    return picked(per.na.fill(0, ["_n"]), keys, value, counts, points)


def picked(per: DataFrame, keys: Sequence[str], value: str, names: Iterable[str], points: Mapping[str, float] = POINTS) -> DataFrame:
    """counted's last step: per has one row for each of the keys and values, with the counts and how many values (_n) it stands for."""
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    up_to = group.orderBy(F.asc_nulls_first(value)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = per.withColumns({"_upto": F.sum("_n").over(up_to), "_all": F.sum("_n").over(group)})
    pick = lambda p: F.min(F.when((F.col("_n") > 0) & (F.col("_upto") >= F.least(F.col("_all"), F.floor(F.col("_all") * F.lit(p)) + 1)), F.col(value)))
    return ranked.groupBy(*keys).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names], *[pick(p).alias(name) for name, p in points.items()])
