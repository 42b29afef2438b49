"""Derived tables kept up to date by day: catalog tables partitioned by day and room bucket, of which a batch replaces what it touches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.operators import dayroll
from parlance.operators.aggregates import participation

#: Partitions of a day.
BUCKETS = 16


def bucket() -> Column:
    return F.pmod(F.xxhash64("corpid", "roomid"), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class Derived:
    """A table made from events room-day by room-day. make: its rows from events, with corpid, roomid and occurred_on among them."""

    spark: SparkSession
    name: str
    make: Callable[[DataFrame], DataFrame]

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop("bucket")

    def create(self, events: DataFrame) -> None:
        columns = ", ".join(f"`{n}` {t}" for n, t in self.make(events).dtypes if n != "occurred_on")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, occurred_on date, bucket int) USING parquet PARTITIONED BY (occurred_on, bucket)")

    def refresh(self, changed: DataFrame, events: DataFrame) -> list[tuple]:
        """Make anew what changed room-days (corpid, roomid, occurred_on) touch; events: all as they are now. Gives the partitions.

        A partition that has no rows any more is dropped. Partitions are replaced one by one, each whole: a batch that dies is
        run again, and what it did before stays right.
        """
        self.create(events)
        parts = changed.select("occurred_on", bucket().alias("bucket")).distinct()
        touched = sorted(tuple(r) for r in parts.collect())  # days of the batch times BUCKETS
        if not touched:
            return []
        here = events.withColumn("bucket", bucket()).join(F.broadcast(parts), ["occurred_on", "bucket"], "left_semi").drop("bucket")
        made = self.make(here).withColumn("bucket", bucket())
        order = self.spark.table(self.name).columns
        mode = "spark.sql.sources.partitionOverwriteMode"  # inserts know it as a setting alone
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            made.select(*order).repartition("occurred_on", "bucket").write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(mode, before)
        left = {tuple(r) for r in events.withColumn("bucket", bucket()).join(F.broadcast(parts), ["occurred_on", "bucket"], "left_semi").select("occurred_on", "bucket").distinct().collect()}
        for day, k in touched:
            if (day, k) not in left:
                self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (occurred_on = DATE '{day}', bucket = {k})")
        return touched


    def analyze(self) -> None:
        """Statistics for Spark's planner, after a batch."""
        self.spark.sql(f"ANALYZE TABLE {self.name} COMPUTE STATISTICS FOR COLUMNS corpid, roomid, occurred_on")


def rolls(spark: SparkSession, name: str = "day_rolls") -> Derived:
    return Derived(spark, name, dayroll.day_rolls)


def participations(spark: SparkSession, name: str = "participation") -> Derived:
    return Derived(spark, name, participation)
