"""The engine's tables as parquet, partitioned by day where rows have one; Spark replaces the days that a run touches.

Rows of a run become known through one table: group_day, whose credential (fact_completed_time) says that a room-day's facts are
whole, and whose label state says that its labels are. A run withholds both first, then replaces the other tables, and writes
group_day last. Whatever a run that dies leaves behind is therefore not known to be complete, and running it again makes it so.
Replacing is by day and by rooms: rows of other rooms stay, and a day that is left without rows goes. One run writes at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.plans.window import Window
from parlance.schema import schema

#: The day of a table's rows; the others are small and have no partitions.
DAYS = {"event": "occurred_on", "group_day": "dt", "agent_day": "dt", "agent_msg_day": "dt"}


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _there(self, name: str):  # noqa: ANN202
        """The table's folder and its file system, or nothing where it was never written."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return (path, fs) if fs.exists(path) else None

    def read(self, name: str, days: Window | None = None) -> DataFrame:
        """A table as it is now, or some of its days."""
        if not self._there(name):
            return self.spark.createDataFrame([], schema(name))
        df = self.spark.read.schema(schema(name)).parquet(self.path(name)).select(*schema(name).names)
        return df.where(F.col(DAYS[name]).between(F.lit(days.since), F.lit(days.until))) if days else df

    def days(self, name: str) -> list[date]:
        """The days that have a partition."""
        if not (found := self._there(name)):
            return []
        path, fs = found
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(date.fromisoformat(x.partition("=")[2]) for x in names if x.startswith(f"{DAYS[name]}="))

    def _files(self, name: str, d: date) -> set[str]:
        path, fs = self._there(f"{name}/{DAYS[name]}={d}")
        return {x.getPath().getName() for x in fs.listStatus(path)}

    def _cast(self, name: str, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema(name).fields])

    def write(self, name: str, df: DataFrame) -> None:
        """All rows of a small table. df must not read the table."""
        self._cast(name, df).write.mode("overwrite").parquet(self.path(name))

    def append(self, name: str, rows: DataFrame) -> None:
        self._cast(name, rows).write.mode("append").parquet(self.path(name))

    def write_days(self, name: str, df: DataFrame, left_empty: Sequence[date] = ()) -> None:
        """Replace the days that df has rows of; df may read the table. Days of left_empty without rows in df are dropped.

        Spark writes aside and moves whole days when all are written.
        """
        day = DAYS[name]
        room = "roomid" if "roomid" in schema(name).names else "room"
        out = self._cast(name, df).repartitionByRange(day, F.xxhash64(room))  # a day of many rows takes several files
        before = {d: self._files(name, d) for d in set(self.days(name)) & set(left_empty)}
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(self.path(name))
        for d, files in before.items():
            if self._files(name, d) == files:  # nothing was written for it
                path, fs = self._there(f"{name}/{day}={d}")
                fs.delete(path, True)

    def replace_shards(self, name: str, rows: DataFrame, rooms: DataFrame, w: Window) -> None:
        """rows in place of all that the rooms (corpid, roomid) have in the window's days."""
        day = DAYS[name]
        stray = rows.where(~F.col(day).between(F.lit(w.since), F.lit(w.until))).select(day).distinct().take(1)
        if stray:
            raise ValueError(f"{name}: a row of {stray[0][0]} is outside the window")
        room = "roomid" if "roomid" in schema(name).names else "room"
        keys = rooms.select("corpid", F.col("roomid").alias(room)).distinct()
        kept = self.read(name, w).join(keys, ["corpid", room], "left_anti")
        self.write_days(name, kept.unionByName(rows, allowMissingColumns=True), w.days)

    def publish_facts(self, tables: dict[str, DataFrame], group_days: DataFrame, rooms: DataFrame, seen: DataFrame, w: Window) -> None:
        """Replace the window's rows of several tables for rooms, and their group-days last. seen: all rooms with group-days.

        `event` is replaced for rooms alone: what a failed room had stays, though it isn't known to be whole any more.
        """
        hit = seen.select("corpid", "roomid").distinct().withColumn("_hit", F.lit(True))
        self.change_group_days(w.days, hit, ["corpid", "roomid"], {"fact_completed_time": F.lit(None).cast("timestamp_ntz")})
        for name, rows in tables.items():
            self.replace_shards(name, rows, rooms if name == "event" else seen, w)
        self.replace_shards("group_day", group_days, seen, w)

    def change_group_days(self, days: Sequence[date], hit: DataFrame, keys: Sequence[str], values: dict) -> None:
        """Other values for the group-days that hit (keys and a true column _hit) names."""
        there = sorted(set(days) & set(self.days("group_day")))
        if there:
            g = self.read("group_day").where(F.col("dt").isin(there)).join(hit, list(keys), "left")
            self.write_days("group_day", g.withColumns({c: F.when(F.col("_hit"), v).otherwise(F.col(c)) for c, v in values.items()}))

    def record_failures(self, failed: DataFrame, stage: str, run_date: date, w: Window | None) -> None:
        """failed: corpid, roomid, reason."""
        since, until = (F.lit(w.since), F.lit(w.until)) if w else (F.lit(None).cast("date"), F.lit(None).cast("date"))
        self.append("run_failure", failed.select(F.lit(run_date).alias("run_date"), "corpid", "roomid", "reason", F.lit(stage).alias("stage"), since.alias("window_since"), until.alias("window_until"), F.localtimestamp().alias("gmt_created_time")))

    def record_rewrite(self, run_date: date, w: Window, frozen_before: date, rooms: Sequence[str] | None) -> bool:
        """Only where the window begins before the freeze line. No rooms named means all."""
        if w.since >= frozen_before:
            return False
        self.append("rewrite_log", self.spark.createDataFrame([(run_date, w.since, w.until, frozen_before, None if rooms is None else list(rooms))], schema("rewrite_log")))
        return True

    def save_labels(self, labels: DataFrame, w: Window) -> int:
        """Labels (id, event_type, taxonomy_version) into the window's events; the number of rows that really change, 0 on a rerun."""
        new = labels.select("id", F.col("event_type").alias("_type"), F.col("taxonomy_version").alias("_version"))
        joined = self.read("event", w).join(new, "id", "left")
        differs = F.col("_type").isNotNull() & ~(F.col("event_type").eqNullSafe(F.col("_type")) & F.col("taxonomy_version").eqNullSafe(F.col("_version")))
        touched = joined.where(differs).groupBy("occurred_on").agg(F.count("*").alias("n")).collect()  # as many rows as days
        if touched:
            out = joined.where(F.col("occurred_on").isin([r["occurred_on"] for r in touched]))
            self.write_days("event", out.withColumns({"event_type": F.coalesce("_type", "event_type"), "taxonomy_version": F.when(F.col("_type").isNotNull(), F.col("_version")).otherwise(F.col("taxonomy_version"))}))
        return sum(r["n"] for r in touched)

    def set_label_states(self, states: DataFrame) -> None:
        """states: corpid, roomid, dt and state. All go out in one write."""
        hit = states.select("corpid", "roomid", "dt", F.col("state").alias("_state")).withColumn("_hit", F.lit(True))
        days = [r["dt"] for r in hit.select("dt").distinct().collect()]
        self.change_group_days(days, hit, ["corpid", "roomid", "dt"], {"classification_status": F.col("_state")})

    def prune_texts(self, since: date, before: date) -> None:
        """Texts of events of these days are gone for good (null, which isn't an empty list)."""
        e = self.read("event").where((F.col("occurred_on") >= F.lit(since)) & (F.col("occurred_on") < F.lit(before)))
        if any(since <= d < before for d in self.days("event")):
            self.write_days("event", e.withColumn("source_messages", F.lit(None)))

    def oldest_text(self, since: date, before: date) -> date | None:
        rows = self.read("event").where((F.col("occurred_on") >= F.lit(since)) & (F.col("occurred_on") < F.lit(before)) & F.col("source_messages").isNotNull())
        return rows.agg(F.min("occurred_on")).first()[0]

    def stamp(self) -> str:
        """Changes whenever a run has published something: a digest of all room-days' states, the key of a cached answer."""
        g = self.read("group_day")
        row = F.xxhash64("corpid", "roomid", "dt", "event_count", "msg_count", "extraction_status", "classification_status", F.col("fact_completed_time").cast("string"))
        one = g.agg(F.count("*").alias("n"), F.bit_xor(row).alias("a"), F.sum(F.shiftrightunsigned(row, 16)).alias("b")).first()
        return f"{one['n']}-{one['a']}-{one['b']}"


class Answers:
    """Answers to queries, kept by Spark until a run publishes something else."""

    def __init__(self, store: Store) -> None:
        self.store, self.kept = store, {}

    def get(self, key: str, make: Callable[[], DataFrame]) -> DataFrame:
        stamp = self.store.stamp()
        if self.kept.get(key, (None, None))[0] != stamp:
            if key in self.kept:
                self.kept[key][1].unpersist()
            self.kept[key] = (stamp, make().persist())
        return self.kept[key][1]
