"""Stateful streams against the batch result."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parlance.operators.extraction import followup_wait
from parlance.streaming import waits

T0 = datetime(2026, 8, 24, 9)
COLUMNS = "corp string, room string, event_no long, msg_id string, at timestamp_ntz, sender_role string"


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_followup_waits_equal_the_batch(spark, rocks, tmp_path):
    """Three batches with late and repeated messages, the stream restarted from its checkpoint before each; the last one ends all events."""
    rng = random.Random(8)
    rows = [("C", f"R{e % 3}", e, f"m{e}-{i}", T0 + timedelta(seconds=rng.randrange(3 * 86_400)), rng.choice(["EXTERNAL", "INTERNAL", "OTHER"])) for e in range(12) for i in range(rng.randrange(1, 9))]
    rows.sort(key=lambda r: r[4])
    third = len(rows) // 3
    late = [r for r in rows[:third] if rng.random() < 0.2]
    first = [r for r in rows[:third] if r not in late]
    batches = [first, late + rows[third : 2 * third] + first[:4], rows[2 * third :], [("C", "R9", 99, "end", T0 + timedelta(days=60), "EXTERNAL")], [("C", "R9", 100, "end", T0 + timedelta(days=90), "EXTERNAL")]]

    def step():
        stream = spark.readStream.schema(COLUMNS).parquet(str(tmp_path / "in"))
        out = waits.followup_waits(stream, "4 days", timedelta(days=3))
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).outputMode("append").trigger(availableNow=True).start().awaitTermination()

    for k, batch in enumerate(batches):
        spark.createDataFrame(batch, COLUMNS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        step()
        assert k > 2 or spark.read.parquet(str(tmp_path / "out")).count() == 0
    got = {r["event_no"]: (r["messages"], r["followup_wait"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    m = F.struct("at", "msg_id", "sender_role")
    batch = spark.createDataFrame(rows, COLUMNS).groupBy("event_no").agg(F.count("*").alias("n"), followup_wait(F.array_sort(F.collect_list(m))).alias("wait"))
    want = {r["event_no"]: (r["n"], r["wait"]) for r in batch.collect()}
    assert {k: v for k, v in got.items() if k < 99} == want
