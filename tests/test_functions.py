"""Golden cases of work time, quantiles, events and texts."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from parlance.functions import events as E
from parlance.functions import text as X
from parlance.functions import worktime
from parlance.functions.quantile import nearest_rank, of_sorted

QUANTILES = [([], None, None), ([42], 42, 42), ([10, 20], 20, 20), ([10, 20, 30], 20, 30), ([10, 20, 30, 40], 30, 40), (list(range(5, 51, 5)), 30, 50), (list(range(10, 111, 10)), 60, 100), ([100, 100, 100], 100, 100)]


def test_work_seconds(spark):
    t = lambda x: datetime.strptime(f"2026-08-{x}", "%Y-%m-%d %H:%M")
    cases = [("25 09:00", "25 10:00", 3600), ("25 07:00", "25 09:00", 1800), ("25 21:30", "25 23:00", 0), ("25 22:00", "26 08:00", 0), ("25 20:30", "26 09:00", 3600), ("25 20:30", "27 09:00", 48600), ("25 10:00", "25 09:00", 0)]
    rows = [(t(a), t(b), n) for a, b, n in cases] + [(t("25 09:00"), None, None)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, n long")
    assert all(r["n"] == r["got"] for r in df.withColumn("got", worktime.between(F.col("a"), F.col("b"))).collect())


def test_quantiles(spark):
    rows = [(i, v) for i, (vs, _, _) in enumerate(QUANTILES) for v in vs] + [(99, None)]
    got = {r["k"]: (r["p50"], r["p90"]) for r in nearest_rank(spark.createDataFrame(rows, "k int, v long"), ["k"], "v").collect()}
    assert got == {i: (a, b) for i, (_, a, b) in enumerate(QUANTILES) if a is not None}
    arrays = spark.createDataFrame([(vs, a, b) for vs, a, b in QUANTILES], "vs array<long>, a long, b long")
    assert all((r[0], r[1]) == (r[2], r[3]) for r in arrays.select(of_sorted(F.col("vs"), 0.5), of_sorted(F.col("vs"), 0.9), "a", "b").collect())
    none = nearest_rank(spark.createDataFrame([], "v long"), [], "v").collect()
    assert [tuple(r) for r in none] == [(None, None)]


def test_event_conditions(spark):
    t = datetime(2026, 8, 25, 10)
    rows = [("EXTERNAL", None, "overdue"), ("EXTERNAL", datetime(2026, 8, 25, 10, 30), "in time"), ("EXTERNAL", datetime(2026, 8, 25, 10, 30, 1), "overdue"), ("INTERNAL", t, "in time")]
    df = spark.createDataFrame([(r, t, a, n) for r, a, n in rows], "asker_role string, first_msg_time timestamp_ntz, first_agent_reply_time timestamp_ntz, want string")
    assert all((r["got"] is True) == (r["want"] == "overdue") for r in df.withColumn("got", E.is_overdue()).collect())
    assert [r[0] for r in df.select(E.status()).collect()] == ["unreplied", "replied", "overdue", "push"]


def test_group_keys(spark):
    df = spark.createDataFrame([("a",), ("c",), ("zz",), (None,)], "event_type string")
    assert [r[0] for r in df.select(E.group_key([["a", "b"], ["c"]])).collect()] == ["0", "1", "2", None]


@pytest.mark.parametrize(("raw", "want"), [
    ("18472625055-3934 ok", f"{X.MASK_PHONE} ok"),
    ("15836102489-78189", f"{X.MASK_PHONE}-78189"),
    ("order 4316522678525456123", "order 4316522678525456123"),
    ("123456789012", "123456789012"),
    ('"王：\n客户 18472625055"\n------\n好的', "好的"),
    ("@李(李-售后) 你好", f"{X.MASK_AT} 你好"),
    ("a \r\n\n b", "a / b"),
    ("客户姓名：贾 / 地址:x", f"客户姓名：{X.MASK_FIELD} / 地址:{X.MASK_FIELD}"),
    ("改电话", "改电话"),
    ("", ""),
    (None, None),
])
def test_redaction(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(X.redacted(F.col("t"))).first()[0] == want


def test_small_texts(spark):
    df = spark.createDataFrame([("  ", "12", 5, f"{X.MASK_PHONE} a  AB1234567890123456 b")], "blank string, id string, s int, noise string")
    got = df.select(X.non_blank(F.col("blank")), X.long_id(F.col("id")), X.duration(F.col("s")), X.without_noise(F.col("noise")), X.duration(F.lit(3725)), X.duration(F.lit(125))).first()
    assert tuple(map(str, got)) == ("None", "12", "5s", "a b", "1h 2m", "2m 5s")


def test_row_contracts(spark):
    cols = "occurred_on date, first_msg_time timestamp_ntz, last_msg_time timestamp_ntz, event_type string, taxonomy_version string, first_responder string, first_agent_reply_time timestamp_ntz, agents array<string>"
    t, u = datetime(2026, 8, 25, 10), datetime(2026, 8, 25, 9)
    good, bad = (date(2026, 8, 25), t, t, None, None, "A", t, ["A"]), (date(2026, 8, 24), t, u, "x", None, "B", None, ["A"])
    got = [r[0] for r in spark.createDataFrame([good, bad], cols).select(E.row_faults()).collect()]
    assert got == [[], ["day", "order", "label pair", "reply pair", "responder"]]
