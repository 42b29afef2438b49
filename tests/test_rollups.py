"""Spans over days, roll-ups, kept tables, pages by key, and user SQL."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parlance.operators import aggregates as A
from parlance.operators import dayroll, detail
from parlance.operators.intervals import latest_covering
from parlance.operators.scope import known_ok_days
from parlance.plans import maintained, queries, surface
from parlance.sources import bridge

DATA = "/root/testdata/sf0.001"
D0 = date(2024, 1, 1)


def rows_of(df, *columns):
    columns = sorted(columns or df.columns)
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in columns)) for r in df.collect())


# spans


@pytest.mark.parametrize(("length", "seed"), [(1, 0), (2, 1), (7, 2), (31, 3)])
def test_latest_covering(spark, length, seed):
    """Against every day and span; spans that begin before the window, end after it, have no start, or are upside down."""
    rng = random.Random(seed)
    day = lambda n: D0 + timedelta(days=n)
    days = [(f"R{r}", day(n), r * n) for r in range(5) for n in range(length) if rng.random() < 0.8]
    spans = []
    for _ in range(120):
        a = rng.randrange(-40, length + 20)
        spans.append((f"R{rng.randrange(6)}", day(a) if rng.random() < 0.97 else None, day(a + rng.choice([-2, 0, 0, 1, 2, 5, 16, 60])), rng.randrange(1000)))
    spans = [(k, a, b if a else None, v) for k, a, b, v in spans]
    got = latest_covering(spark.createDataFrame(days, "room string, dt date, start int"), spark.createDataFrame(spans, "room string, start date, end date, at int"), ["room"], "dt", "at", D0, day(length - 1), "best")
    assert got.columns == ["room", "dt", "start", "best"]
    want = Counter((max((v for k, a, b, v in spans if k == room and (a is None or a <= dt <= b)), default=None), dt, room, n) for room, dt, n in days)
    assert rows_of(got) == want


def test_a_room_with_many_failures(spark):
    """A hundred thousand failures of one room meet its days as a row for each day and length, and days stay as they are."""
    days = spark.range(31).select(F.lit("R").alias("room"), F.date_add(F.lit(D0), F.col("id").cast("int")).alias("dt"))
    n = F.col("id")
    spans = spark.range(100_000).select(F.lit("R").alias("room"), F.date_add(F.lit(D0), (n % 31).cast("int")).alias("start"), F.date_add(F.lit(D0), (n % 31 + n % 5).cast("int")).alias("end"), n.alias("at"))
    got = latest_covering(days, spans, ["room"], "dt", "at", D0, D0 + timedelta(days=30), "best")
    out = got.collect()
    assert len(out) == 31
    want = {d: max(x for x in range(99_000, 100_000) if x % 31 <= d <= x % 31 + x % 5) for d in range(31)}
    assert {(r["dt"] - D0).days: r["best"] for r in out} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Window ") >= 1 and "partial_max" in plan


def test_known_days_join_nothing(spark):
    plan = known_ok_days(bridge.tables(spark, DATA), queries.scope())._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


# roll-ups


def tables_and_rolls(spark):
    t = bridge.tables(spark, DATA)
    return t, dayroll.day_rolls(t.events)


def test_rolls_equal_events(spark):
    t, rolls = tables_and_rolls(spark)
    s = queries.scope()
    for got, want in ((dayroll.rooms(rolls, t, s), A.rooms(t, s)), (dayroll.agents(rolls, t, s), A.agents(t, s)), (dayroll.categories(rolls, t, s, queries.PARENTS), A.categories(t, s, queries.PARENTS))):
        assert rows_of(got) == rows_of(want)
    strict = type(s)(s.since, s.until, s.corp, sla=60, filters=type(s.filters)(rooms=("R1", "R2")))
    assert rows_of(dayroll.rooms(rolls, t, strict)) == rows_of(A.rooms(t, strict))
    with pytest.raises(ValueError, match="single events"):
        dayroll.rooms(rolls, t, queries.scope(agent="A1"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_events_multiply_only_where_their_room_day_stays(spark, monkeypatch):
    t, rolls = tables_and_rolls(spark)
    plan = plan_of(rolls)
    assert "Exchange" not in plan[: plan.index("Generate")] and plan[plan.index("Generate") :].count("Exchange") == 2
    monkeypatch.setattr(dayroll, "PART", 1_000)
    many = dayroll.day_rolls(t.events)
    assert many.rdd.getNumPartitions() >= t.events.count() // 1_000
    assert sorted(map(str, many.collect())) == sorted(map(str, rolls.collect()))


def test_rolls_are_not_sorted_to_keep_known_days(spark):
    t, rolls = tables_and_rolls(spark)
    assert "ShuffledHashJoin" in plan_of(dayroll.categories(rolls, t, queries.scope(), queries.PARENTS))


def test_rolls_read_no_event(spark):
    t = bridge.tables(spark, DATA)
    rolls = bridge.rolls(spark, DATA)
    events = set(t.events.inputFiles())
    assert not events & set(dayroll.rooms(rolls, t, queries.scope()).inputFiles()) and events & set(A.rooms(t, queries.scope()).inputFiles())


def test_levels_at_once_scan_once(spark):
    t = bridge.tables(spark, DATA)
    both = A.categories_of_both_levels(t, queries.scope(), queries.LEAVES, queries.PARENTS)
    for level, groups in ((1, queries.PARENTS), (2, queries.LEAVES)):
        want = A.categories(t, queries.scope(), groups)
        assert rows_of(both.where(F.col("level") == level), *want.columns) == rows_of(want)
    assert both._jdf.queryExecution().optimizedPlan().toString().count("summary") == A.categories(t, queries.scope(), queries.LEAVES)._jdf.queryExecution().optimizedPlan().toString().count("summary")


# kept tables


@pytest.mark.parametrize("kind", ["rolls", "participations"])
def test_three_batches_equal_a_rebuild(spark, kind):
    """First all days, then days whose events are others, then days whose events are gone (their partitions go too)."""
    whole = bridge.tables(spark, DATA).events
    table = getattr(maintained, kind)(spark, f"kept_{kind}")
    keys = ["corpid", "roomid", "occurred_on"]
    states = [
        whole.where("id % 3 <> 0 or day(occurred_on) > 10"),
        whole.where("day(occurred_on) <> 5").withColumn("agents", F.when(F.col("occurred_on") == "2024-01-07", F.array(F.lit("A99"))).otherwise(F.col("agents"))),
        whole.where("day(occurred_on) not in (5, 20) and roomid <> 'R3'"),
    ]
    before = None
    for events in states:
        changed = events.select(*keys) if before is None else before.select(*keys, "id", F.size("agents").alias("n")).exceptAll(events.select(*keys, "id", F.size("agents").alias("n"))).unionByName(events.select(*keys, "id", F.size("agents").alias("n")).exceptAll(before.select(*keys, "id", F.size("agents").alias("n")))).select(*keys).union(events.where("occurred_on = '2024-01-07'").select(*keys))
        touched = table.refresh(changed.distinct(), events)
        want = table.make(events)
        assert rows_of(table.read().select(F.to_json(F.struct(*sorted(want.columns))).alias("x"))) == rows_of(want.select(F.to_json(F.struct(*sorted(want.columns))).alias("x")))
        assert before is None or len(touched) < 16 * 30
        before = events
    assert not [r for r in spark.sql(f"SHOW PARTITIONS kept_{kind}").collect() if "2024-01-05" in r[0] or "2024-01-20" in r[0]]
    assert table.refresh(changed.where("false"), events) == []
    spark.sql(f"DROP TABLE kept_{kind}")


def test_agents_read_participation(spark):
    t, kept = bridge.tables(spark, DATA), bridge.with_participation(spark, DATA)
    for s in (queries.scope(), queries.scope(responder="A3")):
        assert rows_of(A.agents(kept, s)) == rows_of(A.agents(t, s)) and rows_of(A.agent_memberships(kept, s)) == rows_of(A.agent_memberships(t, s))
    assert not set(t.events.inputFiles()) & set(A.agents(kept, queries.scope()).inputFiles())


# pages by key


@pytest.mark.parametrize("sort", sorted(detail.SORTS))
@pytest.mark.parametrize("descending", [True, False])
def test_pages_by_key_and_index(spark, sort, descending):
    t, s = bridge.tables(spark, DATA), queries.scope()
    key = detail.SORTS[sort]
    every = [(r[key], r["id"]) for r in s.rows(t).orderBy(*detail.page_order(sort, descending)).select(key, "id").collect()]
    index = detail.page_index(t, s, sort, descending, ranges=9)
    assert index.before[-1] == len(every) and len(index.cuts) >= 8
    nulls = next((k for k, x in enumerate(every) if x[0] is None), len(every))
    for size, pages in ((100, (1, 4, 10, 11)), (70, (2, max(1, nulls // 70 + 1)))):
        for page in pages:
            want = [x[1] for x in every[(page - 1) * size : page * size]]
            assert [r["id"] for r in detail.page_by_index(t, s, index, page, size).collect()] == want
    for at in (0, 99, max(0, nulls - 2), len(every) - 30):
        assert [r["id"] for r in detail.page_after(t, s, every[at], 50, sort, descending).collect()] == [x[1] for x in every[at + 1 : at + 51]]
    assert [r["id"] for r in detail.page_after(t, s, None, 20, sort, descending).collect()] == [x[1] for x in every[:20]]


def test_a_deep_page_reads_a_range(spark):
    t, s = bridge.tables(spark, DATA), queries.scope()
    index = detail.page_index(t, s, "time", ranges=16)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = detail.page_by_index(t, s, index, 7, 100)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(first_msg_time" in plan and "GreaterThanOrEqual(first_msg_time" in plan
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert detail.page_index(t, queries.scope(agent="nobody"), "time").before == [0, 0]


# user SQL


def test_functions_of_the_session(spark):
    surface.register(spark, bridge.tables(spark, DATA))
    surface.register(spark, bridge.tables(spark, DATA))
    t = lambda x: datetime.strptime(f"2026-08-{x}", "%Y-%m-%d %H:%M")
    cases = [("25 09:00", "25 10:00", 3600), ("25 07:00", "25 09:00", 1800), ("25 21:30", "25 23:00", 0), ("25 20:30", "27 09:00", 48600), ("25 10:00", "25 09:00", 0)]
    spark.createDataFrame([(t(a), t(b), n) for a, b, n in cases] + [(t("25 09:00"), None, None)], "a timestamp_ntz, b timestamp_ntz, n long").createOrReplaceTempView("spans_")
    assert all(r[0] == r[1] for r in spark.sql("SELECT work_seconds(a, b), n FROM spans_").collect())
    one = spark.sql("SELECT nearest_rank(array(struct(10L, 1L), struct(20L, 1L)), 0.5D) AS a, nearest_rank(array(), 0.5D) AS b, nearest_rank(array(struct(7L, 9L)), 0.9D) AS c, reply_bucket(60L) AS d, reply_bucket(14401L) AS e, reply_bucket(NULL) AS f").first()
    assert tuple(one) == (20, None, 7, 0, 7, None)


def test_user_sql_equals_the_engine(spark):
    t, s = bridge.tables(spark, DATA), queries.scope()
    kpi = queries.QUERIES["kpi_by_sql"](spark, DATA).first().asDict()
    want = A.summary_counts(t, s).first().asDict() | A.summary_quantiles(t, s).first().asDict()
    assert kpi == {k: want[k] for k in kpi}
    own = spark.sql("SELECT * FROM known_ok_days('C1', DATE '2024-01-01', DATE '2024-01-30')")
    assert rows_of(own) == rows_of(known_ok_days(t, s))
    by_room = spark.sql("SELECT roomid, count(*) AS events FROM trusted_events('C1', DATE '2024-01-03', DATE '2024-01-09') GROUP BY roomid")
    assert rows_of(by_room) == rows_of(A.rooms(t, type(s)(date(2024, 1, 3), date(2024, 1, 9), "C1")).select("roomid", "events"))
