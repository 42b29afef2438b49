"""One test for each trap of the blueprint (T18 is in test_sources.py, T23 in test_extraction.py), on one small set of tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parlance.functions import events as E
from parlance.functions import text as X
from parlance.functions import worktime
from parlance.functions.quantile import nearest_rank
from parlance.operators import aggregates as A
from parlance.operators import daily, detail, replies
from parlance.operators import extraction as EX
from parlance.operators import rollup as R
from parlance.operators.scope import Filters, Scope, Tables, known_ok_days
from parlance.schema import SCHEMAS
from parlance.sources import messages as M

D1, D2 = date(2026, 8, 24), date(2026, 8, 25)
DAY = "id long, corpid string, roomid string, first_msg_time timestamp_ntz, last_msg_time timestamp_ntz, first_agent_reply_time timestamp_ntz, occurred_on date, asker_role string, agents array<string>, first_responder string, summary string, last_msg_role string, followup_wait_max_sec int, event_type string, taxonomy_version string, source_messages string"


def at(day, h, m=0, s=0):
    return datetime(day.year, day.month, day.day, h, m, s)


def event(id_, room, day, reply=None, role="EXTERNAL", agents=(), label=None, summary="x", wait=None):
    first = at(day, 10)
    return (id_, "C1", room, first, first, first + timedelta(seconds=reply) if reply is not None else None, day, role, list(agents), agents[0] if reply is not None and agents else None, summary, "EXTERNAL", wait, label, "v1" if label else None, None)


@pytest.fixture(scope="module")
def t(spark):
    events = [
        event(1, "R1", D1, 10, agents=("A", "B"), label="t1", summary="Refund 50%_off"),
        event(2, "R1", D1, 1800, agents=("A",), label="t2"),
        event(3, "R1", D1, 1801, agents=("B", "B"), label="__untyped__"),
        event(4, "R1", D1),
        event(5, "R1", D2, 0, role="INTERNAL", agents=("A",), label="t1"),
        event(6, "R2", D1, 20, agents=("B",), label="t2", wait=5),  # a failure is as late as the credential
        event(7, "R3", D1, 30, agents=("C",), label="odd"),  # several failures, all earlier
    ]
    g = lambda room, day, done, msgs=1, senders=1: ("C1", room, day, msgs, senders, 1, 1, 0, None, None, "ok", "ok", None, done)
    days = [g("R1", D1, at(D2, 12), 5, 2), g("R1", D2, at(D2, 12), 7, 3), g("R2", D1, at(D2, 12)), g("R3", D1, at(D2, 12)), g("R4", D1, None)]
    f = lambda room, when, since, until, stage="extract", run=D2: (run, "C1", room, "model", stage, since, until, when)
    failures = [f("R2", at(D2, 12), D1, D1), f("R3", at(D2, 10), D1, D2), f("R3", at(D2, 11), D1, D1), f("R1", at(D2, 13), D1, D2, "classify"), f("R1", at(D2, 13), date(2026, 8, 1), date(2026, 8, 2), run=D1)]
    make = lambda rows, name: spark.createDataFrame(rows, SCHEMAS[name])
    return Tables(spark.createDataFrame(events, DAY), make(days, "group_day"), make(failures, "run_failure"), make([], "room_config"), make([], "merchant_summary"), make([("v1", "t1", "P", "N1", "d"), ("v1", "t2", "P", "N2", "d")], "taxonomy"))


def scope(**filters):
    return Scope(D1, D2, "C1", filters=Filters(**filters))


def one(df):
    return df.first().asDict()


def test_t01_null_survives_greatest(spark):
    none = F.lit(None).cast("timestamp_ntz")
    assert spark.range(1).select(worktime.between(F.lit(at(D1, 9)), none)).first()[0] is None


def test_t02_quantile_is_floor_not_ceiling(spark):
    df = spark.createDataFrame([(10,), (20,)], "v long")
    assert nearest_rank(df, [], "v").first()["p50"] == 20 and df.select(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY v)")).first()[0] == 10


def test_t03_overdue_holds_the_unreplied_and_is_strict(t):
    late = {r["id"] for r in t.events.where(E.is_overdue(1800)).collect()}
    assert late == {3, 4}


def test_t04_a_failure_as_late_as_the_credential_counts_and_several_multiply_nothing(t):
    assert sorted((r["roomid"], r["dt"]) for r in known_ok_days(t, scope()).collect()) == [("R1", D1), ("R1", D2), ("R3", D1)]


def test_t05_aggregates_know_the_boundary_details_do_not(t):
    assert A.summary_counts(t, scope()).first()["events"] == 6 and detail.event_count(t, scope()).first()["n"] == 7


def test_t06_taking_part_and_owning_are_two_things(t):
    got = {r["agent"]: (r["involved"], r["owned"]) for r in A.agents(t, scope()).collect()}
    assert got == {"A": (3, 3), "B": (2, 1), "C": (1, 1)}


def test_t07_unclassified_is_not_unlabelled(t):
    keys = {r["id"]: r["key"] for r in t.events.select("id", E.group_key([["t1"], ["t2"]]).alias("key")).collect()}
    assert keys[3] == "2" and keys[4] is None and keys[7] == "2"
    assert detail.event_count(t, scope(types_exclude=("t1",))).first()["n"] == 4  # the one without label goes too


def test_t08_t09_text_is_sought_in_any_case_and_without_wildcards(t):
    count = lambda q: detail.event_count(t, scope(q=q)).first()["n"]
    assert count("REFUND 50%_") == 1 and count("5_%") == 0 and count("%") == 1


def test_t10_white_space_of_all_scripts_and_the_end_of_a_text(spark):
    df = spark.createDataFrame([("　 a ",), ("a\n",), (" ",)], "x string")
    assert [r[0] for r in df.select(X.trimmed(F.col("x"))).collect()] == ["a", "a", ""]


def test_t11_redaction_goes_in_order_and_long_field_names_first(spark):
    df = spark.createDataFrame([("客户姓名：@李 13800138000\n客户：x",)], "x string")
    assert df.select(X.redacted(F.col("x"))).first()[0] == f"客户姓名：{X.MASK_FIELD} / 客户：{X.MASK_FIELD}"


def test_t12_nulls_come_last_both_ways(t):
    for down in (True, False):
        assert [r["followup_wait_max_sec"] for r in detail.event_page(t, scope(), 1, 50, "wait", down).collect()][0] == 5


def test_t13_events_without_agents_have_no_row(t):
    assert A.exploded(t, scope()).where("id = 4").count() == 0 and A.exploded(t, scope()).where("id = 3").count() == 1


def test_t14_a_line_without_time_is_dropped_not_its_room(spark):
    rows = [("1", "R", "C", 1_787_500_000_000), ("2", "R", "C", None)]
    raw = spark.createDataFrame([(i, room, corp, ms, ("s", "EXTERNAL", None), None, "hi", None, 1, 1, "TEXT", "202608", corp, room) for i, room, corp, ms in rows], SCHEMAS["raw_message"] + ", path_month string, path_corp string, path_room string")
    p = M.parsed(raw, date(2026, 8, 1), date(2026, 8, 31))
    assert p.count() == 2 and [r["msg_id"] for r in M.clean(p).collect()] == ["1"]
    assert [(r["reason"], r["untimed"]) for r in M.room_faults(p.withColumn("fault", F.when(F.col("msg_id") == "1", "role").otherwise(F.col("fault")))).collect()] == [("role", 1)]


def test_t15_rooms_have_every_day_or_none(spark, t):
    m = spark.createDataFrame([("1", "C1", "R1", at(D1, 9), "c", None, "EXTERNAL", "TEXT", "x", None)], "msg_id string, corp string, room string, at timestamp_ntz, sender_id string, official_user_id string, sender_role string, msg_type string, text string, reply_to string")
    none = spark.createDataFrame([], "corp string, room string")
    rows = daily.group_rows(m, t.events.limit(0), none, D1, D2).collect()
    assert sorted((r["roomid"], r["dt"], r["msg_count"]) for r in rows) == [("R1", D1, 1), ("R1", D2, 0)]


def test_t16_equal_groups_go_by_their_number_as_text(spark, t):
    groups = [[f"g{i}"] for i in range(11)]
    events = t.events.where("id in (1, 2)").withColumn("event_type", F.when(F.col("id") == 1, "g2").otherwise("g10"))
    got = A.room_top_groups(Tables(events, t.group_days, t.failures, t.room_config, t.merchants, t.taxonomy), scope(), groups, 1).first()
    assert got["key"] == "10"


def test_t17_only_replies_join_and_both_ends_must_be_in_drafts(spark):
    row = lambda i, reply: (str(i), "R", "C", at(D1, 9, i), "c", None, "EXTERNAL", "TEXT", "AB1234567890123456", reply)
    m = spark.createDataFrame([row(1, None), row(2, None), row(3, "9"), row(4, "1")], SCHEMAS["message"])
    drafts = spark.createDataFrame([("C", "R", n, [str(i)], "s", None) for n, i in enumerate((1, 2, 3, 4), 1)], EX.DRAFTS)
    assert sorted(r["msg_ids"] for r in replies.joined_by_replies(drafts, m).collect()) == [["1", "4"], ["2"], ["3"]]


def test_t19_no_rate_of_nothing(spark):
    assert spark.range(1).select(E.rate(F.lit(0), F.lit(0))).first()[0] is None


def test_t20_sums_of_nothing_are_zero_and_quantiles_null(t):
    got = one(A.kpi_document(t, scope(agent="nobody")))
    assert (got["events"], got["overdue"], got["agents"], got["p50"], got["unreplied_rate"]) == (0, 0, 0, None, None)


def test_t21_senders_by_maximum_in_rooms_and_by_sum_over_days(t):
    room = one(R.room_rollup(t, scope()).where("roomid = 'R1'"))
    assert (room["msgs"], room["senders"]) == (12, 3)
    assert {r["dt"]: r["sender_visits"] for r in R.message_rollup(t, scope()).collect()} == {D1: 5, D2: 3}


def test_t22_failures_count_by_the_days_of_their_data(t):
    rooms = {r["roomid"] for r in detail.room_options(t, Scope(date(2026, 8, 1), date(2026, 8, 3), "C1")).collect()}
    assert rooms == {"R1"}  # run on the 24th, for days of the window
