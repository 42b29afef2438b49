"""Segments, alignment, assembly, messages, labels, store and tail, on small inputs."""

from __future__ import annotations

import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parlance.operators import daily, detail, labels, replies, scope
from parlance.operators import extraction as X
from parlance.plans import batch
from parlance.plans.store import Answers, Store
from parlance.plans.window import Window, bucket_edges, groups, period, rotated, stride
from parlance.schema import SCHEMAS, schema_faults
from parlance.sources import messages as M
from parlance.sources import taxonomy

T0 = datetime(2026, 8, 24, 9)


def messages(spark, rows):
    """rows: room, id, seconds after T0, sender, role, reply_to"""
    return spark.createDataFrame([(i, r, "C", T0 + timedelta(seconds=s), who, None, role, "TEXT", f"text {i}", reply) for r, i, s, who, role, reply in rows], SCHEMAS["message"])


@pytest.mark.parametrize("most", [1, 7, 500, 10**6])
def test_segments_are_a_partition_cut_at_long_silences(spark, most):
    rng = random.Random(5)
    at = {n: sorted(rng.randrange(10**6) for _ in range(n)) for n in (1, 2, 167, 823)}
    m = messages(spark, [(f"R{n}", f"{i:04}", s, "c", "EXTERNAL", None) for n, times in at.items() for i, s in enumerate(times)])
    got = {}
    for r in X.segmented(m, most).orderBy("room", "i").collect():
        got.setdefault(int(r["room"][1:]), []).append((r["i"], r["segment"]))
    for n, times in at.items():
        assert [i for i, _ in got[n]] == list(range(n))
        k = -(-n // most)
        begins = [i for (i, s), (_, t) in zip(got[n][1:], got[n], strict=False) if s != t]
        assert [s for _, s in got[n]] == sorted(s for _, s in got[n]) and len(begins) == k - 1
        for j, i in enumerate(begins, 1):
            reach = max(1, n // k // 20) if n // k >= 3 else 0
            assert i == max(range(n * j // k - reach, n * j // k + reach + 1), key=lambda p: (times[p] - times[p - 1], -p))


def line(i, sec, reply=None, who="c", role="EXTERNAL", body="x"):
    return X.Line(i, str(i), T0 + timedelta(seconds=sec), who, role, body, None, reply, None if reply is None else "quoted")


def test_halves_part_at_the_longest_silence_and_the_first_of_equal_ones():
    parts = lambda minutes: [len(x) for x in X.halves([line(i, 60 * m) for i, m in enumerate(minutes)])]
    assert parts((0, 1, 2, 9, 10, 11)) == [3, 3] and parts((0, 0, 0, 0, 0, 0)) == [2, 4] and parts((0, 5)) == [1, 1]


def test_events_join_by_replies_alone(spark):
    m = messages(spark, [("R", str(i), i, "c", "EXTERNAL", r) for i, r in ((0, None), (1, "0"), (2, None), (3, None), (4, "99"))] + [("S", "0", 0, "c", "EXTERNAL", None), ("S", "1", 1, "c", "EXTERNAL", "0")])
    draft = lambda room, n, ids, summary: ("C", room, n, ids, summary, None)
    rows = [draft("R", 1, ["1"], "two"), draft("R", 2, ["0"], "one"), draft("R", 3, ["2", "3"], "three"), draft("R", 4, ["4"], "four"), draft("S", 1, ["0", "1"], "own"), ("C", "T", None, None, None, "gone")]
    got = replies.joined_by_replies(spark.createDataFrame(rows, X.DRAFTS), m).collect()
    assert sorted((r["room"], r["event_no"] or 0, r["msg_ids"], r["summary"], r["error"]) for r in got) == [("R", 2, ["0", "1"], "one", None), ("R", 3, ["2", "3"], "three", None), ("R", 4, ["4"], "four", None), ("S", 1, ["0", "1"], "own", None), ("T", 0, None, None, "gone")]
    assert replies.joined_by_replies(spark.createDataFrame([], X.DRAFTS), m).count() == 0


def test_a_reply_to_a_message_of_a_later_segment_is_kept(spark):
    # clocks go back: 1 answers 9, which comes later, in another segment
    m = messages(spark, [("R", str(i), i * 60, "c", "EXTERNAL", "9" if i == 1 else None) for i in range(10)])
    got = X.extract(m, X.by_reply_chain, 4).select("msg_ids", "error").collect()
    assert all(r["error"] is None for r in got)
    assert sorted(r["msg_ids"] for r in got) == [["0"], ["1", "9"], *[[str(i)] for i in range(2, 9)]]


def test_long_chains_and_hubs_are_one(spark):
    """A chain of a hundred thousand, a star, and some random edges, against union and find."""
    n = F.col("id")
    chain = spark.range(100_000).select((n * 7919 % 100_003).alias("a"), ((n + 1) * 7919 % 100_003).alias("b"))
    rng = random.Random(3)
    odd = [(200_000 + rng.randrange(400), 200_000 + rng.randrange(400)) for _ in range(230)] + [(300_000, 300_001 + i) for i in range(500)]
    got = {r["node"]: r["root"] for r in replies.connected(chain.unionByName(spark.createDataFrame(odd, "a long, b long"))).collect()}
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for a, b in [(i * 7919 % 100_003, (i + 1) * 7919 % 100_003) for i in range(100_000)] + odd:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    loops = {a for a, b in odd if a == b} - {x for a, b in odd if a != b for x in (a, b)}
    assert got == {x: find(x) for x in top if x not in loops}


def test_views_name_senders_notes_and_replies():
    room, first = X.Room(), [line(0, 0, body="hello"), line(1, 60, reply=0, who="A", role="INTERNAL", body="yes"), line(2, 70, who="d")]
    room.hear(first)
    text, refs = room.view(first, 10)
    assert text.split("\n") == ["#1 [09:00:00] 商家A: hello", "#2 [09:01:00] 平台A ↩回复 #1: yes", "#3 [09:01:10] 商家B: x"] and refs == set()
    room.add(first, [([1, 2], "greeting", True, None), ([3], "done", False, None)])
    second = [line(3, 90, reply=1), line(4, 95, reply=2)]
    room.hear(second)
    text, refs = room.view(second, 10)
    assert refs == {1, 2} and "E1: greeting ← 上次说到「yes」" in text and "E2: done（已了结） ← " in text and "#1 [09:01:30] 商家A ↩回复 E1: x" in text
    text, refs = room.view(second, 0)  # only what is open and replied to is still worth a note
    assert refs == {1} and "#2 [09:01:35] 商家A ↩回复 「quoted」: x" in text


def test_a_segment_that_is_too_big_is_halved():
    calls = []

    def model(text, n):
        calls.append(n)
        if n > 3:
            raise X.TooBig if n > 5 else TimeoutError
        return [X.Found([i], f"line {i}") for i in range(1, n + 1)]

    room, lines = X.Room(), [line(i, 0) for i in range(10)]
    room.hear(lines)
    X.ask(room, lines, model, 100)
    assert sorted(i for d in room.drafts.values() for i in d.lines) == list(range(10)) and max(calls) == 10
    with pytest.raises(ValueError, match="phone"):
        X.ask(room, lines, lambda t, n: [X.Found([1], "call 18472625055")], 100)


def test_a_lost_connection_fails_its_room_alone(spark):
    m = messages(spark, [("R", "1", 0, "c", "EXTERNAL", None), ("S", "2", 0, "lost", "EXTERNAL", None)]).withColumn("text", F.col("sender_id"))

    def model(text, n):
        if "lost" in text:
            raise ConnectionError("gone")
        return [X.Found([1], "fine", ref=None)]

    assert {(r["room"], r["summary"], r["error"]) for r in X.extract(m, model).collect()} == {("R", "fine", None), ("S", None, "gone")}
    assert {(r["room"], r["segment"], r["view"]) for r in X.preview(m).collect()} == {("R", 0, "#1 [09:00:00] 商家A: c"), ("S", 0, "#1 [09:00:00] 商家A: lost")}


def test_assembly_and_followup_wait(spark):
    m = messages(spark, [("R", "1", 0, "c", "EXTERNAL", None), ("R", "2", 60, "B", "INTERNAL", "1"), ("R", "3", 100, "c", "EXTERNAL", None), ("R", "4", 130, "c", "EXTERNAL", None), ("R", "5", 2500, "A", "INTERNAL", None), ("R", "6", 2600, "c", "EXTERNAL", None), ("R", "7", 3000, "d", "EXTERNAL", None)])
    drafts = spark.createDataFrame([("C", "R", 1, ["1", "2", "3", "4", "5", "6"], "s", None), ("C", "R", 2, ["7"], "t", None)], X.DRAFTS)
    got = {r["summary"]: r for r in X.assemble(drafts, m).collect()}
    s, t = got["s"], got["t"]
    assert (s["agents"], s["first_responder"], s["first_agent_reply_time"], s["followup_wait_max_sec"], s["last_msg_role"]) == (["B", "A"], "B", T0 + timedelta(seconds=60), 2400, "EXTERNAL")
    assert (t["agents"], t["first_responder"], t["first_agent_reply_time"], t["followup_wait_max_sec"]) == ([], None, None, 0)
    assert s["source_msg_ids"] == ["1", "2", "3", "4", "5", "6"] and s["source_messages"][0]["at"] == "2026-08-24 09:00:00"


def raw_lines(rows):
    ms = lambda s: int((T0 - datetime(1970, 1, 1)).total_seconds() + s) * 1000 - M.LOCAL
    return "".join(json.dumps({"sourceMessageId": i, "officialRoomId": room, "corpId": "C", "messageTime": None if s is None else ms(s), "sender": {"easyUserId": who, "identityType": role, "officialUserId": f"acc-{who}"}, "analysisText": "", "content": f"text {i}", "schemaVersion": 1, "parserVersion": 1, "standardType": "TEXT"} | ({"semanticPayload": {"replyTo": {"sourceMessageId": reply}}} if reply else {})) + "\n" for room, i, s, who, role, reply in rows)


@pytest.fixture
def raw(tmp_path):
    d = tmp_path / "raw" / "202608" / "C"
    d.mkdir(parents=True)
    (d / "R1.ndjson").write_text(raw_lines([("R1", "1", 0, "c", "EXTERNAL", None), ("R1", "2", 60, "A", "INTERNAL", "1"), ("R1", "2", 90, "A", "INTERNAL", "1"), ("R1", "x", None, "c", "EXTERNAL", None)]))
    (d / "R2.ndjson").write_text(raw_lines([("R2", "3", 0, "c", "SOMEONE", None)]))
    return d


W = Window(date(2026, 8, 24), date(2026, 8, 26))


def test_guards(spark, raw):
    p = M.parsed(M.read_raw(spark, [str(raw / "R1.ndjson"), str(raw / "R2.ndjson")]), W.since, W.until)
    assert {(r["room"], r["reason"]) for r in M.room_faults(p).collect()} == {("R2", "role")}
    assert [(r["msg_id"], r["at"], r["official_user_id"]) for r in M.clean(p).orderBy("msg_id").collect()] == [("1", T0, None), ("2", T0 + timedelta(seconds=60), "acc-A")]
    assert {r["reason"] for r in M.room_faults(p, 3).collect()} == {"role", "size"}
    assert M.months(date(2025, 12, 31), date(2026, 2, 1)) == ["202512", "202601", "202602"]


def test_a_run_twice_gives_the_same_and_failures_leave_facts_alone(spark, raw, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    p = M.parsed(M.read_raw(spark, [str(raw / "R1.ndjson"), str(raw / "R2.ndjson")]), W.since, W.until)
    run = lambda model: batch.run_facts(store, p, model, date(2026, 8, 28), W)
    assert run(X.by_reply_chain) == batch.Tally(1, 1)
    one = sorted(map(str, store.read("event").collect()))
    assert len(one) == 1 and store.read("group_day").count() == 3
    run(X.by_reply_chain)
    assert sorted(map(str, store.read("event").collect())) == one
    assert {(r["roomid"], r["reason"]) for r in store.read("run_failure").collect()} == {("R2", "role")}

    def broken(text, n):
        raise ValueError("no answer")

    assert run(broken) == batch.Tally(0, 2)
    assert sorted(map(str, store.read("event").collect())) == one
    assert {r["extraction_status"] for r in store.read("group_day").collect()} == {"failed"}
    run(X.by_reply_chain)

    cache = spark.createDataFrame([], "digest string, event_type string")
    classify = lambda texts, types: [(i, types[0]) for i in range(len(texts))]
    cache, tally = batch.run_labels(store, cache, classify, ["t0", "t1"], "v1", W, date(2026, 8, 28))
    assert tally == batch.Tally(3, 0) and {r["event_type"] for r in store.read("event").collect()} == {"t0"}
    assert [(r["agent"], r["event_type"], r["event_count"], r["official_user_id"]) for r in store.read("agent_day").collect()] == [("A", "t0", 1, "acc-A")]
    before = store.stamp()
    batch.run_labels(store, cache, lambda t, k: [(i, k[1]) for i in range(len(t))], ["t0", "t1"], "v1", W, date(2026, 8, 28))
    assert store.stamp() == before and cache.count() == 1

    answers, made = Answers(store), []
    get = lambda: answers.get("n", lambda: (made.append(1), store.read("event").groupBy().count())[1]).first()[0]
    assert (get(), get(), len(made)) == (1, 1, 1)
    run(broken)
    assert (get(), len(made)) == (1, 2)
    rooms = spark.createDataFrame([("C", "R1")], "corpid string, roomid string")
    with pytest.raises(ValueError, match="outside"):
        store.replace_shards("agent_msg_day", spark.createDataFrame([("C", "R1", "A", date(2026, 1, 1), 1)], SCHEMAS["agent_msg_day"]), rooms, W)


def test_group_rows_know_null_from_zero(spark):
    m = messages(spark, [("R", "1", 0, "c", "EXTERNAL", None), ("S", "2", 0, "c", "EXTERNAL", None)])
    events = X.assemble(spark.createDataFrame([("C", "R", 1, ["1"], "s", None)], X.DRAFTS), m)
    failed = spark.createDataFrame([("C", "S")], "corp string, room string")
    got = {(r["roomid"], r["dt"].day): (r["msg_count"], r["event_count"], r["unreplied_count"], r["first_reply_p50_sec"]) for r in daily.group_rows(m, events, failed, W.since, W.until).collect()}
    assert got == {("R", 24): (1, 1, 1, None), ("R", 25): (0, 0, 0, None), ("R", 26): (0, 0, 0, None), ("S", 24): (1, None, None, None), ("S", 25): (0, None, None, None), ("S", 26): (0, None, None, None)}


def test_labels(spark):
    with pytest.raises(ValueError):
        labels.checked([(0, "a"), (0, "b")], 2, ["a", "b"])
    with pytest.raises(ValueError):
        labels.checked([(0, "zz")], 1, ["a"])
    assert labels.checked([(1, "a"), (0, labels.UNTYPED)], 2, ["a"]) == [labels.UNTYPED, "a"]
    s = spark.createDataFrame([("x",), ("x",), ("y",)], "summary string")
    none = spark.createDataFrame([], "digest string, event_type string")
    found = labels.answers(s, none, lambda t, k: [(i, "a") for i in range(len(t))], ["a"], "v1")
    cache = labels.first_answers(none, found)
    assert cache.count() == 2
    again = labels.first_answers(cache, spark.createDataFrame([(r["digest"], "b") for r in cache.collect()], "digest string, event_type string"))
    assert {r["event_type"] for r in again.collect()} == {"a"}
    assert {r["event_type"] for r in labels.answers(s, none, None, [], "v0").collect()} == {labels.UNTYPED}


def test_vocabularies(spark):
    good = 'version = "v1"\n[[types]]\ntype_id = "a"\nparent_name = "P"\nname = "N"\ndescription = "D"\n'
    assert taxonomy.draft(spark, good).count() == 1
    with pytest.raises(ValueError, match="A: id.*A: name joins"):
        taxonomy.draft(spark, good.replace('"a"', '"A"').replace('"N"', '"N/M"'))


def test_windows():
    d = date.fromisoformat
    for run, n, a, b in [("2026-09-07", 2, "2026-09-04", "2026-09-05"), ("2026-09-07", 1, "2026-09-05", "2026-09-05"), ("2026-09-01", 2, "2026-08-29", "2026-08-30"), ("2026-01-01", 2, "2025-12-29", "2025-12-30"), ("2024-03-02", 2, "2024-02-28", "2024-02-29")]:
        assert Window.daily(d(run), n) == Window(d(a), d(b))
    with pytest.raises(ValueError):
        Window(d("2026-09-06"), d("2026-09-06")).check(d("2026-09-07"))
    assert period(None, None, d("2026-09-01"), d("2026-09-04")) == Window(d("2026-09-01"), d("2026-09-04"))
    for bad in (("2026-9-1", None), ("2026-09-05", "2026-09-01"), ("2026-01-01", "2026-03-01")):
        with pytest.raises(ValueError):
            period(*bad, d("2026-01-01"), d("2026-12-31"))
    assert bucket_edges(" ", (1,)) == (1,) and bucket_edges("1,2", ()) == (1, 2) and groups("a|b,c") == [["a", "b"], ["c"]]
    for bad in ("2,1", "1,1", "-1,2"):
        with pytest.raises(ValueError):
            bucket_edges(bad, ())
    with pytest.raises(ValueError):
        groups("a,,b")
    assert sorted(rotated(i, 10, 3) for i in range(10)) == list(range(10)) and stride(10) == 7


def test_schema_faults(spark):
    assert schema_faults(spark.createDataFrame([], "version string, type_id int"), "taxonomy") == ["type_id: int instead of string", "parent_name: missing", "name: missing", "description: missing"]


def test_tail_reads_what_was_added(spark, tmp_path):
    from parlance.streaming import tail

    d = tmp_path / "202608" / "C"
    d.mkdir(parents=True)
    f = d / "R1.ndjson"
    rows = [("R1", str(i), i, "c", "EXTERNAL", None) for i in range(5)]
    run = lambda: tail.raw_messages(spark, str(d / "*.ndjson")).select("sourceMessageId", "path_room").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    f.write_text(raw_lines(rows[:2]) + '{"half": ')
    run()
    seen = lambda: sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert seen() == ["0", "1"]
    f.write_text(raw_lines(rows))
    run()
    assert seen() == ["0", "1", "2", "3", "4"]
    assert tail.resumable(5, b"\n", 9) == 5 and tail.resumable(5, b"x", 9) == 0 and tail.resumable(9, b"\n", 5) == 0


def test_rewrites_are_logged_below_the_freeze_line(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    for k in range(3):
        assert store.record_rewrite(date(2026, 8, k + 1), W, date(2030, 1, 1), None)
        assert store.read("rewrite_log").count() == k + 1
    assert not store.record_rewrite(date(2026, 8, 9), W, W.since, None) and store.read("rewrite_log").count() == 3


def agent_days(spark, rows):
    return spark.createDataFrame([("C", r, "A", date(2026, 8, d), n) for r, d, n in rows], SCHEMAS["agent_msg_day"])


def test_writes_touch_their_days_alone_and_empty_days_go(spark, tmp_path):
    """T23: Spark's dynamic overwrite leaves a day alone that has no rows any more."""
    store = Store(spark, f"file://{tmp_path}/store")
    rooms = lambda *names: spark.createDataFrame([("C", r) for r in names], "corpid string, roomid string")
    store.replace_shards("agent_msg_day", agent_days(spark, [("R", 24, 1), ("R", 25, 2), ("S", 25, 3)]), rooms("R", "S"), W)
    files = lambda d: sorted((p.name, p.stat().st_mtime_ns) for p in (tmp_path / f"store/agent_msg_day/dt=2026-08-{d}").iterdir())
    before = files(24), files(25)
    day = Window(date(2026, 8, 25), date(2026, 8, 25))
    store.replace_shards("agent_msg_day", agent_days(spark, [("R", 25, 9)]), rooms("R"), day)
    assert files(24) == before[0] and files(25) != before[1]
    seen = lambda: sorted((r["room"], r["dt"].day, r["msg_count"]) for r in store.read("agent_msg_day").collect())
    assert seen() == [("R", 24, 1), ("R", 25, 9), ("S", 25, 3)]
    store.replace_shards("agent_msg_day", agent_days(spark, []), rooms("R"), Window(date(2026, 8, 24), date(2026, 8, 24)))
    assert seen() == [("R", 25, 9), ("S", 25, 3)] and store.days("agent_msg_day") == [date(2026, 8, 25)]


def dies_at(monkeypatch, name):
    """From now on a write of the table ends the run."""
    whole = Store.write_days

    def write(self, table, *args):
        if table == name:
            raise RuntimeError("died")
        whole(self, table, *args)

    monkeypatch.setattr(Store, "write_days", write)


def tables_of(store):
    return scope.Tables(*[store.read(x) for x in ("event", "group_day", "run_failure", "room_config", "merchant_summary", "taxonomy")])


@pytest.mark.parametrize("table", ["event", "agent_msg_day", "agent_day"])
def test_a_run_of_facts_that_dies_publishes_none(spark, raw, tmp_path, monkeypatch, table):
    store = Store(spark, f"file://{tmp_path}/store")
    p = M.parsed(M.read_raw(spark, [str(raw / "R1.ndjson")]), W.since, W.until)
    run = lambda: batch.run_facts(store, p, X.by_reply_chain, date(2026, 8, 28), W)
    known = lambda: scope.known_ok_days(tables_of(store), scope.Scope(W.since, W.until, "C")).count()
    run()
    assert known() == 3
    with monkeypatch.context() as m:
        dies_at(m, table)
        with pytest.raises(RuntimeError, match="died"):
            run()
    assert known() == 0 and store.read("group_day").count() == 3
    run()
    assert known() == 3 and store.read("event").count() == 1


@pytest.mark.parametrize("table", ["event", "agent_day"])
def test_a_run_of_labels_that_dies_publishes_none(spark, raw, tmp_path, monkeypatch, table):
    store = Store(spark, f"file://{tmp_path}/store")
    p = M.parsed(M.read_raw(spark, [str(raw / "R1.ndjson")]), W.since, W.until)
    batch.run_facts(store, p, X.by_reply_chain, date(2026, 8, 28), W)
    cache = spark.createDataFrame([], "digest string, event_type string")
    label = lambda: batch.run_labels(store, cache, lambda t, k: [(i, k[0]) for i in range(len(t))], ["t0"], "v1", W, date(2026, 8, 28))
    states = lambda: {r["classification_status"] for r in store.read("group_day").collect()}
    with monkeypatch.context() as m:
        dies_at(m, table)
        with pytest.raises(RuntimeError, match="died"):
            label()
    assert states() == {"pending"}
    _, tally = label()
    assert tally == batch.Tally(3, 0) and states() == {"ok"} and store.read("agent_day").count() == 1


def test_retry_and_recover(spark, raw, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    run_date, types = date(2026, 8, 28), ["t0", "t1"]
    parsed = lambda w, rooms=None: M.parsed(M.read_raw(spark, [str(raw / "R1.ndjson")]), w.since, w.until)
    cache = spark.createDataFrame([], "digest string, event_type string")

    def lost(text, n):
        raise ConnectionError("gone")

    assert batch.run_facts(store, parsed(W), lost, run_date, W) == batch.Tally(0, 1)
    args = (parsed, X.by_reply_chain, cache, lambda t, k: [(i, "odd") for i in range(len(t))], types, "v1", date(2026, 8, 1), run_date, date(2026, 8, 25))
    _, plan = batch.retry(store, *args, dry_run=True)
    assert (plan.plan, plan.frozen, plan.legacy, plan.ok) == ({W: ["R1"]}, [W], 0, 0) and store.read("event").count() == 0
    _, done = batch.retry(store, *args)  # facts are repaired, but the classifier gives labels that don't exist
    assert (done.ok, done.failed) == (0, 2) and store.read("event").count() == 1 and store.read("rewrite_log").count() == 1
    states = lambda: {r["dt"].day: r["classification_status"] for r in store.read("group_day").collect()}
    assert states() == {24: "failed", 25: "ok", 26: "ok"}
    assert batch.windows_to_retry(detail.unrepaired_failures(scope.Tables(*[store.read(x) for x in ("event", "group_day", "run_failure", "room_config", "merchant_summary", "taxonomy")]), date(2026, 8, 1))[0]) == {}
    cache, tally = batch.recover(store, cache, lambda t, k: [(i, "t1") for i in range(len(t))], types, "v1", W, run_date)
    assert tally == batch.Tally(1, 0) and states() == {24: "ok", 25: "ok", 26: "ok"} and store.read("agent_day").first()["event_type"] == "t1"
    assert batch.projected_hours(7200, 2, 10, 5) == 2 and batch.projected_hours(1, 0, 1, 1) is None
    with pytest.raises(ValueError):
        batch.relabel(store, cache, None, types, "v0", W, run_date)
    cache, tally = batch.relabel(store, cache.limit(0), lambda t, k: [(i, "t0") for i in range(len(t))], types, "v2", W, run_date)
    assert tally.good and {(r["event_type"], r["taxonomy_version"]) for r in store.read("event").collect()} == {("t0", "v2")}

    t = scope.Tables(*[store.read(x) for x in ("event", "group_day", "run_failure", "room_config", "merchant_summary", "taxonomy")])
    (e,) = store.read("event").collect()
    assert [(r["msg_id"], r["lost"]) for r in detail.thread(t, "C", e["id"]).collect()] == [("1", 0), ("2", 0)]
    assert store.oldest_text(W.since, W.until) == W.since
    store.prune_texts(W.since, W.until)
    assert store.oldest_text(W.since, W.until) is None and detail.source_messages(t, "C", e["id"]).first()["source_messages"] is not None
    assert detail.checked_bytes(store.read("event").select("id"), 100).count() == 1
    with pytest.raises(ValueError, match="bytes"):
        detail.checked_bytes(store.read("event"), 100)


def test_a_failed_spark_job_is_one_windows_failure(spark, raw, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    run_date, cache = date(2026, 8, 28), spark.createDataFrame([], "digest string, event_type string")
    rooms = spark.createDataFrame([("C", "R1", "model")], "corpid string, roomid string, reason string")
    other = Window(date(2026, 8, 20), date(2026, 8, 21))
    for w in (other, W):
        store.record_failures(rooms, "extract", run_date, w)

    def parsed(w, rooms=None):
        p = M.parsed(M.read_raw(spark, [str(raw / "R1.ndjson")]), w.since, w.until)
        return p if w == W else p.unionByName(p.limit(0).union(spark.range(1).select(*[(F.raise_error(F.lit("disk")) if f.name == "msg_id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in p.schema.fields])))

    _, done = batch.retry(store, parsed, X.by_reply_chain, cache, lambda t, k: [(i, k[0]) for i in range(len(t))], ["t0"], "v1", date(2026, 8, 1), run_date, date(2026, 8, 1))
    assert list(done.plan) == [other, W] and (done.ok, done.failed) == (1, 1) and store.read("event").count() == 1


def test_months_on_disk(spark, raw, tmp_path):
    files = M.rooms_of(spark, f"{tmp_path}/raw", W.since, W.until)
    assert sorted(map(tuple, files.collect())) == [("202608", "C", "R1"), ("202608", "C", "R2")]
    index = spark.createDataFrame([("C", r, "202608", "k", 1, 1, None, 0, gone) for r, gone in (("R1", 0), ("R3", 0), ("R4", 1))], SCHEMAS["month_index"])
    assert [tuple(r) for r in M.unconfirmed(index, files, W.since, W.until).collect()] == [("202608", "C", "R3")]
    assert {r["official_room_id"] for r in M.picked(M.month_files(index, W.since, W.until), ["R1"]).collect()} == {"R1"}
    with pytest.raises(ValueError):
        M.picked(M.month_files(index, W.since, W.until), ["R9"])
    assert M.whole_rooms(M.month_files(index, W.since, W.until), spark.createDataFrame([("C", "R3")], "corp_id string, official_room_id string")).count() == 1
    assert M.prune_months(spark, f"{tmp_path}/raw", date(2026, 10, 1), 3) == [] and M.prune_months(spark, f"{tmp_path}/raw", date(2026, 10, 1), 1) == ["202608"]
    assert not (tmp_path / "raw" / "202608").exists()


def test_vocabulary_versions_are_never_changed(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    df = taxonomy.draft(spark, 'version = "v1"\n[[types]]\ntype_id = "a"\nparent_name = "P"\nname = "N"\ndescription = "D"\n')
    taxonomy.publish(store, df)
    with pytest.raises(ValueError, match="published already"):
        taxonomy.publish(store, df)
    assert taxonomy.published(store.read("taxonomy"), "v1").count() == 1


def test_review_tells_what_fits_nowhere_and_what_has_no_events(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 3), ("c", 2)], "summary string, n bigint")
    cache = counts.select(F.sha2("summary", 256).alias("digest"), F.when(F.col("summary") == "a", "t0").otherwise(labels.UNTYPED).alias("event_type"))
    got = {r["event_type"]: r for r in labels.review(counts, cache, 1, 40, spark.createDataFrame([("t0",), ("t1",)], "type_id string")).collect()}
    assert {k: (r["events"], r["phrases"], r["share"], [x["summary"] for x in r["samples"]]) for k, r in got.items()} == {"t0": (5, 1, 0.5, ["a"]), "t1": (0, 0, 0.0, []), labels.UNTYPED: (5, 2, 0.5, ["b", "c"])}


def test_streams_take_messages_once_and_count_hours(spark, tmp_path):
    from parlance.streaming import tail

    rows = [("R", "1", 0, "c", "EXTERNAL", None), ("R", "1", 0, "c", "EXTERNAL", None), ("R", "2", 4000, "c", "EXTERNAL", None)]
    messages(spark, rows).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMAS["message"]).parquet(str(tmp_path / "in"))
    for name, out, mode in (("once", tail.once(stream), "append"), ("hours", tail.hourly_counts(stream), "complete")):
        out.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["msg_id"] for r in spark.table("once").collect()) == ["1", "2"]
    assert sorted((r["room"], r["n"]) for r in spark.table("hours").collect()) == [("R", 1), ("R", 2)]
