"""Files on disk, saved answers, vocabularies and small parameters."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from parlance.operators import labels, rollup
from parlance.operators.scope import Filters
from parlance.plans import maintained, window
from parlance.schema import SCHEMAS
from parlance.sources import landing, taxonomy
from parlance.sources import messages as M

LINE = '{"sourceMessageId":"1","officialRoomId":"R1"}\n'
SINCE, UNTIL = date(2026, 7, 30), date(2026, 8, 2)


@pytest.fixture
def root(tmp_path):
    for month, room, text in (("202607", "R1", LINE * 2), ("202608", "R1", LINE), ("202608", "R2", LINE[:-1]), ("202608", "R3", "x\n"), ("202608", "R4", LINE * 3), ("202608", "R5", LINE + "é"), ("202608", "R6", "")):
        d = tmp_path / month / "C"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"{room}.ndjson").write_text(text)
    return str(tmp_path)


def test_one_room_strict_and_tolerant(spark, root):
    assert M.read_room(spark, root, "C", "R1", SINCE, UNTIL).count() == 3
    assert M.read_room(spark, root, "C", "R2", SINCE, UNTIL, strict=False).count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        M.read_room(spark, root, "C", "R2", SINCE, UNTIL).count()
    none = M.read_room(spark, root, "C", "R9", SINCE, UNTIL, strict=False)
    assert none.count() == 0 and M.parsed(none, SINCE, UNTIL).count() == 0


def test_a_damaged_file_stops_its_room_alone(spark, root):
    n = len(LINE)
    rows = [("R1", "202607", 2 * n, 2), ("R1", "202608", n, 1), ("R2", "202608", n - 1, 1), ("R3", "202608", 2, 1), ("R4", "202608", 3 * n, 2), ("R5", "202608", n, 1), ("R6", "202608", 0, 0), ("R7", "202608", n, 1)]
    index = spark.createDataFrame([("C", r, m, "k", size, lines, datetime(2026, 8, 1), 0, 0) for r, m, size, lines in rows], SCHEMAS["month_index"])
    faults = M.audited(spark, root, index, SINCE, UNTIL)
    assert {(r["official_room_id"], r["fault"]) for r in faults.collect()} == {("R2", "lines"), ("R3", "lines"), ("R4", "records"), ("R5", "length"), ("R7", "missing")}
    assert {r["official_room_id"] for r in M.whole_rooms(M.month_files(index, SINCE, UNTIL), faults).collect()} == {"R1", "R6"}


def test_t18_answers_are_keyed_by_what_gave_them(spark):
    key = labels.fingerprint("v1", "prompt", {"model": "m", "temperature": 0})
    assert key == labels.fingerprint("v1", "prompt", {"temperature": 0, "model": "m"})
    assert len({key, labels.fingerprint("v2", "prompt", {"model": "m", "temperature": 0}), labels.fingerprint("v1", "other", {"model": "m", "temperature": 0}), labels.fingerprint("v1", "prompt", {"model": "m", "temperature": 1})}) == 4
    cache = spark.createDataFrame([(key, "a", "t0"), (key, "b", labels.UNTYPED), ("other", "c", "gone")], "made_by string, digest string, event_type string")
    assert {tuple(r) for r in labels.usable(cache, key, ["t0"]).collect()} == {("a", "t0"), ("b", labels.UNTYPED)}
    with pytest.raises(ValueError, match="isn't a label"):
        labels.usable(cache, key, ["t1"])


def test_vocabulary_as_a_prompt_and_by_version(spark):
    types = [("b", "P1", "B", "bee"), ("c", "P0", "C", "sea"), ("a", "P1", "A", "ay")]
    assert labels.prompt(types) == "## P0\n- c C: sea\n## P1\n- a A: ay\n- b B: bee"
    rows = spark.createDataFrame([("v1", *t) for t in types] + [("v2", *types[0])], SCHEMAS["taxonomy"])
    assert [r["type_id"] for r in taxonomy.published(rows, "v1").collect()] == ["a", "b", "c"] and taxonomy.published(rows, "v3").count() == 0


def test_parameters():
    assert Filters.listed(" a, ,b ,") == ["a", "b"] and Filters.listed(None) == []
    assert not Filters(agent="A").narrows_rooms and Filters(rooms=("R",)).narrows_rooms and Filters(merchant_group="G").narrows_rooms and Filters(manager_id=0).narrows_rooms
    assert window.sla_seconds(None) == 1_800 and window.sla_seconds(60) == 60 and window.sla_seconds(10**9) == window.MOST_SLA
    late = window.lag_note(date(2026, 8, 1), date(2026, 8, 1 + window.HOLD_BACK)), window.lag_note(date(2026, 8, 1), date(2026, 8, 2 + window.HOLD_BACK))
    assert [x[1] for x in late] == [False, True] and "2026-08-01" in late[0][0]


def test_coverage_as_text(spark):
    columns = ["failed_days", "missing_days", "unknown_days", "pending_labels", "failed_labels"]
    df = spark.createDataFrame([(0, 0, 0, 0, 0), (2, 0, 1, 0, 3)], ", ".join(f"{c} long" for c in columns))
    assert [r[0] for r in df.select(rollup.coverage_label()).collect()] == ["complete", "2 failed, 1 unknown, 3 labels failed"]


def test_landed_tables_are_made_once(spark):
    made = []
    make = lambda: (made.append(1), spark.range(3))[1]
    name = f"test/{datetime.now().timestamp()}"
    assert landing.landed(spark, name, make).count() == landing.landed(spark, name, make).count() == 3 and len(made) == 1

    def broken():
        raise RuntimeError("no table")

    with pytest.raises(RuntimeError):
        landing.landed(spark, name + "b", broken)
    assert landing.landed(spark, name + "b", make).count() == 3 and landing.kept(spark.range(5)).count() == 5


def test_statistics_of_kept_tables(spark):
    t = maintained.Derived(spark, "kept_small", lambda e: e.groupBy("corpid", "roomid", "occurred_on").agg(F.count("*").alias("n")))
    events = spark.createDataFrame([("C", f"R{i % 3}", date(2026, 8, 1 + i % 2)) for i in range(9)], "corpid string, roomid string, occurred_on date")
    t.refresh(events.distinct(), events)
    t.analyze()
    stats = [r["data_type"] for r in spark.sql("DESCRIBE EXTENDED kept_small").collect() if r["col_name"] == "Statistics"]
    assert "6 rows" in stats[0] and t.read().agg(F.sum("n")).first()[0] == 9
    spark.sql("DROP TABLE kept_small")
