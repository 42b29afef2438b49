"""The stream over growing files: slices, settled months, damaged files."""

from __future__ import annotations

import json
import random

import pytest
from pyarrow import fs

from parlance.streaming import tail


def write(root, month, room, text, mode="ab"):
    d = root / month / "C"
    d.mkdir(parents=True, exist_ok=True)
    with (d / f"{room}.ndjson").open(mode) as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def line(i, text="x"):
    return json.dumps({"sourceMessageId": str(i), "content": text}, ensure_ascii=False) + "\n"


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 20])
def test_slices_of_any_size_give_each_line_once(tmp_path, chunk):
    """Also when the file grows in the middle of a line or of a character, and lines are longer than a slice or than what is read back at once."""
    rng = random.Random(3)
    lines = [line(i, rng.choice(["é" * rng.randrange(20), "", "客" * 9])) for i in range(30)]
    lines[11] = line(11, "y" * (tail._BACK + 10)) if chunk > 64 else lines[11]
    body = "".join(lines).encode()
    reader = tail.TailReader(f"{tmp_path}/*/*/*.ndjson", chunk, 0)
    at, got, offset = 0, [], reader.initialOffset()
    for cut in [*sorted(rng.sample(range(1, len(body)), 6)), len(body)]:
        write(tmp_path, "202608", "R1", body[at:cut])
        at, end = cut, reader.latestOffset()
        rows = [r for part in reader.partitions(offset, end) for r in reader.read(part)]
        assert all(r[4] is None for r in rows)
        got += [r[1] + "\n" for r in rows]
        again = [r for part in reader.partitions(offset, end) for r in reader.read(part)]
        assert again == rows
        offset = end
    assert got == lines and reader.partitions(offset, reader.latestOffset()) == []


def test_planning_opens_no_file(tmp_path, monkeypatch):
    for i in range(500):
        write(tmp_path, "202608", f"R{i}", line(i))
    reader = tail.TailReader(f"{tmp_path}/*/*/*.ndjson", 64, 0)

    class Listing:
        def get_file_info(self, selector):
            return fs.LocalFileSystem().get_file_info(selector)

    monkeypatch.setattr(reader, "files", Listing())
    assert len(reader.partitions(reader.initialOffset(), reader.latestOffset())) == 500


def test_settled_months_are_read_once_and_leave_the_offset(tmp_path):
    for month in ("202605", "202606", "202607", "202608"):
        write(tmp_path, month, "R1", line(month))
    pattern = f"{tmp_path}/*/*/*.ndjson"
    reader = tail.TailReader(pattern, 1 << 20, 2)
    first = reader.latestOffset()
    months = lambda o: sorted(map(tail.month_of, json.loads(o["files"])))
    assert months(first) == ["202605", "202606", "202607", "202608"] and first["settled"] == "202606"
    assert reader.latestOffset() == first  # until the batch is through, nothing is left out
    assert len(reader.partitions(reader.initialOffset(), first)) == 4
    reader.commit(first)
    write(tmp_path, "202607", "R1", line("more"))
    second = reader.latestOffset()
    assert months(second) == ["202607", "202608"] and [p.start for p in reader.partitions(first, second)] == [len(line("202607"))]
    # a new process knows only the checkpoint: it lists everything once and reads nothing again
    fresh = tail.TailReader(pattern, 1 << 20, 2)
    assert fresh.partitions(second, fresh.latestOffset()) == []
    # the month that settles next gives what came last
    reader.commit(second)
    write(tmp_path, "202607", "R1", line("last"))
    write(tmp_path, "202609", "R1", line("202609"))
    third = reader.latestOffset()
    assert third["settled"] == "202607" and sorted(tail.month_of(p.path) for p in reader.partitions(second, third)) == ["202607", "202609"]


def test_patterns(tmp_path):
    write(tmp_path, "202608", "R1", line(1))
    (tmp_path / "202608" / "C" / "deep").mkdir()
    (tmp_path / "202608" / "C" / "deep" / "R2.ndjson").write_text(line(2))
    (tmp_path / "202608" / "C" / "R3.tmp").write_text(line(3))
    assert [p.rpartition("/")[2] for p in tail.TailReader(f"{tmp_path}/*/*/*.ndjson", 9, 0).found()] == ["R1.ndjson"]
    assert list(tail.TailReader(f"file://{tmp_path}/*/*/R1.ndjson", 9, 0).found().values()) == [len(line(1))]
    assert tail.TailReader(f"{tmp_path}/none/*.ndjson", 9, 0).found() == {}
    with pytest.raises(ValueError, match="chunk"):
        tail.TailReader("x", 0, 0)


def test_a_damaged_slice_stops_its_room_alone(spark, tmp_path):
    root, out, at = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "at")
    step = lambda: tail.land(spark, f"{root}/*/*/*.ndjson", out, at, chunk=40).awaitTermination()
    for room in ("R1", "R2", "R3", "R4"):
        write(root, "202608", room, line(1) + line(2))
    step()
    write(root, "202608", "R1", line(3))
    write(root, "202608", "R2", "no object\n")
    write(root, "202608", "R3", b'{"x": "\xff"}\n')
    write(root, "202608", "R4", line(1), "wb")  # shorter than it was
    step()
    for room in ("R1", "R2", "R3"):
        write(root, "202608", room, line(4))
    step()
    rows = tail.landed(spark, out)
    ids = {}
    for r in tail.messages_of(tail.usable(rows)).collect():
        ids.setdefault(r["path_room"], []).append(r["sourceMessageId"])
    assert {k: sorted(v) for k, v in ids.items()} == {"R1": ["1", "2", "3", "4"], "R2": ["1", "2"], "R3": ["1", "2"], "R4": ["1", "2"]}
    assert {r["room"]: r["faults"] for r in tail.stopped(rows).collect()} == {"R2": ["lines"], "R3": ["encoding"], "R4": ["short"]}
    records = tail.chunk_records(rows).where("path like '%R1.ndjson'").collect()
    assert sum(r["lines"] for r in records) == 4 and sum(r["bytes"] for r in records) == 4 * len(line(1))
    with pytest.raises(Exception, match="damaged: lines"):
        tail.raw_messages(spark, f"{root}/*/*/R2.ndjson").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "raw_at")).trigger(availableNow=True).start().awaitTermination()
