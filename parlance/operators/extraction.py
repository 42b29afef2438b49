"""From a room's messages to events.

Spark numbers a room's messages, cuts them into segments at long silences (window functions), and finds what each replies to (a
self-join). What a model is told of a segment depends on what earlier segments left open, so a task reads its rooms' segments
in order, one segment in memory at a time, and keeps of a room its drafts and ids. Redaction before it, and after it putting
together drafts that replies connect (operators/replies.py) and assembly, are DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from datetime import datetime
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions import text as X
from parlance.functions import worktime
from parlance.operators.replies import joined_by_replies
from parlance.sources.landing import kept

SEGMENT = 400
SUMMARY_SOFT, SUMMARY_HARD = 100, 200
QUOTE = 40
# Words of the rendered view.
PLATFORM, MERCHANT, CLOSED, REPLY = "平台", "商家", "（已了结）", "↩回复"
NOTES_HEAD, SEGMENT_HEAD = "【进行中的事件】（上一段留下的，本段接着说就填对应 ref）", "【本段消息】"

DRAFTS = "corp string, room string, event_no int, msg_ids array<string>, summary string, error string"


_DRAFTS = pa.schema([("corp", pa.string()), ("room", pa.string()), ("event_no", pa.int32()), ("msg_ids", pa.list_(pa.string())), ("summary", pa.string()), ("error", pa.string())])
_VIEWS = pa.schema([("corp", pa.string()), ("room", pa.string()), ("segment", pa.int32()), ("view", pa.string())])


class TooBig(Exception):
    """The model can't handle a segment as a whole; halves may do."""


@dataclass
class Found:
    """What a model says of a segment: line numbers (from 1), a summary, whether it goes on, and the event it continues (E<n>)."""

    lines: list[int]
    summary: str
    still_open: bool = False
    ref: str | None = None


#: the view of a segment and the number of its lines -> what it holds
Model = Callable[[str, int], list[Found]]


@dataclass
class Line:
    """A message as segmented() gives it."""

    i: int
    msg_id: str
    at: datetime
    sender_id: str
    sender_role: str
    body: str
    order_no: str | None
    reply_i: int | None
    quote: str | None


@dataclass
class Draft:
    lines: set[int]
    summary: str
    still_open: bool
    last_words: str = ""
    order: tuple[int, str] | None = None


def segmented(messages: DataFrame, most: int = SEGMENT) -> DataFrame:
    """corp, room, segment and the fields of Line: messages numbered from 0 by time, in about equal runs of up to about `most`.

    Of n messages in k = ceil(n / most) runs, cut j is meant for n * j / k. It goes to the longest silence among the places that
    are at most a twentieth of a run (one place at least) away from there, the first of equal ones. Runs of one or two messages
    are cut where they are meant to be.
    """
    body = X.redacted(X.shown(F.col("text"), F.col("msg_type")))
    by_time = Window.partitionBy("corp", "room").orderBy("at", "msg_id")
    rows = messages.select("corp", "room", "msg_id", "at", "sender_id", "sender_role", "reply_to", body.alias("body")).withColumn("order_no", X.first_order(F.col("body")))
    rows = rows.withColumns({"i": F.row_number().over(by_time) - 1, "silence": F.timestamp_diff("MICROSECOND", F.lag("at").over(by_time), F.col("at"))})
    sizes = rows.groupBy("corp", "room").agg(F.count("*").alias("n")).withColumn("k", F.expr(f"(n + {most - 1}) div {most}")).where("k > 1")
    meant = F.expr("n * j div k")
    reach = F.expr("CASE WHEN n div k < 3 THEN 0 ELSE greatest(1, n div k div 20) END")
    near = rows.join(sizes, ["corp", "room"]).withColumn("j", F.explode(F.expr("array(i * k div n, i * k div n + 1)"))).where("j between 1 and k - 1 and i > 0")
    near = near.where(F.abs(F.col("i") - meant) <= reach)
    cuts = near.groupBy("corp", "room", "j").agg(F.max_by("i", F.struct("silence", -F.col("i"))).alias("i")).select("corp", "room", "i", F.lit(1).alias("begins"))
    rows = rows.join(cuts, ["corp", "room", "i"], "left").withColumn("segment", F.coalesce(F.sum("begins").over(by_time), F.lit(0)).cast("int"))
    target = rows.select("corp", "room", F.col("msg_id").alias("reply_to"), F.col("i").alias("reply_i"), F.substring("body", 1, QUOTE).alias("quote"))
    return rows.join(target, ["corp", "room", "reply_to"], "left").select("corp", "room", "segment", "i", "msg_id", "at", "sender_id", "sender_role", "body", "order_no", "reply_i", "quote")


def halves(lines: list[Line]) -> tuple[list[Line], list[Line]]:
    """Both sides of the longest silence near the middle, the first of equal ones."""
    n = len(lines)
    reach = max(1, n // 20)
    silence = [(b.at - a.at, -k) for k, (a, b) in enumerate(zip(lines, lines[1:], strict=False), 1)]
    _, k = max(silence[max(0, n // 2 - reach - 1) : n // 2 + reach])
    return lines[:-k], lines[-k:]


class Room:
    """What is kept of a room while its segments go by."""

    def __init__(self) -> None:
        self.ids: list[str] = []
        self.names: dict[str, str] = {}
        self.drafts: dict[int, Draft] = {}
        self.owner: dict[int, int] = {}

    def hear(self, lines: list[Line]) -> None:
        """Name the senders in the order of their first words, and note ids."""
        for x in lines:
            self.ids.append(x.msg_id)
            if x.sender_id not in self.names:
                side = PLATFORM if x.sender_role == "INTERNAL" else MERCHANT
                k = sum(name.startswith(side) for name in self.names.values())
                self.names[x.sender_id] = f"{side}{chr(65 + k % 26)}{k // 26 or ''}"

    def notes(self, lines: list[Line], keep: int) -> dict[int, str]:
        """What is worth knowing of the events so far, by number: those of late, and open ones that the lines reply to."""
        replied, out = {x.reply_i for x in lines}, {}
        for number, d in sorted(self.drafts.items()):
            if lines[0].i - max(d.lines) <= keep or (d.still_open and d.lines & replied):
                text = f"{d.order[1]} · {d.summary}" if d.order else d.summary
                out[number] = f"E{number}: {text}{'' if d.still_open else CLOSED} ← 上次说到「{d.last_words}」"
        return out

    def view(self, lines: list[Line], keep: int) -> tuple[str, set[int]]:
        """The text that a model sees of some lines, and the events it may continue."""
        known, start = self.notes(lines, keep), lines[0].i

        def arrow(x: Line) -> str:
            if x.reply_i is None:
                return ""
            if start <= x.reply_i <= lines[-1].i:
                return f" {REPLY} #{x.reply_i - start + 1}"
            number = self.owner.get(x.reply_i)
            return f" {REPLY} E{number}" if number in known else f" {REPLY} 「{x.quote}」"

        head = [NOTES_HEAD, *known.values(), "", SEGMENT_HEAD] if known else []
        return "\n".join(head + [f"#{x.i - start + 1} [{x.at:%H:%M:%S}] {self.names[x.sender_id]}{arrow(x)}: {x.body}" for x in lines]), set(known)

    def add(self, lines: list[Line], found: list[tuple[list[int], str, bool, int | None]]) -> None:
        """Lines are added; the first summary stays, the last word on whether an event goes on counts."""
        for numbers, summary, still_open, ref in found:
            if ref is None:
                ref = max(self.drafts, default=0) + 1
                self.drafts[ref] = Draft(set(), summary, still_open)
            d = self.drafts[ref]
            d.still_open = still_open
            for k in sorted(numbers):
                x = lines[k - 1]
                if not d.lines or x.i >= max(d.lines):
                    d.last_words = x.body[:QUOTE]
                if x.order_no and (d.order is None or x.i < d.order[0]):
                    d.order = (x.i, x.order_no)
                d.lines.add(x.i)
                self.owner[x.i] = ref


def validated(found: Iterable[Found], n: int, refs: set[int], clean: Callable[[str], str], phone: Callable[[str], bool]) -> tuple[list[tuple[list[int], str, bool, int | None]], bool]:
    """Checked events, and whether a summary is long enough to ask once more. A phone number or an empty summary stops the room."""
    out, long = [], False
    for f in found:
        summary = clean(f.summary)
        if not summary or phone(summary):
            raise ValueError("summary is empty or holds a phone number")
        ref = None
        if f.ref:
            if not (f.ref[:1] == "E" and f.ref[1:].isdigit() and int(f.ref[1:]) in refs):
                raise TooBig(f"unknown event {f.ref}")
            ref = int(f.ref[1:])
        if not f.lines or not all(1 <= i <= n for i in f.lines) or len(summary) > SUMMARY_HARD:
            raise TooBig("lines or summary out of bounds")
        long |= len(summary) > SUMMARY_SOFT
        out.append((f.lines, summary, f.still_open, ref))
    return out, long


def ask(room: Room, lines: list[Line], model: Model, most: int) -> None:
    """What the model finds in a segment goes into the room. A segment that is too big, or takes too long, is asked in halves."""
    import re

    phone, noise = re.compile(X.PHONE), re.compile(X.NOISE)
    clean = lambda s: " ".join(noise.sub(" ", s).split())
    text, refs = room.view(lines, most)
    try:
        for turn in range(2):
            found, long = validated(model(text, len(lines)), len(lines), refs, clean, lambda s: bool(phone.search(s)))
            if not long or turn:
                break
    except (TooBig, TimeoutError):
        if len(lines) < 2:
            raise
        for half in halves(lines):
            ask(room, half, model, most)
    else:
        room.add(lines, found)


def _rooms(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, str], Iterator[tuple[int, list[Line]]]]]:
    """Rooms of a partition sorted by corp, room, i, each with its segments; one segment is in memory at a time."""
    rows = (r for b in batches for r in b.to_pylist())
    for key, of_room in groupby(rows, key=lambda r: (r.pop("corp"), r.pop("room"))):
        yield key, ((k, [Line(**r) for r in of_segment]) for k, of_segment in groupby(of_room, key=lambda r: r.pop("segment")))


def _in_order(messages: DataFrame, most: int) -> DataFrame:
    return segmented(messages, most).repartition("corp", "room").sortWithinPartitions("corp", "room", "i")


def extract(messages: DataFrame, model: Model, most: int = SEGMENT) -> DataFrame:
    """Drafts of every room (columns DRAFTS), those that replies connect put together. A room that fails has one row with its error.

    What fails a room: an answer that breaks the rules, a segment of one line that is still too big, or the model's connection
    (OSError). Any other error is a fault of the program and stops the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (corp, name), parts in _rooms(batches):
            room, error = Room(), None
            for _, lines in parts:
                room.hear(lines)
                if error is None:
                    try:
                        ask(room, lines, model, most)
                    except (TooBig, ValueError, OSError) as e:
                        error = str(e) or type(e).__name__
            rows = [(corp, name, None, None, None, error)] if error is not None else [(corp, name, n, [room.ids[i] for i in sorted(d.lines)], d.summary, None) for n, d in room.drafts.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _DRAFTS.types, strict=True)], schema=_DRAFTS)

    return joined_by_replies(kept(_in_order(messages, most).mapInArrow(run, DRAFTS)), messages)


def preview(messages: DataFrame, most: int = SEGMENT) -> DataFrame:
    """corp, room, segment and the text that a model would see, without notes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (corp, name), parts in _rooms(batches):
            room = Room()
            for k, lines in parts:
                room.hear(lines)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((corp, name, k, room.view(lines, most)[0]), _VIEWS.types, strict=True)], schema=_VIEWS)

    return _in_order(messages, most).mapInArrow(run, "corp string, room string, segment int, view string")


def followup_wait(msgs: Column) -> Column:
    """Longest wait in work seconds for an answer after the first one; 0 where there is none. msgs: ordered structs of at and sender_role."""
    start = F.struct(F.lit(False).alias("replied"), F.lit(None).cast("timestamp_ntz").alias("since"), F.lit(0).cast("long").alias("most"))

    def step(acc: Column, m: Column) -> Column:
        inside, outside = m["sender_role"] == "INTERNAL", m["sender_role"] == "EXTERNAL"
        answered = acc["replied"] & inside & acc["since"].isNotNull()
        since = F.when(acc["replied"] & outside & acc["since"].isNull(), m["at"]).when(inside, F.lit(None).cast("timestamp_ntz")).otherwise(acc["since"])
        most = F.when(answered, F.greatest(acc["most"], worktime.between(acc["since"], m["at"]))).otherwise(acc["most"])
        return F.struct((acc["replied"] | inside).alias("replied"), since.alias("since"), most.alias("most"))

    return F.aggregate(msgs, start, step, lambda acc: acc["most"])


def assemble(drafts: DataFrame, messages: DataFrame) -> DataFrame:
    """Events: every field but the summary comes from the messages. An event is no longer than its room, which the scan bounds."""
    member = drafts.where("error is null").select("corp", "room", "event_no", "summary", F.explode("msg_ids").alias("msg_id"))
    m = F.struct("at", "msg_id", "sender_id", "sender_role", X.shown(F.col("text"), F.col("msg_type")).alias("text"))
    rows = member.join(messages, ["corp", "room", "msg_id"]).groupBy("corp", "room", "event_no", "summary").agg(F.array_sort(F.collect_list(m)).alias("m"))
    inside = F.filter("m", lambda x: x["sender_role"] == "INTERNAL")
    rows = rows.withColumns({"inside": inside, "first": F.element_at("m", 1), "last": F.element_at("m", -1)})
    agents = F.array_distinct(F.transform("inside", lambda x: x["sender_id"]))
    ids = F.transform("m", lambda x: x["msg_id"])
    source = F.transform("m", lambda x: F.struct(x["msg_id"].alias("msg_id"), F.date_format(x["at"], "yyyy-MM-dd HH:mm:ss").alias("at"), x["sender_id"].alias("sender_id"), x["sender_role"].alias("sender_role"), x["text"].alias("text")))
    return rows.select(
        F.xxhash64("corp", "room", ids).alias("id"), F.col("corp").alias("corpid"), F.col("room").alias("roomid"), ids.alias("source_msg_ids"),
        F.col("first.at").alias("first_msg_time"), F.col("last.at").alias("last_msg_time"), F.get("inside", F.lit(0))["at"].alias("first_agent_reply_time"), F.to_date("first.at").alias("occurred_on"),
        F.col("first.sender_id").alias("asker"), F.col("first.sender_role").alias("asker_role"), agents.alias("agents"), F.get("inside", F.lit(0))["sender_id"].alias("first_responder"),
        "summary", F.col("last.sender_role").alias("last_msg_role"), followup_wait(F.col("m")).cast("int").alias("followup_wait_max_sec"),
        F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("string").alias("taxonomy_version"), source.alias("source_messages"),
    )


def orphans(events: DataFrame) -> DataFrame:
    """Events that the platform started and that name no order: mostly answers torn from their question."""
    return events.where((F.col("asker_role") == "INTERNAL") & ~F.exists("source_messages", lambda m: m["text"].rlike(X.ORDER)))


def by_reply_chain(text: str, n: int) -> list[Found]:
    """A model without a model, for tests and bridges: lines of one sender up to an answer make an event; replies in the segment join them.

    A reply to what is only quoted begins an event, as its target is in no segment seen so far or in no event.
    """
    import re

    owner, out = {}, []
    for k, arrow in re.findall(rf"^#(\d+) \[[^\]]*\] \S+?(?::| {REPLY} (?:(#\d+|E\d+):|「))", text, re.M):
        target = owner.get(arrow[1:]) if arrow.startswith("#") else None
        if target is None:
            target = Found([], f"request {k}", True, arrow if arrow.startswith("E") else None)
            out.append(target)
        target.lines.append(int(k))
        owner[k] = target
    return out
