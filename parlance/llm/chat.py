"""Operator 3, chat formatting: conversations that share initial turns become prefix trees.

Conversations are ordered by the hashes of their turns, so those with common initial turns stand side by side whatever
partition they come from. Each partition walks its run once and packs it: a turn that the path before already holds is not
emitted again, so a pack lists its tree depth first. Tokens are code points. Every node carries its place in the pack, its
first position id (ids count along the path from the root, not along the pack) and the intervals of the pack that hold its
ancestors: a token attends to those and to what stands before it in its own node.

A pack ends when its budget of characters or conversations is used up, so a first turn that a third of all conversations
share is spread over many packs and repeats once in each. One conversation is never split.

Template: <|turn|>role, newline, text, <|end|>. In roles and texts a backslash is written twice and < as backslash and l, so
no text can hold a control string; in roles a newline is written as backslash and n. The loss mask covers the texts of
assistant turns.

Edge cases: null roles and texts are empty. Rows with equal turn numbers are ordered by role, then text; null turns come
first. A row without conversation id is a conversation of its own, so that such rows are no group. Exact copies share all nodes.
Extra columns are ignored. An empty table gives no packs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import stash

TURN, END = "<|turn|>", "<|end|>"
TRAINED = "assistant"
PACK_CHARS = 200_000
PACK_CONVERSATIONS = 1_024

PACK = (
    "text string, nodes array<struct<start:bigint,length:bigint,position:bigint,parent:int,loss_start:bigint,loss_end:bigint,"
    "ancestors:array<struct<start:bigint,end:bigint>>>>, members array<struct<conv_id:bigint,node:int>>"
)
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_NODE = pa.struct([*[(c, pa.int64()) for c in ("start", "length", "position")], ("parent", pa.int32()), ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("ancestors", _SPAN)])
_PACK = pa.schema([("text", pa.string()), ("nodes", pa.list_(_NODE)), ("members", pa.list_(pa.struct([("conv_id", pa.int64()), ("node", pa.int32())])))])

READ = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l")


def unescape(text: str) -> str:
    return "\\".join(x.replace("\\l", "<").replace("\\n", "\n") for x in text.split("\\\\"))


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn as written, and where its text begins and ends in it."""
    start = TURN + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return start + body + END, len(start), len(start) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted conversation."""
    turns = []
    for part in formatted.split(TURN)[1:]:
        role, _, rest = part.partition("\n")
        turns.append((unescape(role), unescape(rest[: -len(END)])))
    return turns


class Pack:
    """The prefix tree under way; path holds the turns from the root to the last node with their numbers."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.chars = 0
        self.nodes: list[dict] = []
        self.members: list[dict] = []
        self.path: list[tuple[str, str, int]] = []

    def add(self, conv_id: int | None, turns: list[tuple[str, str]]) -> None:
        shared = 0
        while shared < min(len(turns), len(self.path)) and turns[shared] == self.path[shared][:2]:
            shared += 1
        del self.path[shared:]
        for role, text in turns[shared:]:
            parent = self.path[-1][2] if self.path else -1
            self.path.append((role, text, self._node(parent, role, text)))
        self.members.append({"conv_id": conv_id, "node": self.path[-1][2]})

    def _node(self, parent: int, role: str, text: str) -> int:
        written, a, b = format_turn(role, text)
        position, spans = 0, []
        if parent >= 0:
            up = self.nodes[parent]
            position, spans = up["position"] + up["length"], list(up["ancestors"])
            if spans and spans[-1]["end"] == up["start"]:
                spans[-1] = {"start": spans[-1]["start"], "end": up["start"] + up["length"]}
            else:
                spans.append({"start": up["start"], "end": up["start"] + up["length"]})
        loss = (self.chars + a, self.chars + b) if role == TRAINED else (None, None)
        self.nodes.append({"start": self.chars, "length": len(written), "position": position, "parent": parent, "loss_start": loss[0], "loss_end": loss[1], "ancestors": spans})
        self.parts.append(written)
        self.chars += len(written)
        return len(self.nodes) - 1

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"text": "".join(self.parts), "nodes": self.nodes, "members": self.members}], _PACK)


def format_chats(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", pack_chars: int = PACK_CHARS, pack_conversations: int = PACK_CONVERSATIONS) -> DataFrame:
    """One row per pack: its text, nodes depth first, and the conversations with their last node."""
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = F.when(F.col(conv).isNull(), F.monotonically_increasing_id())
    convs = rows.select(F.col(conv).alias("conv_id"), own.alias("own"), one.alias("one")).groupBy("conv_id", "own").agg(F.array_sort(F.collect_list("one")).alias("turns"))
    convs = convs.select("conv_id", F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"])).alias("path"), F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    convs = stash(convs)  # ranges are drawn from a sample, which would group all turns once more
    ordered = convs.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").select("conv_id", "turns")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = Pack()
        for batch in batches:
            for row in batch.to_pylist():
                if pack.members and (pack.chars >= pack_chars or len(pack.members) >= pack_conversations):
                    yield pack.batch()
                    pack = Pack()
                pack.add(row["conv_id"], [(t["role"], t["text"]) for t in row["turns"]])
        if pack.members:
            yield pack.batch()

    return ordered.mapInArrow(build, PACK)


def read_packs(packs: DataFrame) -> DataFrame:
    """One row per conversation, read back from the packs: its text is what its last node attends to, and that node."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack in batch.to_pylist():
                seen: dict[int, dict] = {}
                out = []
                for m in pack["members"]:
                    if m["node"] not in seen:
                        seen[m["node"]] = _facts(pack, m["node"])
                    out.append({"conv_id": m["conv_id"]} | seen[m["node"]])
                yield pa.RecordBatch.from_pylist(out, _READ)

    return packs.mapInArrow(read, READ)


def _facts(pack: dict, leaf: int) -> dict:
    nodes, text = pack["nodes"], pack["text"]
    own = nodes[leaf]
    spans = [(s["start"], s["end"]) for s in own["ancestors"]] + [(own["start"], own["start"] + own["length"])]
    formatted = "".join(text[a:b] for a, b in spans)
    if own["position"] + own["length"] != len(formatted):
        raise ValueError("positions and ancestor intervals disagree")
    chain, k = [], leaf
    while k >= 0:
        chain.append(nodes[k])
        k = nodes[k]["parent"]
    loss = "".join(unescape(text[n["loss_start"] : n["loss_end"]]) for n in reversed(chain) if n["loss_start"] is not None)
    turns = parse(formatted)
    digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    return {"n_turns": len(turns), "turns_sha256": digest, "loss_chars": len(loss), "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(), "formatted_chars": len(formatted)}
