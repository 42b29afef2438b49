"""Operator 12, conversation prefix trie: every distinct sequence of first turns is a node, with what lies below it.

A conversation becomes an array of turn digests (16 bytes of a SHA-256 of role and text). The arrays are range-sorted over all
partitions, ties by conversation, so that what shares initial turns stands side by side and a group of copies may span many
partitions. Each partition is swept once: the common prefix of two neighbours says how many nodes of the stack end. An ended node
is written with its counts and adds them to the node above.

Two paths of a partition may go on elsewhere: that of its first row and that of its last. Their nodes aren't ended but written as
parts, one head and one tail row for each partition. A second sweep takes these rows in order, in one task (two paths for each
partition, however many rows those hold), and stitches the stacks together. Which conversation names a node is known only once it
ends, so nodes written before that hold a reference, and a last join puts the parent's name in its place.

A node's digest of ending conversations is one SHA-256 over their numbers in order. In a group that spans partitions the numbers
travel as chunks to the second sweep; no row holds more than one chunk.

Edge cases: null roles and texts are empty. Turns are ordered by turn (null first), then role and text; repeated rows are turns of
their own. Rows without conversation belong to none and are left out. A conversation without turns ends at the root. Very long
texts count as digests. An empty table has no node, not even a root. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import stash

#: Conversation numbers in a chunk, and children that a node keeps until it ends.
CHUNK, WAITING = 65_536, 50_000

#: What a row of a sweep is: a node, the name of a node that others refer to, or a partition's parts in the order they're stitched.
NODE, NAME, HEAD, FIRST_ENDS, TAIL, LAST_ENDS = range(6)
_PART = "struct<serial:bigint,conv:bigint,n:bigint,children:bigint,leaves:bigint,saved:bigint,ends:string,named:boolean>"
SWEPT = (
    "part int, kind int, seq bigint, up bigint, serial bigint, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint,"
    f"saved_tokens bigint, ends_sha256 string, path array<binary>, sizes array<bigint>, common int, parts array<{_PART}>, chunk string"
)
_PARTS = pa.list_(pa.struct([*[(c, pa.int64()) for c in ("serial", "conv", "n", "children", "leaves", "saved")], ("ends", pa.string()), ("named", pa.bool_())]))
_SWEPT = pa.schema([
    ("part", pa.int32()), ("kind", pa.int32()), *[(c, pa.int64()) for c in ("seq", "up", "serial", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
    ("ends_sha256", pa.string()), ("path", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64())), ("common", pa.int32()), ("parts", _PARTS), ("chunk", pa.string()),
])
NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
NOTHING = hashlib.sha256(b"").hexdigest()


def turn_paths(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, path (turn digests in order) and sizes (bytes of the texts)."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t).cast("binary"), 256)), 1, 16)
    one = F.struct(F.col(turn).alias("turn"), r.alias("role"), t.alias("text"), digest.alias("digest"), F.octet_length(t).cast("long").alias("bytes"))
    convs = rows.where(F.col(conv).isNotNull()).groupBy(F.col(conv).alias("conv_id")).agg(F.array_sort(F.collect_list(one)).alias("turns"))
    return convs.select("conv_id", F.col("turns.digest").alias("path"), F.col("turns.bytes").alias("sizes"))


def _shared(a: list[bytes], b: list[bytes]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def joined(ids: array) -> str:
    return ",".join(map(str, ids))


class _Node:
    """A node of the stack. Counts hold its own rows and what has ended below it."""

    __slots__ = ("serial", "size", "conv", "n", "children", "leaves", "saved", "ends", "named", "waiting", "names", "sha")

    def __init__(self, serial: int, size: int) -> None:
        self.serial, self.size = serial, size
        self.conv: int | None = None
        self.n = self.children = self.leaves = self.saved = 0
        self.ends: str | None = None
        self.named = False
        self.waiting: list[dict] = []
        self.names: list[tuple[int, int]] = []
        self.sha = None

    def add(self, conv: int | None, n: int, children: int, leaves: int, saved: int) -> None:
        if conv is not None and (self.conv is None or conv < self.conv):
            self.conv = conv
        self.n += n
        self.children += children
        self.leaves += leaves
        self.saved += saved

    def end(self, depth: int) -> dict:
        """The node's row, all below it having ended."""
        self.saved += (self.n - 1) * self.size
        self.leaves = self.leaves or 1
        ends = self.sha.hexdigest() if self.sha else self.ends or NOTHING
        return {"kind": NODE, "conv_id": self.conv, "depth": depth, "n_convs": self.n, "n_children": self.children, "n_leaves": self.leaves, "saved_tokens": self.saved, "ends_sha256": ends}

    def part(self) -> dict:
        return {"serial": self.serial, "conv": self.conv, "n": self.n, "children": self.children, "leaves": self.leaves, "saved": self.saved, "ends": self.ends, "named": self.named}


class _Out:
    """Rows under way, given out in batches."""

    def __init__(self, part: int | None) -> None:
        self.part, self.rows, self.ready = part, [], []

    def put(self, row: dict) -> None:
        self.rows.append({"part": self.part} | row)
        if len(self.rows) >= 5_000:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            self.ready.append(pa.RecordBatch.from_pylist(self.rows, _SWEPT))
            self.rows = []

    def take(self) -> list[pa.RecordBatch]:
        ready, self.ready = self.ready, []
        return ready


class _Sweep:
    """One partition: conversations in order of path and number."""

    def __init__(self, part: int) -> None:
        self.out = _Out(part)
        self.path: list[bytes] | None = None
        self.first: list[bytes] = []
        self.stack: list[_Node] = []
        self.ended: list[dict] = []  # parts of the first path that have left the stack
        self.common = 0  # depth to which all rows so far share the first path
        self.serial = self.chunks = 0
        self.ids = array("q")

    def _push(self, sizes: list[int]) -> None:
        for d in range(len(self.stack), len(sizes) + 1):
            self.stack.append(_Node(self.serial, sizes[d - 1] if d else 0))
            self.serial += 1

    def add(self, conv: int, path: list[bytes], sizes: list[int]) -> None:
        if self.path is None:
            self.first, self.first_sizes, self.common = path, sizes, len(path)
            self._push(sizes)
        elif path != self.path:
            self._no_more_ends()
            shared = _shared(self.path, path)
            while len(self.stack) > shared + 1:
                self._end()
            self.common = min(self.common, shared)
            self._push(sizes)
        self.path, self.sizes = path, sizes
        self.stack[-1].add(conv, 1, 0, 0, 0)
        self.ids.append(conv)
        if self._at_first() and len(self.ids) == CHUNK:
            self._chunks(FIRST_ENDS)

    def _at_first(self) -> bool:
        return self.common == len(self.first) == len(self.path)

    def _chunks(self, kind: int) -> None:
        for k in range(0, len(self.ids), CHUNK):
            self.out.put({"kind": kind, "seq": self.chunks, "chunk": joined(self.ids[k : k + CHUNK])})
            self.chunks += 1
        self.ids = array("q")

    def _no_more_ends(self) -> None:
        """The stack's last node has all that end at it."""
        if self._at_first():
            self._chunks(FIRST_ENDS)
        elif self.ids:
            self.stack[-1].ends = hashlib.sha256(joined(self.ids).encode()).hexdigest()
            self.ids = array("q")

    def _name(self, node: _Node) -> None:
        """Give out the node's children; those that ended before it have a reference."""
        for row in node.waiting:
            self.out.put(row | {"up": node.serial})
        node.waiting, node.named = [], True

    def _end(self) -> None:
        depth = len(self.stack) - 1
        node = self.stack.pop()
        if depth <= self.common:  # on the first path: others may share it
            self._name(node)
            self.ended.append(node.part())
            self.common = depth - 1
            return
        up, row = self.stack[-1], node.end(depth)
        if node.named:
            self._name(node)
            self.out.put({"kind": NAME, "serial": node.serial, "conv_id": node.conv})
        else:
            for child in node.waiting:
                self.out.put(child | {"parent_conv_id": node.conv})
        up.add(node.conv, node.n, 1, node.leaves, node.saved)
        up.waiting.append(row)
        if len(up.waiting) >= WAITING:
            self._name(up)

    def close(self) -> None:
        if self.path is None:
            return
        self._chunks(FIRST_ENDS if self._at_first() else LAST_ENDS)
        for node in self.stack:
            self._name(node)
        self.out.put({"kind": HEAD, "path": self.first, "sizes": self.first_sizes, "parts": self.ended[::-1]})
        self.out.put({"kind": TAIL, "path": self.path, "sizes": self.sizes, "common": self.common, "parts": [x.part() for x in self.stack]})
        self.out.flush()


class _Stitch:
    """All partitions' heads and tails in order: a stack of the nodes that go on from one to the next."""

    def __init__(self) -> None:
        self.out = _Out(None)
        self.path: list[bytes] = []
        self.stack: list[_Node] = []

    def add(self, row: dict) -> None:
        kind = row["kind"]
        if kind in (FIRST_ENDS, LAST_ENDS):
            node = self.stack[-1]
            if node.sha is None:
                node.sha = hashlib.sha256(row["chunk"].encode())
            else:
                node.sha.update(b"," + row["chunk"].encode())
            return
        shared = _shared(self.path, row["path"]) if kind == HEAD else row["common"]
        while len(self.stack) > shared + 1:
            self._end()
        for d in range(len(self.stack), len(row["sizes"]) + 1):
            self.stack.append(_Node(0, row["sizes"][d - 1] if d else 0))
        self.path = row["path"]
        first = len(self.stack) - len(row["parts"]) if kind == HEAD else 0
        for node, p in zip(self.stack[first:], row["parts"], strict=True):
            node.add(p["conv"], p["n"], p["children"], p["leaves"], p["saved"])
            node.ends = node.ends or p["ends"]
            if p["named"]:
                node.names.append((row["part"], p["serial"]))

    def _end(self) -> None:
        depth = len(self.stack) - 1
        node = self.stack.pop()
        row = node.end(depth)
        for child in node.waiting:
            self.out.put(child | {"parent_conv_id": node.conv})
        for part, serial in node.names:
            self.out.put({"kind": NAME, "part": part, "serial": serial, "conv_id": node.conv})
        if self.stack:
            self.stack[-1].add(node.conv, node.n, 1, node.leaves, node.saved)
            self.stack[-1].waiting.append(row)
        else:
            self.out.put(row)

    def close(self) -> None:
        while self.stack:
            self._end()
        self.out.flush()


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sweep = _Sweep(TaskContext.get().partitionId())
    for batch in batches:
        for conv, path, sizes in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "path", "sizes")], strict=True):
            sweep.add(conv, path, sizes)
        yield from sweep.out.take()
    sweep.close()
    yield from sweep.out.take()


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stitch = _Stitch()
    for batch in batches:
        for row in batch.to_pylist():
            stitch.add(row)
        yield from stitch.out.take()
    stitch.close()
    yield from stitch.out.take()


def prefix_trie(paths: DataFrame) -> DataFrame:
    """One row per node: conv_id (its smallest member; the node is that conversation's first depth turns), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens (bytes that its subtree spares) and ends_sha256 (of the conversations that end at it).
    """
    paths = stash(paths.select("conv_id", "path", "sizes"))  # ranges are drawn from a sample, which would compute paths once more
    ordered = paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    swept = stash(ordered.mapInArrow(_sweep, SWEPT))
    edges = swept.where(F.col("kind") >= HEAD).repartition(1).sortWithinPartitions("part", "kind", "seq")
    stitched = stash(edges.mapInArrow(_stitch, SWEPT))
    names = swept.where(F.col("kind") == NAME).unionByName(stitched.where(F.col("kind") == NAME)).select("part", F.col("serial").alias("up"), F.col("conv_id").alias("_name"))
    nodes = swept.where(F.col("kind") == NODE)
    hanging = nodes.where("up is not null").drop("parent_conv_id").join(names, ["part", "up"]).withColumnRenamed("_name", "parent_conv_id")
    whole = nodes.where("up is null").unionByName(stitched.where(F.col("kind") == NODE))
    return whole.select(*NODE_COLUMNS).unionByName(hanging.select(*NODE_COLUMNS))
