"""Operator 1, MinHash near-dedup: a signature-coordinate inverted join that counts collisions.

1. Each text becomes its set of distinct five-word shingles and a signature of `COORDINATES` minima. Equal sets fall together
   under their digest; from here on one row, with a number of its own, stands for all of them.
2. Sets are posted under (coordinate, value) pairs. Pairs that only one set has link nothing and go. Each set's postings are
   ordered by how many sets share them, rarest first. Two sets with `MATCHES` equal coordinates must share one of the first
   COORDINATES - MATCHES + 1 postings (prefix), so sets with too few shared postings go as well.
3. Every prefix posting has a leader: its most central set at first, then in each of `ROUNDS` rounds the first one in one of
   `ORDERS` hashed orders. A member meets the leaders of its prefix postings once each; their collisions are then counted over
   all coordinates of the two signatures, which holds those in the skipped, longer lists as well, so the number of postings at
   which they met decides nothing. The closest leaders with `MATCHES` collisions are confirmed on the full sets, and what is
   linked takes one label. A group of copies, however large, thus costs one row for each member and
   posting, and a few comparisons for each member.
4. Postings whose members still have different labels are left. In each, members with the most common label (majors) meet only
   the others, in blocks of `BLOCK` rows on either side, and others meet each other. A task counts the collisions of such pairs
   at the first posting that both share, and passes on the members that have some pair with `MATCHES` and different labels, not
   the pairs. With their full sets at hand, a second pass confirms the pairs and gives links that connect what it found. No
   pair that might connect two labels is left out, so the rounds before only save work.
5. Components of the confirmed links; one document of each stays.

With 96 coordinates, a pair at a similarity of exactly 0.75 has fewer than 52 equal ones with a probability of 2 in a million.

Edge cases: texts without words have an empty set and link with nothing. Rows with one key and several texts are one document:
their sets are linked. Rows without key link like others; a component that no keyed row belongs to has no name. Extra columns
are ignored. Empty tables give none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.blocks import each_block
from parlance.llm.common import fresh, stash
from parlance.llm.graph import components
from parlance.llm.shingles import digest, shingles, signatures

COORDINATES = 96
MATCHES = 52
ROUNDS = 1
ORDERS = 8
CLOSEST = 2
BLOCK = 256
#: Bits of the filter for texts whose full sets are wanted: 16 MB at any size.
BITS = 1 << 27

_BASE = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("sig", pa.list_(pa.int32()))])
_SETS = pa.schema([("digest", pa.binary()), ("set", pa.binary())])
_MEMBER = "post long, i int, j int, side int, id long, label long, n long, sig array<int>, early array<tinyint>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            sets = [shingles(t) for t in part.column("text").to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            sigs = dict(zip(full, signatures([sets[i] for i in full], COORDINATES), strict=True))
            rows = [[len(s) for s in sets], [digest(s) if len(s) else None for s in sets], [sigs[i].view(np.int32) if i in sigs else None for i in range(len(sets))]]
            yield pa.RecordBatch.from_arrays([part.column("key"), *[pa.array(x, t) for x, t in zip(rows, _BASE.types[1:], strict=True)]], schema=_BASE)


def _sets_of(bitmap: bytes):
    """Full sets of the rows whose bit is set: those that are wanted, and a few more that a join removes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, np.uint8)
        for batch in batches:
            at = batch.column("bit").to_numpy(zero_copy_only=False).astype(np.int64)
            batch = batch.filter(pa.array((bits[at >> 3] >> (at & 7) & 1) == 1))
            for at in range(0, batch.num_rows, 256):
                sets = [s for t in batch.slice(at, 256).column("text").to_pylist() if len(s := shingles(t))]
                yield pa.RecordBatch.from_arrays([pa.array([digest(s) for s in sets], pa.binary()), pa.array([packed(s) for s in sets], pa.binary())], schema=_SETS)

    return run


def _bitmap(hashes: DataFrame) -> bytes:
    """BITS bits, one set for each number in the column `hash`: of one size however many there are."""
    bits = hashes.select(F.pmod("hash", F.lit(BITS)).alias("bit"))
    parts = bits.groupBy(F.expr("bit div 32768").alias("part")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit + 1))").alias("bits"))
    out = bytearray(BITS // 8)
    for r in parts.collect():
        out[r["part"] * 4096 : r["part"] * 4096 + len(r["bits"])] = r["bits"]
    return bytes(out)


def _marked(bitmap: bytes):
    """Whether the bit of a number is set, as a column function."""

    @F.pandas_udf("boolean")
    def run(bit: pd.Series) -> pd.Series:
        bits, at = np.frombuffer(bitmap, np.uint8), bit.to_numpy(np.int64)
        return pd.Series((bits[at >> 3] >> (at & 7) & 1) == 1)

    return run


def packed(s: np.ndarray) -> bytes:
    """Hashes of shingles as they travel: sorted, 7 bytes each (chances of a collision in a pair of 20,000: 5 in a billion)."""
    return np.ascontiguousarray(np.unique(s & np.uint64((1 << 56) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def unpacked(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(b, np.uint8).reshape(-1, 7)
    return out.view("<u8").ravel()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 75 * union, on sorted distinct hashes."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < 75 * len(b):
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= 75 * (len(a) + len(b) - both)


def _equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds how many coordinates of sig_a and sig_b are equal, and keeps pairs with MATCHES of them."""
    for batch in batches:
        sigs = [batch.column(c).flatten().to_numpy().reshape(-1, COORDINATES) for c in ("sig_a", "sig_b")]
        matches = (sigs[0] == sigs[1]).sum(1).astype(np.int32)
        out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(matches)], ["a", "b", "matches"])
        yield out.filter(pa.array(matches >= MATCHES))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True)
        good = [similar(unpacked(x), unpacked(y)) for x, y in rows]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))


class Block:
    """Members of one block of a posting; side 0 is compared with side 1, or with itself where there is no side 1."""

    def __init__(self, rows: pa.Table) -> None:
        self.rows = rows = rows.combine_chunks()
        self.ids, self.labels, self.sizes, side = (rows.column(c).to_numpy() for c in ("id", "label", "n", "side"))
        self.sigs = rows.column("sig").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
        self.early = np.zeros(self.sigs.shape, bool)
        for k, x in enumerate(rows.column("early").to_pylist()):
            self.early[k, x] = True
        self.left, self.right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)

    def pairs(self) -> Iterator[tuple[int, np.ndarray]]:
        """Rows of side 0 and the rows that each has MATCHES collisions with; only pairs that share no earlier posting."""
        alone = not len(self.right)
        right = self.left if alone else self.right
        for i in self.left:
            n = self.sizes[i]
            near = right[(100 * np.minimum(self.sizes[right], n) >= 75 * np.maximum(self.sizes[right], n)) & (self.labels[right] != self.labels[i])]
            near = near[near > i] if alone else near
            if len(near):
                equal = self.sigs[near] == self.sigs[i]
                near = near[(equal.sum(1) >= MATCHES) & ~(equal & self.early[i]).any(1)]
                if len(near):
                    yield i, near

    def members(self) -> pa.Table:
        keep = np.zeros(len(self.ids), bool)
        for i, near in self.pairs():
            keep[i] = keep[near] = True
        return self.rows.filter(pa.array(keep))

    def links(self) -> pa.Table:
        sets = [unpacked(x) for x in self.rows.column("set").to_pylist()]
        parent = {x: x for x in self.labels.tolist()}

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        found = []
        for i, near in self.pairs():
            for j in near:
                p, q = find(int(self.labels[i])), find(int(self.labels[j]))
                if p != q and similar(sets[i], sets[j]):
                    parent[q] = p
                    found.append((i, j))
        return pa.table([pa.array(self.ids[[p[k] for p in found]], pa.int64()) for k in (0, 1)], names=["a", "b"])


def prefixes(reps: DataFrame) -> DataFrame:
    """id, central, post, early: each set's first shared postings, rarest first, and the coordinates of those before. reps: id, sig."""
    posts = reps.select("id", F.posexplode("sig").alias("k", "value"))
    posts = posts.select("id", (F.shiftleft(F.col("k").cast("long"), 32) + F.col("value").cast("long") + F.lit(1 << 31)).alias("post"))
    # stashed, so that the join below reads both sides from shuffles of their own and Spark can split a hot posting
    shared = stash(posts.groupBy("post").agg(F.count("*").alias("df")).where("df > 1"))
    posts = posts.join(shared.hint("shuffle_merge"), "post").groupBy("id").agg(F.collect_list(F.struct("df", "post")).alias("posts"))
    room = (COORDINATES - MATCHES + 1) - (COORDINATES - F.size("posts"))  # postings of one set only come first in the order
    posts = posts.where(room > 0).select("id", F.aggregate("posts", F.lit(0).cast("long"), lambda acc, p: acc + p["df"]).alias("central"), F.slice(F.sort_array("posts"), 1, room).alias("prefix"))
    coordinates = F.transform("prefix", lambda p: F.shiftright(p["post"], 32).cast("tinyint"))
    posts = posts.select("id", "central", coordinates.alias("all"), F.posexplode("prefix").alias("at", "p"))
    return stash(posts.select("id", "central", "p.post", F.slice("all", 1, F.col("at")).alias("early")))


def both_sides(pairs: DataFrame, facts: DataFrame, column: str) -> DataFrame:
    """pairs with the column of either side, named column_a and column_b."""
    one = lambda c: facts.select(F.col("id").alias(c), F.col(column).alias(f"{column}_{c}"))
    return pairs.join(one("a"), "a").join(one("b"), "b")


def leaders(rows: DataFrame, order: Column, reps: DataFrame) -> DataFrame:
    """a, b: each set and its CLOSEST leaders with another label, where they have MATCHES equal coordinates. rows: id, post, label."""
    lead = F.max(F.struct(order.alias("order"), (-F.col("id")).alias("minus"), "label")).alias("first")
    first = rows.groupBy("post").agg(lead, F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    first = stash(first.select("post", (-F.col("first.minus")).alias("b"), F.col("first.label").alias("theirs")))
    counted = rows.join(first, "post").where("label <> theirs").groupBy(F.col("id").alias("a"), "b").agg(F.count("*").alias("collisions"))
    equal = both_sides(counted.select("a", "b"), reps, "sig").mapInArrow(_equal, "a long, b long, matches int")
    near = F.slice(F.sort_array(F.collect_list(F.struct("matches", (-F.col("b")).alias("minus"))), asc=False), 1, CLOSEST)  # of a prefix's leaders
    return stash(equal.groupBy("a").agg(near.alias("near")).select("a", F.explode("near").alias("x")).select("a", (-F.col("x.minus")).alias("b")))


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """id, label: linked labels give way to the smallest one next to them, and that in turn; equal labels mean connected ids."""
    pairs = both_sides(links, labels, "label").where("label_a <> label_b")
    up = stash(pairs.groupBy(F.greatest("label_a", "label_b").alias("label")).agg(F.min(F.least("label_a", "label_b")).alias("to")))
    again = lambda n: up.select(F.col("label").alias(f"to{n}"), F.col("to").alias(f"to{n + 1}"))
    up = up.withColumnRenamed("to", "to0").join(again(0), "to0", "left").join(again(1), "to1", "left").select("label", F.coalesce("to2", "to1", "to0").alias("to"))
    return stash(labels.join(up, "label", "left").select("id", F.coalesce("to", "label").alias("label")))


def blocks(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """_MEMBER: the comparisons left between members of a posting with different labels. rows: id, post, label, early."""
    per = rows.groupBy("post", "label").agg(F.count("*").alias("n"))
    plan = per.groupBy("post").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"), F.count("*").alias("labels")).where("labels > 1")
    cut = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int")
    plan = stash(plan.select("post", F.col("top.label").alias("major"), cut(F.col("top.n")).alias("nm"), cut(F.col("all") - F.col("top.n")).alias("no")))
    rows = rows.join(plan, "post").withColumn("outside", F.col("label") != F.col("major"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.when(F.col("outside"), F.col("no")).otherwise(F.col("nm"))).cast("int"))
    cell = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))
    # a block of others meets blocks of others with a number from its own on (j >= 0) and all blocks of majors (j < 0)
    others = F.transform(F.sequence(F.lit(0), F.col("no") - 1), lambda k: cell(F.least(k, F.col("own")), F.greatest(k, F.col("own")), k < F.col("own")))
    majors = F.transform(F.sequence(F.lit(0), F.col("nm") - 1), lambda k: cell(F.col("own"), -1 - k, F.lit(0)))
    theirs = F.transform(F.sequence(F.lit(0), F.col("no") - 1), lambda k: cell(k, -1 - F.col("own"), F.lit(1)))
    cells = F.explode(F.when(F.col("outside"), F.concat(others, majors)).otherwise(theirs)).alias("c")
    return rows.select("post", "id", "label", "early", cells).join(reps, "id").select("post", "c.i", "c.j", "c.side", "id", "label", "n", "sig", "early")


def full_sets(body: DataFrame, reps: DataFrame, ids: DataFrame) -> DataFrame:
    """id, set: the shingles of the sets with these ids. body: key_hash, text; reps: id, digest, hash (a row that has the set)."""
    wanted = stash(ids.distinct().join(reps.select("id", "digest", "hash"), "id"))
    bit = F.pmod("hash", F.lit(BITS)).alias("bit")
    sets = body.select(bit, "text").mapInArrow(_sets_of(_bitmap(wanted)), "digest binary, set binary")
    return stash(sets.join(wanted.select("id", "digest"), "digest").select("id", "set").dropDuplicates(["id"]))


def confirmed(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs a, b whose full sets are similar."""
    return stash(both_sides(pairs, sets, "set").mapInArrow(_confirm, "a long, b long"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, component_id and kept (the document whose key names its component)."""
    body = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    base = stash(body.mapInArrow(_sign, "key long, n long, digest binary, sig array<int>"))
    # a text is found again by the hash of its row's key, or where it has none by that of all rows without key
    body = body.select(F.xxhash64("key").alias("hash"), "text")
    sets = base.where("digest is not null").groupBy("digest").agg(F.min("key").alias("least"), F.min(F.xxhash64("key")).alias("hash"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    reps = stash(sets.withColumn("id", F.monotonically_increasing_id()))  # written once, so the numbers stay

    prefix = prefixes(reps.select("id", "sig"))
    near = stash(reps.select("id", "n", "sig").join(prefix.select("id").distinct(), "id", "left_semi"))
    sets = full_sets(body, reps, near.select("id"))
    labels, links = near.select("id", F.col("id").alias("label")), []
    for turn in range(ROUNDS + 1):
        rows = stash(prefix.join(labels, "id").select("id", "post", "label", "central"))
        order = F.xxhash64("id", F.col("post") % ORDERS, F.lit(turn)) if turn else F.col("central")
        links.append(confirmed(sets, leaders(rows, order, near)))
        labels = relabelled(labels, links[-1])
    keys = ["post", "i", "j"]
    left = stash(each_block(blocks(prefix.join(labels, "id").drop("central"), near), keys, lambda x: Block(x).members(), _MEMBER))
    links.append(stash(each_block(left.join(sets, "id"), keys, lambda x: Block(x).links(), "a long, b long")))

    # sets of rows with one key belong together
    ids = reps.select("id", "digest")
    keyed = base.where("digest is not null and key is not null").select("key", "digest")
    several = keyed.groupBy("key").agg(F.min("digest").alias("first"), F.max("digest").alias("last")).where("first <> last").drop("last")
    same = keyed.join(several, "key").join(ids, "digest").select("id", "first").join(ids.select(F.col("id").alias("b"), F.col("digest").alias("first")), "first")
    same = stash(same.select(F.col("id").alias("a"), "b"))

    # most links are inside a label by now; components are those of the labels that links still connect
    others = same.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(labels, "id", "left_anti").select("id", F.col("id").alias("label"))
    labels = stash(labels.unionByName(others))
    across = both_sides(reduce(DataFrame.unionByName, links).unionByName(same), labels, "label").where("label_a <> label_b")
    linked = components(across.select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))).withColumnRenamed("id", "label")
    named = labels.join(linked, "label", "left").select("id", F.coalesce("component", "label").alias("component"))
    named = stash(named.join(reps.select("id", "digest", "least"), "id"))
    names = named.groupBy("component").agg(F.min("least").alias("name"))
    final = reps.select("digest", "least").join(named.join(names, "component").select("digest", "name"), "digest", "left").select("digest", F.coalesce("name", "least").alias("component"))
    out = base.join(stash(final), "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("key")).when(F.col("key").isNotNull(), F.col("component"))
    out = out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each group of near-duplicates: that of its smallest key. Columns stay as they are.

    Of rows with that key one stays, chosen by its contents. Rows without key can't be told apart by it and stay.

    Most rows have a key of their own and stay: they are never shuffled. Only rows whose key is not so, and a few more that a
    filter of fixed size can't tell from them, are joined with what was found.
    """
    own, stay, row = fresh(docs, ["_key", "_stay", "_row"])
    found = near_duplicates(docs, key, text).where(F.col(key).isNotNull())
    found = stash(found.groupBy(F.col(key).alias(own)).agg(F.count_if("kept").alias(stay), F.count("*").alias("all")))
    odd = _marked(_bitmap(found.where(f"`{stay}` <> 1 or all <> 1").select(F.xxhash64(own).alias("hash"))))
    asked = F.coalesce(odd(F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(BITS))), F.lit(False)) & F.col(key).isNotNull()
    rows = docs.where(asked).join(found.where(F.col(stay) > 0).drop("all"), F.col(key) == F.col(own))
    once = rows.where(F.col(stay) == 1).select(*docs.columns)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    again = rows.where(F.col(stay) > 1).groupBy(own).agg(F.min_by(whole, F.sha2(F.to_json(whole), 256)).alias(row)).select(f"{row}.*")
    return docs.where(~asked).unionByName(once).unionByName(again)
