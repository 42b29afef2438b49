"""Operator 13, sharding: a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions alone.

Each shard stands at many points of a ring of 65,536 places. A row's key hashes to a place, and the row prefers the shards in the
order in which their points follow clockwise. Rows come in the order of a second hash; one that finds a shard full goes on to the
next one. A shard takes a floor or ceiling of its share of all rows, so that all are full in the end and counts differ by one at
most. As a share's arcs are near equal with 256 points a shard, only a few rows in a hundred go on, and a further shard moves
little more than what it takes.

As all shards see the rows in one order, the outcome is fixed by the row at which each shard becomes full. Those rows are found
one after the other. Rows are counted by part (the first three hex digits of their order, 4,096 parts) and preferences; the counts
say in which part the next shard becomes full, and only that part's rows are ranked. After that every row finds its shard by
itself. Slots are numbered within a part and shard, and follow the counts of the parts before.

Equal rows are counted first and numbered without a sort. A row's place hangs on its key alone, its order on key, size, checksum
and number, so that a key that many rows share makes no part of the order large. Rows without key have places of their own.

Edge cases: a null text counts as an empty one (size 1: its bytes and 1). Repeated rows each take a slot. With fewer rows than
shards some shards stay empty. An empty table gives no rows. Extra columns aren't looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from parlance.llm.common import stash

SHARDS, POINTS, PLACES = 8, 256, 65_536
#: What rows are ordered by: a hash, then all that it is made of. The hash's first digits name the part.
ORDER, DIGITS = ("turn", "key", "size", "crc", "copy"), 3
ORDER_TYPES = {"key": "long", "size": "long", "crc": "long", "copy": "int"}


def _hex(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def ring(spark: SparkSession, shards: int = SHARDS, points: int = POINTS) -> DataFrame:
    """place and prefers (shards in the order in which their points follow) for each of 65,536 places."""
    at = spark.range(shards * points).select((F.col("id") % shards).cast("int").alias("shard"), F.expr(f"id div {shards}").alias("point"))
    at = at.select("shard", _hex(F.concat_ws(":", F.lit("point"), "shard", "point"), 4).alias("place")).distinct()
    grid = spark.range(PLACES).select(F.col("id").alias("place")).crossJoin(spark.range(shards).select(F.col("id").cast("int").alias("shard")))
    marked = grid.join(at.withColumn("own", F.col("place")), ["place", "shard"], "left")
    each = Window.partitionBy("shard")
    ahead = each.orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    next_ = F.coalesce(F.last("own", ignorenulls=True).over(ahead), F.min("own").over(each) + PLACES)
    steps = marked.select("place", F.struct((next_ - F.col("place")).alias("steps"), "shard").alias("one"))
    return steps.groupBy("place").agg(F.array_sort(F.collect_list("one"))["shard"].alias("prefers"))  # one for each shard


def light_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, crc, copy: what sharding needs of each row, copies numbered from 0."""
    bytes_ = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias("key"), (F.length(bytes_).cast("long") + 1).alias("size"), F.crc32(bytes_).alias("crc"))
    counted = rows.groupBy("key", "size", "crc").agg(F.count("*").alias("n"))
    return counted.select("key", "size", "crc", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("copy"))


def _first_open(open_: Callable[[Column], Column]) -> Column:
    return F.get(F.filter("prefers", open_), F.lit(0))


def _shard_of_row(full: list[tuple[int, Row]]) -> Column:
    """The shard that a row goes to, given the rows at which shards became full."""
    own = F.struct(*ORDER)
    points = [(s, F.struct(*[F.lit(at[c]).cast(ORDER_TYPES.get(c, "string")).alias(c) for c in ORDER])) for s, at in full]
    return _first_open(lambda s: reduce(lambda c, x: c & ((s != x[0]) | (own <= x[1])), points, F.lit(True)))


def _shard_of_part(full: list[tuple[int, Row]]) -> Column:
    """The same for all rows of a part in which no shard became full."""
    return _first_open(lambda s: reduce(lambda c, x: c & ((s != x[0]) | (F.col("part") < x[1]["turn"][:DIGITS])), full, F.lit(True)))


def _next_full(placed: DataFrame, counts: DataFrame, full: list[tuple[int, Row]], room: dict[int, int]) -> tuple[int, Row]:
    """The next shard that becomes full, and the row at which it does."""
    open_ = [s for s in room if s not in {x[0] for x in full}]
    split = sorted({at["turn"][:DIGITS] for _, at in full})
    whole = counts.where(~F.col("part").isin(split)).select(_shard_of_part(full).alias("shard"), "part", "n")
    cut = placed.where(F.col("part").isin(split)).select(_shard_of_row(full).alias("shard"), "part", F.lit(1).cast("long").alias("n"))
    loads = whole.unionByName(cut).groupBy("shard", "part").agg(F.sum("n").alias("n"))  # 8 x 4,096 rows at most
    loads = loads.withColumn("load", F.sum("n").over(Window.partitionBy("shard").orderBy("part")))
    of = lambda values: reduce(lambda c, s: c.when(F.col("shard") == s, values[s]), values, F.when(F.lit(False), 0))
    reached = F.when(F.col("shard").isin(open_) & (F.col("load") >= of(room)), F.col("part"))
    upto = loads.withColumn("hit", F.min(reached).over(Window.partitionBy(F.lit(0)))).where("part <= hit")
    found = upto.groupBy("shard").agg(F.max("hit").alias("hit"), F.sum(F.when(F.col("part") < F.col("hit"), F.col("n"))).alias("n")).collect()  # one for each shard
    part, before = found[0]["hit"], {r["shard"]: r["n"] or 0 for r in found}
    due = {s: room[s] - before.get(s, 0) for s in open_}
    inside = placed.where(F.col("part") == part).withColumn("shard", _shard_of_row(full))
    ranked = inside.withColumn("rank", F.row_number().over(Window.partitionBy("shard").orderBy(*ORDER)))
    at = ranked.where(F.col("shard").isin(open_) & (F.col("rank") == of(due))).orderBy(*ORDER).first()
    return at["shard"], at


def assign(rows: DataFrame, shards: int = SHARDS, points: int = POINTS) -> DataFrame:
    """The light rows with shard and slot."""
    own = F.concat_ws("-", F.coalesce(F.col("key").cast("string"), F.lit("")), "size", "crc", "copy")
    placed = rows.withColumns({"turn": F.md5(F.concat(F.lit("turn:"), own).cast("binary")), "place": _hex(F.concat(F.lit("place:"), F.coalesce(F.col("key").cast("string"), own)), 4)})
    placed = placed.join(F.broadcast(ring(rows.sparkSession, shards, points)), "place").drop("place")  # 65,536 rows at any size
    placed = stash(placed.withColumn("part", F.substring("turn", 1, DIGITS)))
    counts = stash(placed.groupBy("part", "prefers").agg(F.count("*").alias("n")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    room = {s: total // shards + (s < total % shards) for s in range(shards)}
    full = [(s, Row(turn="", key=None, size=None, crc=None, copy=None)) for s in room if not room[s]]
    while len(full) < shards - 1:
        full.append(_next_full(placed, counts, full, room))
    settled = placed.withColumn("shard", _shard_of_row(full))
    sums = settled.groupBy("shard", "part").agg(F.count("*").alias("n"))
    offsets = sums.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("shard", "part").orderBy(*ORDER))
    numbered = settled.withColumn("rank", rank).join(offsets, ["shard", "part"])
    return numbered.select("key", "size", "crc", "copy", "shard", (F.col("offset") + F.col("rank") - 1).alias("slot"))


def shard_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """key, size, crc, copy, shard and slot of every row of docs."""
    return assign(light_rows(docs, key, text), shards)
