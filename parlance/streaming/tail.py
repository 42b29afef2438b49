"""A stream over growing files: each micro-batch reads the bytes that were added since the last one.

Spark's file stream takes a file once; chat logs are appended to. An offset holds the length of each file that may still grow, so a
restart goes on where the checkpoint says and a batch that is run again reads the same bytes. Lengths come from listing folders:
no file is opened to plan a batch. A slice of a file has the lines whose line break lies in it, so an unfinished last line comes
with the batch that finishes it, and how a file is cut into slices changes nothing.

A slice is checked as a whole: its bytes are all there, and each line is UTF-8 and begins with a brace. One that isn't gives a single
row with a fault and no line. `land` keeps the rows of each batch; `usable` withholds a room from its first fault on, and others go on.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from fnmatch import fnmatchcase

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from parlance.schema import schema

CHUNK = 16 << 20
_BACK = 65_536


class Slice(InputPartition):
    def __init__(self, path: str, start: int, end: int) -> None:
        self.path, self.start, self.end = path, start, end


def resumable(size: int, last: bytes, position: int) -> int:
    """How much of a local copy can stay: all of it, if it is no longer than the original and ends with a line; else nothing."""
    return size if size <= position and (not size or last == b"\n") else 0


def line_start(f, at: int) -> int:  # noqa: ANN001
    """Where the line that byte `at` belongs to begins."""
    while at > 0:
        back = min(at, _BACK)
        k = f.read_at(back, at - back).rfind(b"\n")
        if k >= 0:
            return at - back + k + 1
        at -= back
    return 0


def lines_of(files: fs.FileSystem, part: Slice) -> tuple[list[str], str | None]:
    """The lines whose line break lies in the slice, and what is wrong with it."""
    with files.open_input_file(part.path) as f:
        if part.end < part.start or f.size() < part.end:
            return [], "short"
        body = f.read_at(part.end - part.start, part.start)
        end = body.rfind(b"\n") + 1
        if not end:
            return [], None
        begin = line_start(f, part.start)
        head = f.read_at(part.start - begin, begin)
    try:
        lines = (head + body[:end]).decode().split("\n")[:-1]
    except UnicodeDecodeError:
        return [], "encoding"
    return (lines, None) if all(x.startswith("{") for x in lines) else ([], "lines")


def month_of(path: str) -> str:
    """The month folder of <root>/<yyyyMM>/<tenant>/<room>.ndjson."""
    return path.split("/")[-3] if path.count("/") >= 2 else ""


class TailReader(DataSourceStreamReader):
    """growing: how many of the newest months may still be appended to. Older ones are read once and not listed again; a file that is
    added to one of them later isn't seen. With 0, every file may grow."""

    def __init__(self, pattern: str, chunk: int, growing: int) -> None:
        if chunk < 1 or growing < 0:
            raise ValueError("chunk is at least 1, growing at least 0")
        self.files, self.pattern = fs.FileSystem.from_uri(pattern) if "://" in pattern else (fs.LocalFileSystem(), pattern)
        self.chunk, self.growing, self.settled = chunk, growing, ""
        fixed = self.pattern.split("*")[0].split("?")[0].split("[")[0]
        self.base = fixed.rpartition("/")[0] if fixed != self.pattern else self.pattern.rpartition("/")[0]

    def found(self) -> dict[str, int]:
        """Path and length of the files that match, but for those of months settled before."""
        top = self.files.get_file_info(fs.FileSelector(self.base, allow_not_found=True))
        settled = lambda name: self.settled and len(name) == 6 and name.isdigit() and name <= self.settled
        folders = [x.path for x in top if x.type == fs.FileType.Directory and not settled(x.base_name)]
        every = [*top, *(x for p in folders for x in self.files.get_file_info(fs.FileSelector(p, allow_not_found=True, recursive=True)))]
        return {x.path: x.size for x in sorted(every, key=lambda x: x.path) if x.type == fs.FileType.File and self.matches(x.path)}

    def matches(self, path: str) -> bool:
        """As in a shell, a star doesn't cross folders."""
        parts, wanted = path.split("/"), self.pattern.split("/")
        return len(parts) == len(wanted) and all(map(fnmatchcase, parts, wanted))

    def initialOffset(self) -> dict:
        return {"files": "{}", "settled": ""}

    def latestOffset(self) -> dict:
        found = self.found()
        months = sorted({m for p in found if len(m := month_of(p)) == 6 and m.isdigit()})
        settled = self.settled
        if self.growing and months:
            last = int(months[-1][:4]) * 12 + int(months[-1][4:]) - 1 - self.growing
            settled = max(settled, f"{last // 12}{last % 12 + 1:02d}")
        return {"files": json.dumps(found), "settled": settled}

    def commit(self, end: dict) -> None:
        """A month is left out of the next listing once the batch that settled it is through."""
        self.settled = max(self.settled, end["settled"])

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        """Slices of what was added. A file that became shorter has one slice that ends before it starts, which is a fault."""
        had, has, settled = json.loads(start["files"]), json.loads(end["files"]), start["settled"]
        out = []
        for path, stop in has.items():
            at = had.get(path, 0)
            if settled and len(m := month_of(path)) == 6 and m.isdigit() and m <= settled:
                continue
            if stop < at:
                out.append(Slice(path, at, stop))
            out += [Slice(path, k, min(stop, k + self.chunk)) for k in range(at, stop, self.chunk)]
        return out

    def read(self, part: Slice) -> Iterator[tuple]:
        lines, fault = lines_of(self.files, part)
        if fault:
            yield (part.path, None, part.start, part.end, fault)
        for line in lines:
            yield (part.path, line, part.start, part.end, None)


class Tail(DataSource):
    """spark.readStream.format("tail").option("path", "<glob or URI with one, in a folder that all executors reach>")"""

    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return "path string, value string, start long, end long, fault string"

    def streamReader(self, schema: StructType) -> TailReader:  # noqa: ARG002
        return TailReader(self.options["path"], int(self.options.get("chunk", CHUNK)), int(self.options.get("growing", 0)))


def tailed(spark: SparkSession, pattern: str, **options: int) -> DataFrame:
    """The stream of lines and faults. options: chunk, growing."""
    spark.dataSource.register(Tail)
    return spark.readStream.format("tail").option("path", pattern).options(**options).load()


def _part(i: int) -> Column:
    return F.element_at(F.split("path", "/"), i)


def messages_of(lines: DataFrame) -> DataFrame:
    """Raw messages with the month, tenant and room of their path. lines: path, value."""
    return lines.select(F.from_json("value", schema("raw_message")).alias("m"), _part(-3).alias("path_month"), _part(-2).alias("path_corp"), F.regexp_replace(_part(-1), r"\.ndjson\z", "").alias("path_room")).select("m.*", "path_month", "path_corp", "path_room")


def raw_messages(spark: SparkSession, pattern: str, **options: int) -> DataFrame:
    """The stream of raw messages. A damaged slice ends the stream with an error; `land` lets other rooms go on."""
    stop = F.raise_error(F.concat(F.lit("damaged: "), "fault", F.lit(" in "), "path")).cast("boolean")
    return messages_of(tailed(spark, pattern, **options).where(F.when(F.col("fault").isNull(), F.lit(True)).otherwise(stop)))


def land(spark: SparkSession, pattern: str, out: str, checkpoint: str, **options: int) -> StreamingQuery:
    """Start writing what is there now under `out`, a folder for each batch, which a batch that is run again replaces."""

    def keep(rows: DataFrame, n: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={n}")

    return tailed(spark, pattern, **options).writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def landed(spark: SparkSession, out: str) -> DataFrame:
    """What `land` wrote, with the number of its batch."""
    rows = StructType.fromDDL(f"{Tail({}).schema()}, batch long")
    return spark.read.schema(rows).option("basePath", out).parquet(out).withColumns({"corp": _part(-2), "room": F.regexp_replace(_part(-1), r"\.ndjson\z", "")})


def stopped(rows: DataFrame) -> DataFrame:
    """corp, room, since and faults of rooms with a damaged slice: the first batch that has one and all that is wrong. rows: of landed()."""
    return rows.where("fault is not null").groupBy("corp", "room").agg(F.min("batch").alias("since"), F.array_sort(F.collect_set("fault")).alias("faults"))


def usable(rows: DataFrame) -> DataFrame:
    """Lines of all rooms, of a stopped one those of earlier batches. rows: of landed()."""
    return rows.where("fault is null").join(stopped(rows).drop("faults"), ["corp", "room"], "left").where("since is null or batch < since").drop("since", "fault")


def chunk_records(rows: DataFrame) -> DataFrame:
    """Each slice that has lines or a fault: its lines and bytes of text, line breaks included. rows: of landed()."""
    return rows.groupBy("path", "start", "end", "batch").agg(F.count("value").alias("lines"), F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0)).alias("bytes"), F.max("fault").alias("fault"))


def once(messages: DataFrame, lateness: str = "3 days") -> DataFrame:
    """Each message once, as long as its copies come within the lateness bound. messages: columns of message."""
    timed = messages.withColumn("at", F.col("at").cast("timestamp")).withWatermark("at", lateness)
    return timed.dropDuplicatesWithinWatermark(["corp", "room", "msg_id"])


def hourly_counts(messages: DataFrame, lateness: str = "3 days") -> DataFrame:
    """Messages per room and hour, final once the watermark has passed."""
    timed = messages.withColumn("at", F.col("at").cast("timestamp")).withWatermark("at", lateness)
    return timed.groupBy("corp", "room", F.window("at", "1 hour")).agg(F.count("*").alias("n"))
