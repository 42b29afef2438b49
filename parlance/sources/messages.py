"""Raw chat messages: newline-delimited JSON, guards, and the clean message table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parlance.functions.text import non_blank
from parlance.schema import schema

ROOM_BYTES = 32 << 20
LOCAL = 8 * 3_600_000
ROLES = ("INTERNAL", "EXTERNAL")


def months(since: date, until: date) -> list[str]:
    """Months yyyyMM that a window touches."""
    first, last = since.year * 12 + since.month - 1, until.year * 12 + until.month - 1
    return [f"{m // 12}{m % 12 + 1:02d}" for m in range(first, last + 1)]


def room_path(root: str, month: str, corp: str, room: str) -> str:
    return f"{root}/{month}/{corp}/{room}.ndjson"


def month_files(index: DataFrame, since: date, until: date) -> DataFrame:
    """Live files of the window's months that may have rows in it; a file that was never appended to stays."""
    live = index.where((F.col("file_status") == 0) & (F.col("is_deleted") == 0) & F.col("file_month").isin(months(since, until)))
    late = F.col("ndjson_last_append_time").isNull() | (F.col("ndjson_last_append_time") >= F.lit(since).cast("timestamp_ntz"))
    return live.where(late).orderBy("corp_id", "official_room_id", "file_month")


def picked(files: DataFrame, rooms: Sequence[str]) -> DataFrame:
    """All months of the named rooms; an error where none is left."""
    out = files.where(F.col("official_room_id").isin(list(rooms))) if rooms else files
    if rooms and not out.take(1):
        raise ValueError("no file of the named rooms")
    return out


def whole_rooms(files: DataFrame, failed: DataFrame) -> DataFrame:
    """files without any month of a room that has a failed one."""
    return files.join(failed, ["corp_id", "official_room_id"], "left_anti")


def rooms_of(spark: SparkSession, root: str, since: date, until: date) -> DataFrame:
    """month, corp and room of the files that a window's months have. A month without folder has none."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.ndjson").option("recursiveFileLookup", "true").load(root).select("path")
    part = lambda i: F.element_at(F.split("path", "/"), i)
    out = found.select(part(-3).alias("month"), part(-2).alias("corp"), F.regexp_replace(part(-1), r"\.ndjson\z", "").alias("room"))
    return out.where(F.col("month").isin(months(since, until)))


def unconfirmed(index: DataFrame, files: DataFrame, since: date, until: date) -> DataFrame:
    """Rooms and months that the index names for the window and that have no file: what a strict read stops at."""
    want = month_files(index, since, until).select(F.col("file_month").alias("month"), F.col("corp_id").alias("corp"), F.col("official_room_id").alias("room"))
    return want.join(files, ["month", "corp", "room"], "left_anti")


def expired_months(spark: SparkSession, root: str, today: date, keep: int) -> list[str]:
    """Folders of months that ended at least `keep` months ago: what retention removes."""
    oldest = today.year * 12 + today.month - 1 - keep
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(n for n in names if n.isdigit() and len(n) == 6 and int(n[:4]) * 12 + int(n[4:]) - 1 < oldest)


def prune_months(spark: SparkSession, root: str, today: date, keep: int) -> list[str]:
    """Remove them; the months that went."""
    gone = expired_months(spark, root, today, keep)
    for month in gone:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{month}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of the paths that are there: a month that was never fetched is no error to a tolerant read."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return [p for p in paths if hadoop(p).getFileSystem(conf).exists(hadoop(p))]


def read_room(spark: SparkSession, root: str, corp: str, room: str, since: date, until: date, strict: bool = True) -> DataFrame:
    """One room's lines of a window. Strict: each of its months must be there; else those that are there."""
    paths = [room_path(root, m, corp, room) for m in months(since, until)]
    there = paths if strict else existing(spark, paths)
    if there:
        return read_raw(spark, there)
    return spark.createDataFrame([], schema("raw_message")).select("*", *[F.lit(None).cast("string").alias(c) for c in ("path_month", "path_corp", "path_room")])


def audited(spark: SparkSession, root: str, index: DataFrame, since: date, until: date) -> DataFrame:
    """corp_id, official_room_id, file_month and fault of local files that aren't what the index says.

    missing: no file (or an empty one, where it should hold something); length: other bytes than the index's position; lines: not whole lines of JSON objects from first byte to last;
    records: another number of lines. A room with a fault is left out as a whole by whole_rooms(); the others go on.
    """
    want = month_files(index, since, until).select("corp_id", "official_room_id", "file_month", "ndjson_position", "ndjson_record_count")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ndjson").option("recursiveFileLookup", "true").load(root)
    part = lambda i: F.element_at(F.split("path", "/"), i)
    text = F.decode("content", "ISO-8859-1")  # a character a byte
    found = files.select(part(-3).alias("file_month"), part(-2).alias("corp_id"), F.regexp_replace(part(-1), r"\.ndjson\z", "").alias("official_room_id"), "length", F.left(text, F.lit(1)).alias("head"), F.right(text, F.lit(1)).alias("tail"), F.regexp_count(text, F.lit("\n")).alias("records"))
    both = want.join(found, ["corp_id", "official_room_id", "file_month"], "left")
    whole = (F.col("length") == 0) | ((F.col("head") == "{") & (F.col("tail") == "\n"))
    fault = F.when(F.col("length").isNull() & (F.col("ndjson_position") > 0), "missing").when(F.col("length") != F.col("ndjson_position"), "length").when(~whole, "lines").when(F.col("records") != F.col("ndjson_record_count"), "records")
    return both.select("corp_id", "official_room_id", "file_month", fault.alias("fault")).where("fault is not null")


def read_raw(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines with the month, tenant and room that their path names. A missing path is an error."""
    raw = spark.read.schema(schema("raw_message")).json(list(paths)).withColumn("_path", F.col("_metadata.file_path"))
    part = lambda i: F.element_at(F.split("_path", "/"), i)
    return raw.select("*", part(-3).alias("path_month"), part(-2).alias("path_corp"), F.regexp_replace(part(-1), r"\.ndjson\z", "").alias("path_room")).drop("_path")


def parsed(raw: DataFrame, since: date, until: date) -> DataFrame:
    """Messages of the window (null times stay) with `fault`: what is wrong with a line, null if nothing is."""
    at = F.timestamp_millis(F.col("messageTime") + LOCAL).cast("timestamp_ntz")
    out = raw.select(
        F.col("sourceMessageId").alias("msg_id"), F.col("officialRoomId").alias("room"), F.col("corpId").alias("corp"), at.alias("at"), F.col("sender.easyUserId").alias("sender_id"),
        F.when(F.col("sender.identityType") == "INTERNAL", non_blank(F.col("sender.officialUserId"))).alias("official_user_id"), F.col("sender.identityType").alias("sender_role"), F.col("standardType").alias("msg_type"),
        F.coalesce(F.nullif("analysisText", F.lit("")), F.col("content")).alias("text"), F.col("semanticPayload.replyTo.sourceMessageId").alias("reply_to"), "schemaVersion", "parserVersion", "path_month", "path_corp", "path_room",
    )
    out = out.where(F.col("at").isNull() | F.to_date("at").between(F.lit(since), F.lit(until)))
    one = lambda c: F.coalesce(F.col(c) == 1, F.lit(False))
    missing = lambda c: F.coalesce(F.col(c) == "", F.lit(True))
    fault = (
        F.when(~(one("schemaVersion") & one("parserVersion")), "version").when(F.col("at").isNull(), "time")
        .when(missing("msg_id") | missing("sender_id") | F.col("text").isNull(), "field").when(~F.coalesce(F.col("sender_role").isin(*ROLES), F.lit(False)), "role")
        .when((F.col("room") != F.col("path_room")) | (F.col("corp") != F.col("path_corp")), "path").when(F.date_format("at", "yyyyMM") != F.col("path_month"), "month")
    )
    return out.withColumn("fault", fault).withColumns({"room": F.col("path_room"), "corp": F.col("path_corp")}).drop("schemaVersion", "parserVersion", "path_month", "path_corp", "path_room")


def room_faults(messages: DataFrame, most_bytes: int = ROOM_BYTES) -> DataFrame:
    """corp, room and reason of rooms that can't be used: a bad line, or more text than one task may hold."""
    per = messages.groupBy("corp", "room").agg(F.min(F.when(F.col("fault") != "time", F.col("fault"))).alias("fault"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"), F.count_if(F.col("fault") == "time").alias("untimed"))
    reason = F.coalesce("fault", F.when(F.col("bytes") > most_bytes, "size"))
    return per.select("corp", "room", reason.alias("reason"), "untimed").where("reason is not null")


def first_of_each(messages: DataFrame) -> DataFrame:
    """One row per room and message id: the first by time, then by contents."""
    order = Window.partitionBy("corp", "room", "msg_id").orderBy("at", F.xxhash64("sender_id", "text"))
    return messages.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def clean(messages: DataFrame, most_bytes: int = ROOM_BYTES) -> DataFrame:
    """Messages of usable rooms, each once. A line of another version stops the whole round."""
    if messages.where("fault = 'version'").take(1):
        raise ValueError("a line of another schema or parser version")
    good = messages.where("fault is null").join(room_faults(messages, most_bytes), ["corp", "room"], "left_anti")
    return first_of_each(good.drop("fault"))
