"""Operator 7, WARC: a content-addressed archive. Native.

Three tables make an archive. `payloads` keeps each payload's bytes once under its SHA-256. `first` and `heads` keep the exact
header bytes (WARC and HTTP header) of every record with that digest: `first` those of records that own a payload of at least
`floor` bytes, `heads` all others. Payloads are shuffled once, when they are written, by digest into buckets, after copies on the
map side are dropped. `payloads` and `first` are bucketed by digest, so original records come back by a join
that moves nothing. There are at most as many buckets as Spark allows; beyond that they grow with the archive. The other responses have short payloads; they come back by
a join of those, which Spark splits where one of them is very frequent. Revisits are headers alone.

A payload is verified against its digest, and a record's lengths against its headers, when they are read; the job stops where
they differ.

Of records with equal payloads of at least `floor` bytes, the one with the smallest key is a response, the others are
revisits that refer to it. Smaller ones are all responses.

Edge cases: a null body is an empty payload; a null URL is empty, and odd characters of one are written percent-encoded.
Repeated rows (one key twice) with the smallest key are all responses. Records without key have no WARC-Record-ID; they are
revisits where a record with a key has their payload, else responses. Extra columns are ignored. An empty table gives an
archive of empty tables.
"""

from __future__ import annotations

import uuid
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm.common import shared_dir, stash

FLOOR = 100
CRLF = "\r\n"
EPOCH = "1970-01-01T00:00:00Z"
#: Bytes of payloads in a bucket of the archive, about.
BUCKET = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), key.cast("string"), F.lit(">"))


def head(kind: Column, key: Column, url: Column, digest: Column, size: Column, refers_to: Column) -> Column:
    """The header bytes of a record: WARC header, empty line, HTTP header, empty line."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size.cast("string"), F.lit(CRLF * 2))
    block = F.octet_length(http) + F.when(kind == "response", size).otherwise(F.lit(0))
    target = F.coalesce(url, F.lit(""))
    for c, code in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A"), (" ", "%20")):
        target = F.replace(target, F.lit(c), F.lit(code))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record_id(key)),
        F.when(kind == "revisit", F.concat(F.lit("WARC-Refers-To: "), record_id(refers_to), F.lit(f"{CRLF}WARC-Profile: {PROFILE}"))),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.lit(f"WARC-Date: {EPOCH}"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), digest),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    ]
    return F.encode(F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), http), "UTF-8")


def write_archive(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html", floor: int = FLOOR, bucket: int = BUCKET) -> None:
    """Write `path`/payloads, `path`/first, `path`/heads, and `path`/layout with the number of buckets."""
    payload = F.encode(F.coalesce(F.col(body), F.lit("")), "UTF-8")
    full = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), payload.alias("payload"))
    full = full.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    records = stash(full.select("key", "url", "digest", "size"))
    most = int(pages.sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    n = max(1, min(most, ceil((records.agg(F.sum("size")).first()[0] or 0) / bucket)))
    records.sparkSession.range(n, n + 1).write.parquet(f"{path}/layout")

    # only digests with copies go to the join; a hot one meets it as small rows, which Spark splits where they are many
    copies = stash(records.groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("copies")).where("copies > 1").select("digest", "first"))
    known = records.join(copies, "digest", "left")
    revisit = (F.col("size") >= floor) & F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("key"))
    known = known.withColumn("kind", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")))
    known = known.withColumn("refers_to", F.when(F.col("kind") == "revisit", F.col("first")))
    written = known.select("digest", head(*[F.col(c) for c in ("kind", "key", "url", "digest", "size", "refers_to")]).alias("head"), "kind", "size")
    written = stash(written.withColumn("owns", (F.col("kind") == "response") & (F.col("size") >= floor)))
    written.where("not owns").select("digest", "head").write.parquet(f"{path}/heads")
    _write_bucketed(written.where("owns").select("digest", "head").repartition(n, "digest"), f"{path}/first", n)
    # the grouping's own shuffle has a partition for each bucket, so payloads need no second one
    conf, setting = pages.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(setting)
    conf.set(setting, str(n))
    try:
        _write_bucketed(full.groupBy("digest").agg(F.min("payload").alias("payload")), f"{path}/payloads", n)
    finally:
        conf.set(setting, before)


def _write_bucketed(df: DataFrame, path: str, n: int) -> None:
    name = f"parlance_{uuid.uuid4().hex}"
    df.write.bucketBy(n, "digest").sortBy("digest").format("parquet").option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # it is external: its files stay


def _read_bucketed(spark: SparkSession, path: str, column: str, n: int) -> DataFrame:
    """The table as one that Spark knows the buckets of."""
    name = f"parlance_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (digest STRING, {column} BINARY) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {n} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def read_archive(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """first, heads and payloads; payloads are verified: one that isn't its digest's stops the job."""
    n = spark.read.parquet(f"{path}/layout").first()[0]
    good = F.sha2("payload", 256) == F.col("digest")
    checked = F.when(good, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload isn't that of digest "), F.col("digest"))).cast("binary"))
    payloads = _read_bucketed(spark, f"{path}/payloads", "payload", n).select("digest", checked.alias("payload"))
    heads = spark.read.schema("digest string, head binary").parquet(f"{path}/heads")
    return _read_bucketed(spark, f"{path}/first", "head", n), heads, payloads


def _field(head: Column, name: str, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(head, rf"\r\n{name}: {pattern}\r\n", 1), F.lit(""))


def reconstruct(spark: SparkSession, path: str, floor: int = FLOOR) -> DataFrame:
    """record: the exact bytes of each original WARC record."""
    first, heads, payloads = read_archive(spark, path)
    end = F.encode(F.lit(CRLF * 2), "UTF-8")
    whole = F.concat("head", "payload", end).alias("record")
    kind = _field(F.col("head").cast("string"), "WARC-Type", "([a-z]+)")
    short = payloads.where(F.octet_length("payload") < floor)
    # an owner of a payload is the only one of its digest, but for repeated rows, so its bucket holds no hot digest
    owners = first.join(payloads.hint("merge"), "digest").select(whole)
    small = heads.where(kind == "response").join(short, "digest").select(whole)
    return owners.unionByName(small).unionByName(heads.where(kind == "revisit").select(F.concat("head", end).alias("record")))


def parse(records: DataFrame) -> DataFrame:
    """kind, key, refers_to, digest, size and payload (null for revisits) of records; one whose lengths aren't those of its headers stops the job."""
    text = F.substring_index(F.col("record").cast("string"), CRLF * 2, 2)
    rows = records.select("record", F.substring_index(text, CRLF * 2, 1).alias("warc"), (F.octet_length(text) + 4).alias("head"))
    rows = rows.select("record", "warc", "head", F.concat(F.substring_index(F.decode(F.substring(F.col("record"), F.lit(1), F.col("head")), "UTF-8"), CRLF * 2, -2), F.lit("")).alias("http"))
    warc = F.concat("warc", F.lit(CRLF))
    rows = rows.select("record", "warc", "head", _field(warc, "WARC-Type", "([a-z]+)").alias("kind"), _field(warc, "Content-Length", "(\\d+)").cast("long").alias("block"), F.regexp_extract("http", r"\r\nContent-Length: (\d+)", 1).cast("long").alias("size"), warc.alias("w"))
    response = F.col("kind") == "response"
    in_block = F.octet_length("record") - F.octet_length("warc") - 8  # the empty lines after the header and after the block
    fits = (in_block == F.col("block")) & (~response | (F.octet_length("record") - F.col("head") - 4 == F.col("size")))
    payload = F.when(response, F.substring(F.col("record"), F.col("head") + 1, F.col("size").cast("int")))
    payload = F.when(fits, payload).otherwise(F.raise_error(F.concat(F.lit("a record's lengths aren't those of its headers: "), F.col("warc"))).cast("binary"))
    page = lambda name: _field(F.col("w"), name, "<urn:page:([^>]*)>").cast("long")
    return rows.select("kind", page("WARC-Record-ID").alias("key"), page("WARC-Refers-To").alias("refers_to"), _field(F.col("w"), "WARC-Payload-Digest", "sha256:([0-9a-f]{64})").alias("digest"), "size", payload.alias("payload"))


def archive_pages(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", floor: int = FLOOR) -> DataFrame:
    """Write pages to a new archive in the shared folder, rebuild its records and read them: one row per record.

    Size and digest are those of the payload of the rebuilt record; of a revisit, which has none, those that its headers state.
    """
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(pages, path, key, url, body, floor)
    out = parse(reconstruct(spark, path, floor))
    size = F.coalesce(F.octet_length("payload").cast("long"), F.col("size"))
    digest = F.coalesce(F.sha2("payload", 256), F.col("digest"))
    return out.select(F.col("key").alias(key), size.alias("payload_bytes"), digest.alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")
