"""The engine's tables made from generic ones: an event stream, chat turns and documents. Whole-number arithmetic only."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.events import UNTYPED
from parlance.operators.aggregates import participation
from parlance.operators.dayroll import day_rolls
from parlance.operators.scope import Tables
from parlance.sources.landing import landed

CORP, SINCE, DAYS = "C1", date(2024, 1, 1), 30
VERSION = "v1"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _seconds(t, n):  # noqa: ANN001, ANN202
    return t + F.make_dt_interval(secs=n)


def _text(*parts) -> Column:  # noqa: ANN002
    return F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return e.withColumn("first_msg_time", F.date_trunc("second", F.col("ts").cast("timestamp")).cast("timestamp_ntz"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _raw(spark, sf_dir)
    reply = F.when(F.col("event_type") == "signup", F.col("first_msg_time")).when(F.col("k") % 7 != 0, _seconds(F.col("first_msg_time"), F.floor(F.col("value") * 60)))
    e = e.withColumns({"first_agent_reply_time": reply, "asker_role": F.when(F.col("event_type") == "signup", "INTERNAL").otherwise("EXTERNAL")})
    late = _seconds(F.col("first_msg_time"), (F.col("k") % 11) * 3600)
    name = lambda n: F.concat(F.lit("A"), (n % 12).cast("string"))
    agents = F.when(F.col("first_agent_reply_time").isNull(), F.array().cast("array<string>")).when(F.col("k") % 3 == 0, F.array(name(F.col("k")), name(F.col("k") + 5))).otherwise(F.array(name(F.col("k"))))
    label = F.when(F.col("k") % 17 == 0, None).when(F.col("k") % 13 == 0, UNTYPED).otherwise(F.concat(F.lit("t"), (F.col("k") % 9).cast("string")))
    e = e.withColumns({
        "last_msg_time": F.greatest("first_agent_reply_time", late), "agents": agents, "label": label,
        "summary": F.concat(F.when(F.col("k") % 10 == 0, "Refund 50%_off ").otherwise("topic "), (F.col("k") % 25).cast("string")),
    })
    return e.select(
        F.col("event_id").alias("id"), F.lit(CORP).alias("corpid"), _text("R", F.col("user_id")).alias("roomid"), "first_msg_time", "last_msg_time", "first_agent_reply_time",
        F.to_date("first_msg_time").alias("occurred_on"), "asker_role", "agents", F.get("agents", F.lit(0)).alias("first_responder"), "summary", F.when(F.col("k") % 2 == 0, "EXTERNAL").otherwise("INTERNAL").alias("last_msg_role"),
        F.when(F.col("k") % 23 != 0, (F.col("k") % 4) * 600).alias("followup_wait_max_sec"), F.col("label").alias("event_type"), F.when(F.col("label").isNotNull(), F.when(F.col("k") % 19 == 0, "v0").otherwise(VERSION)).alias("taxonomy_version"),
        F.when(F.col("k") % 5 != 0, F.array(F.struct(_text("m", F.col("event_id")).alias("msg_id"), F.col("first_msg_time").cast("string").alias("at"), _text("c", F.col("user_id")).alias("sender_id"), F.col("asker_role").alias("sender_role"), F.col("summary").alias("text")))).alias("source_messages"),
    )


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rooms and days with events: their counts, and numbers k and h that say what became of each."""
    asked = F.col("event_type") != "signup"
    c = _raw(spark, sf_dir).groupBy(_text("R", F.col("user_id")).alias("roomid"), F.to_date("first_msg_time").alias("dt")).agg(
        F.count("*").alias("n"), F.sum("k").alias("k"), F.count_if(asked).alias("asked"), F.count_if(asked & (F.col("k") % 7 == 0)).alias("open"))
    return c.withColumns({"h": F.col("k") % 11, "day_start": F.col("dt").cast("timestamp_ntz")})


def group_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _cells(spark, sf_dir).where("k % 29 <> 0")
    ok = lambda x: F.when(F.col("h") != 0, F.col(x))
    return c.select(
        F.lit(CORP).alias("corpid"), "roomid", "dt", (F.col("n") * 3 + F.col("h")).alias("msg_count"), (2 + F.col("h") % 4).alias("sender_count"), ok("n").alias("event_count"), ok("asked").alias("merchant_event_count"), ok("open").alias("unreplied_count"),
        F.when(F.col("h") != 0, "ok").otherwise("failed").alias("extraction_status"), F.when(F.col("h") == 3, "pending").when(F.col("h").isin(0, 4), "failed").otherwise("ok").alias("classification_status"),
        F.create_map(_text("A", F.col("k") % 12), _text("acct", F.col("h"))).alias("agent_accounts"), F.when(~F.col("h").isin(0, 5), _seconds(F.col("day_start"), F.lit(183_600))).alias("fact_completed_time"),
    )


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Room-days whose run failed; a window is two to five days. A few old failures have no window."""
    c = _cells(spark, sf_dir).where(F.col("h").isin(0, 4, 5, 6, 7))
    hours = F.when(F.col("h") == 7, 36).when(F.col("h") == 6, 96).otherwise(72)
    until = F.expr("date_add(dt, cast(1 + k % 4 as int))")
    dated = c.select(F.date_add("dt", 2).alias("run_date"), F.lit(CORP).alias("corpid"), "roomid", F.when(F.col("h") == 4, "labels").otherwise("model").alias("reason"), F.when(F.col("h") == 4, "classify").otherwise("extract").alias("stage"), F.col("dt").alias("window_since"), until.alias("window_until"), _seconds(F.col("day_start"), hours * 3600).alias("gmt_created_time"))
    legacy = c.where("day(dt) = 9 and h = 7").select(F.col("dt").alias("run_date"), F.lit(CORP).alias("corpid"), "roomid", F.lit("model").alias("reason"), F.lit("extract").alias("stage"), F.lit(None).cast("date").alias("window_since"), F.lit(None).cast("date").alias("window_until"), F.col("day_start").alias("gmt_created_time"))
    return dated.unionByName(legacy)


def room_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A room for each customer, eight to a merchant; a tenth belong to none."""
    c = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(F.lit(CORP).alias("corp_id"), _text("R", c).alias("official_room_id"), _text("Room ", c).alias("group_name"), F.when(c % 10 != 9, c - c % 8).cast("decimal(20,0)").alias("merchant_id"), (c % 13 == 0).cast("int").alias("is_deleted"))


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers, by their nation's region."""
    c = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    manager = F.when(F.col("c_custkey") != 5, F.concat(F.lit("manager "), (F.col("c_custkey") % 3).cast("string")))
    return c.select(F.col("c_custkey").cast("decimal(20,0)").alias("merchant_id"), F.col("c_name").alias("merchant_name"), F.concat(F.lit("G"), F.col("n_regionkey").cast("string")).alias("merchant_group_config_name"), (100 + F.col("c_custkey") % 3).cast("decimal(20,0)").alias("business_manager_id"), manager.alias("business_manager_name"))


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine labels, those that events bear, from the parts' numbers."""
    i = F.col("i")
    return read(spark, sf_dir, "part").select((F.col("p_partkey") % 9).alias("i")).distinct().select(F.lit(VERSION).alias("version"), _text("t", i).alias("type_id"), _text("P", i % 3).alias("parent_name"), _text("Type ", i).alias("name"), _text("what is of type ", i).alias("description"))


MAKE = {"events": events, "group_days": group_days, "failures": failures, "room_config": room_config, "merchants": merchants, "taxonomy": taxonomy}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The engine's tables, landed as parquet once for each application and source folder."""
    return Tables(**{name: landed(spark, f"{sf_dir}/{name}", lambda make=make: make(spark, sf_dir)) for name, make in MAKE.items()})


def rolls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll-ups of the landed events, landed too."""
    return landed(spark, f"{sf_dir}/rolls", lambda: day_rolls(tables(spark, sf_dir).events))


def with_participation(spark: SparkSession, sf_dir: str) -> Tables:
    t = tables(spark, sf_dir)
    return replace(t, participation=landed(spark, f"{sf_dir}/participation", lambda: participation(t.events)))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat turns as messages; all but users speak for the platform."""
    c = read(spark, sf_dir, "conversations")
    t = lambda n: F.concat(F.col("conv_id").cast("string"), F.lit("-"), n.cast("string"))
    at = _seconds(F.lit("2024-01-01 08:00:00").cast("timestamp_ntz"), (F.col("conv_id") * 97 + F.col("turn") * 613) % 2_500_000)
    inside = ~F.col("role").eqNullSafe("user")
    return c.select(
        t(F.col("turn")).alias("msg_id"), _text("R", F.floor(F.col("conv_id") / 25)).alias("room"), F.lit(CORP).alias("corp"), at.alias("at"),
        F.when(inside, F.concat(F.lit("A"), (F.col("conv_id") % 7).cast("string"))).otherwise(F.concat(F.lit("c"), (F.col("conv_id") % 50).cast("string"))).alias("sender_id"), F.when(inside, F.concat(F.lit("acct"), (F.col("conv_id") % 7).cast("string"))).alias("official_user_id"),
        F.when(inside, "INTERNAL").otherwise("EXTERNAL").alias("sender_role"), F.lit("TEXT").alias("msg_type"), F.coalesce("text", F.lit("")).alias("text"), F.when(F.col("turn") % 3 == 2, t(F.col("turn") - 1)).alias("reply_to"),
    )


def chat_drafts(messages: DataFrame) -> DataFrame:
    """One draft per conversation."""
    return messages.groupBy("corp", "room", F.substring_index("msg_id", "-", 1).cast("int").alias("event_no")).agg(F.array_sort(F.collect_list("msg_id")).alias("msg_ids")).select("corp", "room", "event_no", "msg_ids", F.concat(F.lit("conversation "), F.col("event_no").cast("string")).alias("summary"), F.lit(None).cast("string").alias("error"))
