"""Daily metric rows from messages and events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.functions import events as E
from parlance.functions.quantile import nearest_rank


def message_counts(messages: DataFrame) -> DataFrame:
    """Per room and day: messages and distinct senders."""
    per = messages.groupBy("corp", "room", F.to_date("at").alias("dt"), "sender_id").agg(F.count("*").alias("n"))
    return per.groupBy("corp", "room", "dt").agg(F.sum("n").alias("msg_count"), F.count("*").alias("sender_count"))


def agent_message_rows(messages: DataFrame) -> DataFrame:
    rows = messages.where("sender_role = 'INTERNAL'")
    return rows.groupBy(F.col("corp").alias("corpid"), "room", F.col("sender_id").alias("agent"), F.to_date("at").alias("dt")).agg(F.count("*").alias("msg_count"))


def account_map(messages: DataFrame) -> DataFrame:
    """Per room: agent to the account of their latest message that has one."""
    last = messages.where("sender_role = 'INTERNAL' and official_user_id is not null").groupBy("corp", "room", "sender_id").agg(F.max_by("official_user_id", F.struct("at", "msg_id")).alias("account"))
    return last.groupBy("corp", "room").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("sender_id", "account")))).alias("agent_accounts"))


def group_rows(messages: DataFrame, events: DataFrame, failed_rooms: DataFrame, since: date, until: date) -> DataFrame:
    """One row per day of the window for each room that has messages. failed_rooms: corp, room whose extraction failed.

    Messages and senders always count. Event metrics are null where extraction failed, and 0 on good days without events.
    """
    rooms = messages.select("corp", "room").distinct()
    spine = rooms.select("corp", "room", F.explode(F.sequence(F.lit(since), F.lit(until))).alias("dt"))
    failed = failed_rooms.select("corp", "room").distinct().withColumn("failed", F.lit(True))
    ev = events.select(F.col("corpid").alias("corp"), F.col("roomid").alias("room"), F.col("occurred_on").alias("dt"), "asker_role", "first_agent_reply_time", F.when(E.is_merchant(), E.reply_seconds()).alias("secs"))
    keys = ["corp", "room", "dt"]
    counts = ev.groupBy(*keys).agg(F.count("*").alias("event_count"), F.count_if(E.is_merchant()).alias("merchant_event_count"), F.count_if(E.is_unreplied()).alias("unreplied_count"))
    out = spine.join(message_counts(messages), keys, "left").join(failed, ["corp", "room"], "left").join(counts, keys, "left").join(nearest_rank(ev, keys, "secs"), keys, "left")
    ok = F.col("failed").isNull()
    whole = lambda c: F.coalesce(c, F.lit(0)).cast("int").alias(c)
    return out.select(
        F.col("corp").alias("corpid"), F.col("room").alias("roomid"), "dt", whole("msg_count"), whole("sender_count"),
        *[F.when(ok, F.coalesce(c, F.lit(0))).cast("int").alias(c) for c in ("event_count", "merchant_event_count", "unreplied_count")],
        *[F.when(ok, F.col(c)).cast("int").alias(f"first_reply_{c}_sec") for c in ("p50", "p90")],
        F.when(ok, "ok").otherwise("failed").alias("extraction_status"), F.when(ok, "pending").otherwise("failed").alias("classification_status"),
    )


def agent_rows(events: DataFrame, owners_only: bool = True) -> DataFrame:
    """Per agent, day and label: events whose first responder the agent is, or in which the agent takes part."""
    agent = F.explode(F.array_compact(F.array("first_responder")) if owners_only else F.array_distinct("agents"))
    rows = events.select("corpid", F.col("roomid").alias("room"), agent.alias("agent"), F.col("occurred_on").alias("dt"), "event_type", "taxonomy_version")
    return rows.groupBy("corpid", "room", "agent", "dt", "event_type", "taxonomy_version").agg(F.count("*").alias("event_count"))


def with_accounts(agent_day: DataFrame, accounts: DataFrame) -> DataFrame:
    """agent_day with official_user_id. accounts: corp, room, agent_accounts."""
    known = accounts.select(F.col("corp").alias("corpid"), "room", F.explode("agent_accounts").alias("agent", "official_user_id"))
    return agent_day.join(known, ["corpid", "room", "agent"], "left")
