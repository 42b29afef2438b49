"""Drafts of one room that a reply connects are one event: components of drafts by joins, however long the chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.sources.landing import kept


def connected(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) of every node on an edge (a, b).

    Stars: in turns, every node hands its larger neighbours, then its smaller ones, to the smallest node it knows, until each
    node knows its root alone. That takes few turns, also for chains, as distances to the root shrink to a root of themselves
    or so. A turn is a grouping, reduced before the shuffle, and a join; its edges are written, so a lost executor costs a turn.
    """
    links = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct())
    while True:
        both = links.select(F.col("high").alias("at"), F.col("low").alias("near")).unionByName(links.select(F.col("low").alias("at"), F.col("high").alias("near")))
        least = both.groupBy("at").agg(F.min("near").alias("near")).select("at", F.least("at", "near").alias("least"))
        large = both.where("near > at").join(least, "at").select(F.col("near").alias("high"), F.col("least").alias("low")).distinct()
        own = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(own, "high").select(F.explode(F.array(F.struct(F.col("low").alias("high"), F.col("least").alias("low")), F.struct("high", F.col("least").alias("low")))).alias("e"))
        new = kept(small.select("e.*").where("high <> low").distinct())
        if not new.exceptAll(links).take(1) and not links.exceptAll(new).take(1):
            roots = new.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("root"))
            return roots.unionByName(new.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())
        links = new


def joined_by_replies(drafts: DataFrame, messages: DataFrame) -> DataFrame:
    """drafts (corp, room, event_no, msg_ids, summary, error) with those that a message's reply_to connects put together.

    The draft that holds the earliest message gives number and summary. Replies to messages outside all drafts connect nothing.
    Drafts with an error stay as they are.
    """
    good = drafts.where("error is null")
    draft = F.struct("corp", "room", "event_no")
    member = kept(good.select("corp", "room", F.explode("msg_ids").alias("msg_id"), "event_no", "summary").join(messages.select("corp", "room", "msg_id", "at", "reply_to"), ["corp", "room", "msg_id"], "left"))
    target = member.select("corp", "room", F.col("msg_id").alias("reply_to"), draft.alias("b"))
    edges = member.where("reply_to is not null").select("corp", "room", "reply_to", draft.alias("a")).join(target, ["corp", "room", "reply_to"]).select("a", "b")
    roots = connected(edges).select("node.*", F.col("root.event_no").alias("root"))
    whole = member.join(roots, ["corp", "room", "event_no"], "left").withColumn("root", F.coalesce("root", "event_no"))
    order = F.struct("at", "msg_id", "event_no")
    out = whole.groupBy("corp", "room", "root").agg(F.min_by(F.struct("event_no", "summary"), order).alias("first"), F.transform(F.array_sort(F.collect_set(F.struct("at", "msg_id"))), lambda x: x["msg_id"]).alias("msg_ids"))
    out = out.select("corp", "room", "first.event_no", "msg_ids", "first.summary", F.lit(None).cast("string").alias("error"))
    return out.unionByName(drafts.where("error is not null").select(*out.columns))
