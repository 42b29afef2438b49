"""Aggregates over trusted events: summary, rooms, agents and categories.

Counts are sums of conditions, and quantiles come from counted seconds (functions/quantile.py): one pass over the events, grouped
by the key and the seconds, gives both.
Distinct counts of a key pair are taken by grouping on the pair first, so no group's members are gathered.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions import events as E
from parlance.functions.quantile import counted, nearest_rank, picked
from parlance.operators.scope import Scope, Tables

Groups = Sequence[Sequence[str]]


def _counts(s: Scope) -> dict:
    return {
        "events": F.count("*"),
        "merchant": F.count_if(E.is_merchant()),
        "replied": F.count_if(E.is_replied()),
        "unreplied": F.count_if(E.is_unreplied()),
        "push": F.count_if(E.is_push()),
        "overdue": F.count_if(E.is_overdue(s.sla)),
        "backlog": F.count_if(E.is_backlog(F.lit(s.until))),
        "cross_day": F.count_if(E.is_cross_day()),
    }


def _picked(s: Scope, *names: str) -> list:
    every = _counts(s)
    return [every[n].alias(n) for n in names]


def _with_quantiles(rows: DataFrame, s: Scope, key: str, *names: str) -> DataFrame:
    every = _counts(s)
    return counted(rows, [key], "secs", {n: every[n] for n in names})


def summary_counts(t: Tables, s: Scope) -> DataFrame:
    per_room = s.trusted(t).groupBy("roomid").agg(*_picked(s, *_counts(s)))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _counts(s)]
    return per_room.agg(F.count("*").alias("rooms"), *sums)


def summary_quantiles(t: Tables, s: Scope) -> DataFrame:
    return nearest_rank(s.trusted(t), [], "secs")


def participation(events: DataFrame) -> DataFrame:
    """Events once for each of their agents, in a column of its own: what is kept to spare every query the same step."""
    return events.drop("source_messages").withColumn("agent", F.explode(F.array_distinct("agents")))


def exploded(t: Tables, s: Scope) -> DataFrame:
    """One row per event and agent, from the kept table where there is one; events without agents have none."""
    if t.participation is not None:
        return s.trusted(replace(t, events=t.participation)).withColumn("owned", F.coalesce(F.col("first_responder") == F.col("agent"), F.lit(False)))
    rows = s.trusted(t).select("id", "corpid", "roomid", "occurred_on", "event_type", "asker_role", "first_msg_time", "first_agent_reply_time", "first_responder", "secs", F.explode(F.array_distinct("agents")).alias("agent"))
    return rows.withColumn("owned", F.coalesce(F.col("first_responder") == F.col("agent"), F.lit(False)))


def summary_agents(t: Tables, s: Scope) -> DataFrame:
    return exploded(t, s).select("agent").distinct().agg(F.count("*").alias("agents"))


def summary_by_day(t: Tables, s: Scope) -> DataFrame:
    return _with_quantiles(s.trusted(t), s, "occurred_on", "events", "merchant", "replied", "unreplied", "overdue")


def summary_by_hour(t: Tables, s: Scope) -> DataFrame:
    return s.trusted(t).groupBy(F.hour("first_msg_time").alias("hour")).agg(*_picked(s, "events", "overdue"))


def reply_buckets(t: Tables, s: Scope, edges: Sequence[int] = E.BUCKETS) -> DataFrame:
    """bucket and n for every bucket, empty ones too."""
    found = s.trusted(t).where("secs is not null").groupBy(E.reply_bucket(edges).alias("bucket")).agg(F.count("*").alias("n"))
    spine = t.events.sparkSession.range(len(edges) + 1).select(F.col("id").cast("int").alias("bucket"))
    return spine.join(found, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def kpi_document(t: Tables, s: Scope, edges: Sequence[int] = E.BUCKETS) -> DataFrame:
    """One row: counts, rates, quantiles, agents, and the days, hours and reply buckets as arrays."""
    gathered = lambda df, key, name: df.agg(F.array_sort(F.collect_list(F.struct(key, *[c for c in df.columns if c != key]))).alias(name))  # noqa: E731  at most 31 days, 24 hours, 33 buckets
    out = summary_counts(t, s).crossJoin(summary_quantiles(t, s)).crossJoin(summary_agents(t, s))
    out = out.crossJoin(gathered(summary_by_day(t, s), "occurred_on", "by_day")).crossJoin(gathered(summary_by_hour(t, s), "hour", "by_hour")).crossJoin(gathered(reply_buckets(t, s, edges), "bucket", "reply_buckets"))
    return out.withColumns({"unreplied_rate": E.rate(F.col("unreplied"), F.col("merchant")), "overdue_rate": E.rate(F.col("overdue"), F.col("merchant"))})


# rooms


def rooms(t: Tables, s: Scope) -> DataFrame:
    out = _with_quantiles(s.trusted(t), s, "roomid", "events", "merchant", "unreplied", "overdue", "backlog")
    return out.withColumns({"unreplied_rate": E.rate(F.col("unreplied"), F.col("merchant")), "overdue_rate": E.rate(F.col("overdue"), F.col("merchant"))})


def room_cells(t: Tables, s: Scope) -> DataFrame:
    return s.trusted(t).groupBy("roomid", "occurred_on").agg(*_picked(s, "events", "unreplied"))


def room_categories(t: Tables, s: Scope) -> DataFrame:
    return s.trusted(t).groupBy("roomid", "event_type").agg(*_picked(s, "events"))


def room_top_groups(t: Tables, s: Scope, groups: Groups, k: int = 4) -> DataFrame:
    """The k most frequent groups of each room; ties go by the group's position as text."""
    counts = s.trusted(t).where("event_type is not null").groupBy("roomid", E.group_key(groups).alias("key")).agg(F.count("*").alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy("roomid").orderBy(F.desc("n"), "key"))).where(F.col("rank") <= k)


def rooms_document(t: Tables, s: Scope, groups: Groups) -> DataFrame:
    """rooms with their day series and top groups."""
    series = room_cells(t, s).groupBy("roomid").agg(F.array_sort(F.collect_list(F.struct("occurred_on", "events"))).alias("series"))
    top = room_top_groups(t, s, groups).groupBy("roomid").agg(F.array_sort(F.collect_list(F.struct("rank", "key", "n"))).alias("top_groups"))
    return rooms(t, s).join(series, "roomid", "left").join(top, "roomid", "left")


def folded(counts: DataFrame, key: str, n: str = "events") -> DataFrame:
    """key, by_type (map of label to count; labels are a closed vocabulary) and unlabelled."""
    entry = F.when(F.col("event_type").isNotNull(), F.struct("event_type", n))
    return counts.groupBy(key).agg(F.map_from_entries(F.array_sort(F.array_compact(F.collect_list(entry)))).alias("by_type"), F.coalesce(F.sum(F.when(F.col("event_type").isNull(), F.col(n))), F.lit(0)).alias("unlabelled"))


# agents: taking part and owning are two attributions


def agents(t: Tables, s: Scope) -> DataFrame:
    rows = exploded(t, s).withColumn("own_secs", F.when(F.col("owned"), F.col("secs")))
    own = F.col("owned") & E.is_merchant()
    counts = {"involved": F.count("*"), "owned": F.count_if("owned"), "merchant_owned": F.count_if(own), "reply_samples": F.count_if(own & F.col("secs").isNotNull()), "overdue": F.count_if(own & E.is_overdue(s.sla))}
    # by room first: a pair's row with the least seconds (or none) counts the room once, whatever else the agent has there
    per = rows.groupBy("agent", "roomid", "own_secs").agg(*[c.alias(n) for n, c in counts.items()])
    once = F.row_number().over(Window.partitionBy("agent", "roomid").orderBy("own_secs")) == 1
    per = per.withColumn("_first", once)
    out = counted(per.withColumn("_times", F.col("reply_samples")), ["agent"], "own_secs", {"rooms": F.count_if("_first")} | {n: F.sum(n) for n in counts}, weight="_times")
    return out.withColumn("overdue_rate", E.rate(F.col("overdue"), F.col("merchant_owned")))


def agent_cells(t: Tables, s: Scope) -> DataFrame:
    return exploded(t, s).groupBy("agent", "occurred_on").agg(F.count("*").alias("involved"), F.count_if("owned").alias("owned"))


def agent_memberships(t: Tables, s: Scope) -> DataFrame:
    return exploded(t, s).select("agent", "roomid").distinct()


def agent_categories(t: Tables, s: Scope) -> DataFrame:
    return exploded(t, s).groupBy("agent", "event_type").agg(F.count("*").alias("events"))


def agents_document(t: Tables, s: Scope) -> DataFrame:
    series = agent_cells(t, s).groupBy("agent").agg(F.array_sort(F.collect_list(F.struct("occurred_on", "involved", "owned"))).alias("series"))
    member = agent_memberships(t, s).groupBy("agent").agg(F.array_sort(F.collect_list("roomid")).alias("room_ids"))
    return agents(t, s).join(series, "agent", "left").join(member, "agent", "left")


# categories


def _keyed(t: Tables, s: Scope, groups: Groups) -> DataFrame:
    return s.trusted(t).where("event_type is not null").withColumn("key", E.group_key(groups))


def categories(t: Tables, s: Scope, groups: Groups) -> DataFrame:
    return _with_quantiles(_keyed(t, s, groups), s, "key", "events", "merchant", "unreplied")


def categories_of_both_levels(t: Tables, s: Scope, types: Groups, parents: Groups) -> DataFrame:
    """level (1: parents, 2: types), key and what categories() gives for each, from one grouping of one scan."""
    every = _counts(s)
    names = ["events", "merchant", "unreplied"]
    rows = s.trusted(t).where("event_type is not null").withColumns({"l1": E.group_key(parents), "l2": E.group_key(types)})
    sets = rows.groupingSets([["l1", "secs"], ["l2", "secs"]], "l1", "l2", "secs")
    per = sets.agg(*[every[n].alias(n) for n in names], F.count("secs").alias("_n"), (F.grouping("l1") + 1).cast("int").alias("level"))
    return picked(per.withColumn("key", F.coalesce("l1", "l2")), ["level", "key"], "secs", names)


def category_cells(t: Tables, s: Scope, groups: Groups) -> DataFrame:
    return _keyed(t, s, groups).groupBy("key", "occurred_on").agg(*_picked(s, "events"))


def categories_document(t: Tables, s: Scope, groups: Groups) -> DataFrame:
    series = category_cells(t, s, groups).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("occurred_on", "events"))).alias("series"))
    return categories(t, s, groups).join(series, "key", "left")
