"""Roll-ups of events by room and day that hold exact histograms of reply seconds, and what can be answered from them.

A roll-up row is a room, a day and an attribution: the room itself, one of its agents or one of its labels. It holds counts and
the reply seconds run-length coded (each distinct value with its number), so rows of any days and rooms merge exactly: numbers of
equal values add up, and nearest-rank quantiles of the sum are those of the events. A row's histogram has at most one entry for
each work second of a day. Overdue events follow from the histogram whatever the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions import events as E
from parlance.functions.quantile import counted
from parlance.operators.aggregates import Groups
from parlance.operators.scope import Scope, Tables, known_ok_days

ROOM_DAY = ["corpid", "roomid", "occurred_on"]
KEYS = [*ROOM_DAY, "kind", "key"]
#: Events of a part that one task makes roll-ups of.
PART = 200_000
COUNTS = ["events", "owned", "merchant", "unreplied", "push", "cross_day"]
SCHEMA = "corpid string, roomid string, occurred_on date, kind string, key string, events bigint, owned bigint, merchant bigint, unreplied bigint, push bigint, cross_day bigint, seconds array<struct<secs:bigint,n:bigint>>"


def day_rolls(events: DataFrame) -> DataFrame:
    """One row for each room and day, and for each agent and label (null: none) of it. Agents own what they answer first.

    merchant, unreplied and seconds of an agent count owned events alone.
    """
    one = lambda kind, key, owned: F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"), owned.alias("own"))
    owns = lambda a: F.coalesce(F.col("first_responder") == a, F.lit(False))
    kinds = F.concat(F.array(one("room", F.lit(None), F.lit(True)), one("type", F.col("event_type"), F.lit(True))), F.transform(F.array_distinct("agents"), lambda a: one("agent", a, owns(a))))
    facts = {"secs": F.when(E.is_merchant(), E.reply_seconds()), "merchant": E.is_merchant(), "unreplied": E.is_unreplied(), "push": E.is_push(), "cross_day": E.is_cross_day()}
    same = events.select(*ROOM_DAY, "event_type", "agents", "first_responder", *[c.alias(n) for n, c in facts.items()])
    same = same.groupBy(*same.columns).agg(F.count("*").alias("times"))  # on the map side first, so a busy room-day has a row for each kind of event
    # room-days are dealt out before events multiply, in parts of bounded size, and stay where they are from then on
    parts = max(events.sparkSession.sparkContext.defaultParallelism, -(-events.count() // PART))
    rows = same.repartition(parts, *ROOM_DAY).select(*ROOM_DAY, "secs", *list(facts)[1:], "times", F.explode(kinds).alias("one")).select("*", "one.*")
    own, total = F.col("own"), lambda c: F.sum(F.when(c, F.col("times")).otherwise(0))
    sums = [F.sum("times").alias("events"), total(own).alias("owned"), *[total(own & F.col(c)).alias(c) for c in ("merchant", "unreplied")], *[total(F.col(c)).alias(c) for c in ("push", "cross_day")]]
    keys = sorted(KEYS, key="roomid".__ne__)  # where grouping sorts, rooms tell rows apart at once, a tenant doesn't
    per = rows.groupBy(*keys, F.when(own, F.col("secs")).alias("secs")).agg(*sums, total(own & F.col("secs").isNotNull()).alias("n"))
    bin_ = F.when(F.col("secs").isNotNull() & (F.col("n") > 0), F.struct("secs", "n"))
    out = per.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in COUNTS], F.array_sort(F.array_compact(F.collect_list(bin_))).alias("seconds"))  # at most a day's work seconds
    return out.select(*KEYS, *COUNTS, "seconds")


def trusted_rolls(rolls: DataFrame, t: Tables, s: Scope, kind: str) -> DataFrame:
    """The roll-ups of known-complete room-days. Filters of single events can't be answered from them."""
    if s.filters.conditions(s.sla, s.until):
        raise ValueError("roll-ups know no single events; only rooms can be filtered")
    ok = s.filters.in_rooms(known_ok_days(t, s), t).select("corpid", "roomid", F.col("dt").alias("occurred_on"))
    return rolls.where(s.days("occurred_on") & (F.col("kind") == kind)).join(ok.hint("shuffle_hash"), ROOM_DAY, "left_semi")


def merged(rolls: DataFrame, s: Scope, keys: list[str], *names: str) -> DataFrame:
    """keys, the named counts, and p50 and p90 of the merged histograms.

    Names are counts of a roll-up, overdue (owned ones past the limit or unanswered), backlog and samples.
    """
    open_ = rolls.select(*keys, *COUNTS, "occurred_on", F.posexplode_outer("seconds").alias("pos", "bin")).select("*", F.col("bin.secs").alias("secs"), F.coalesce("bin.n", F.lit(0)).alias("n"))
    once = lambda c: F.sum(F.when(F.coalesce("pos", F.lit(0)) == 0, c).otherwise(0))
    late = F.sum(F.when(F.col("secs") > s.sla, F.col("n")).otherwise(0))
    every: dict[str, Column] = {c: once(F.col(c)) for c in COUNTS} | {"overdue": late + once(F.col("unreplied")), "backlog": once(F.when(F.col("occurred_on") < F.lit(s.until), F.col("unreplied")).otherwise(0)), "samples": F.sum("n")}
    return counted(open_, keys, "secs", {n: every[n] for n in names}, weight="n")


def summary(rolls: DataFrame, t: Tables, s: Scope) -> DataFrame:
    """The one row of counts and quantiles."""
    return merged(trusted_rolls(rolls, t, s, "room"), s, [], "events", "merchant", "unreplied", "push", "overdue", "backlog", "cross_day")


def rooms(rolls: DataFrame, t: Tables, s: Scope) -> DataFrame:
    out = merged(trusted_rolls(rolls, t, s, "room"), s, ["roomid"], "events", "merchant", "unreplied", "overdue", "backlog")
    return out.withColumns({"unreplied_rate": E.rate(F.col("unreplied"), F.col("merchant")), "overdue_rate": E.rate(F.col("overdue"), F.col("merchant"))})


def agents(rolls: DataFrame, t: Tables, s: Scope) -> DataFrame:
    own = trusted_rolls(rolls, t, s, "agent").withColumnRenamed("key", "agent")
    out = merged(own, s, ["agent"], "events", "owned", "merchant", "samples", "overdue")
    named = {"events": "involved", "merchant": "merchant_owned", "samples": "reply_samples"}
    rooms_ = own.groupBy("agent", "roomid").agg(F.lit(1).alias("_")).groupBy("agent").agg(F.count("*").alias("rooms"))
    return out.withColumnsRenamed(named).join(rooms_, "agent").withColumn("overdue_rate", E.rate(F.col("overdue"), F.col("merchant_owned")))


def categories(rolls: DataFrame, t: Tables, s: Scope, groups: Groups) -> DataFrame:
    own = trusted_rolls(rolls, t, s, "type").where("key is not null").withColumnRenamed("key", "event_type").withColumn("key", E.group_key(groups))
    return merged(own, s, ["key"], "events", "merchant", "unreplied")
