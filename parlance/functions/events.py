"""Conditions and small facts of service events, as columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from parlance.functions import worktime

UNTYPED = "__untyped__"
SLA = 1_800
BUCKETS = (60, 300, 900, 1800, 3600, 7200, 14400)


def reply_seconds() -> Column:
    """Work seconds to the first reply; null where there is none."""
    return worktime.between(F.col("first_msg_time"), F.col("first_agent_reply_time"))


def is_merchant() -> Column:
    return F.col("asker_role") == "EXTERNAL"


def is_push() -> Column:
    return F.col("asker_role") == "INTERNAL"


def is_unreplied() -> Column:
    return is_merchant() & F.col("first_agent_reply_time").isNull()


def is_replied() -> Column:
    return is_merchant() & F.col("first_agent_reply_time").isNotNull()


def is_overdue(sla: int = SLA) -> Column:
    """Merchant-started and unanswered, or answered later than sla work seconds; never null."""
    return is_merchant() & F.coalesce(reply_seconds() > sla, F.lit(True))


def is_backlog(last_day: Column) -> Column:
    return is_unreplied() & (F.col("occurred_on") < last_day)


def is_cross_day() -> Column:
    return F.to_date("last_msg_time") != F.col("occurred_on")


def status(sla: int = SLA) -> Column:
    """push, unreplied, overdue or replied: the first that holds."""
    return F.when(is_push(), "push").when(is_unreplied(), "unreplied").when(is_overdue(sla), "overdue").otherwise("replied")


def rate(part: Column, whole: Column) -> Column:
    """part / whole, null where whole is 0 or null."""
    return F.when(whole > 0, part / whole)


def reply_bucket(edges: Sequence[int] = BUCKETS) -> Column:
    """Index of the first edge that the reply seconds do not exceed, else the number of edges."""
    s = F.col("secs")
    return F.coalesce(*[F.when(s <= e, F.lit(i)) for i, e in enumerate(edges)], F.lit(len(edges)))


def group_key(groups: Sequence[Sequence[str]]) -> Column:
    """Position, as text, of the group that holds the event's type; the number of groups for labels in none; null unlabelled."""
    chain = reduce(lambda c, g: c.when(F.col("event_type").isin(list(g[1])), str(g[0])), enumerate(groups), F.when(F.col("event_type").isNull(), None))
    return chain.otherwise(str(len(groups)))


def row_faults() -> Column:
    """Names of the contracts that an event row breaks."""
    rules = {
        "day": F.col("occurred_on") == F.to_date("first_msg_time"),
        "order": F.col("first_msg_time") <= F.col("last_msg_time"),
        "label pair": F.col("event_type").isNull() == F.col("taxonomy_version").isNull(),
        "reply pair": F.col("first_responder").isNull() == F.col("first_agent_reply_time").isNull(),
        "responder": F.col("first_responder").isNull() | F.array_contains("agents", F.col("first_responder")),
        "silent agents": F.col("first_responder").isNotNull() | (F.size("agents") == 0),
    }
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))


def group_day_faults() -> Column:
    """Names of the contracts that a group-day row breaks: failed days hold no event metric, good ones hold the counts."""
    metrics = ["event_count", "merchant_event_count", "unreplied_count", "first_reply_p50_sec", "first_reply_p90_sec"]
    none = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in metrics])
    counts = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in metrics[:3]])
    ok = F.col("extraction_status") == "ok"
    return F.array_compact(F.array(F.when(~ok & ~none, F.lit("failed with metrics")), F.when(ok & ~counts, F.lit("ok without counts"))))
