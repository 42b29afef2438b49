"""What users write SQL against: the engine's tables as views, and its definitions as SQL functions of the session."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import SparkSession

from parlance.functions.events import BUCKETS, SLA
from parlance.functions.worktime import CLOSES, DAY, OPENS
from parlance.operators.scope import Tables

_OF_DAY = "hour({t}) * 3600 + minute({t}) * 60 + cast(second({t}) as int)"
_ELAPSED = "(cast(datediff({t}, date '1970-01-01') as bigint) * {day} + least(greatest(" + _OF_DAY + ", {opens}), {closes}) - {opens})"


def _elapsed(t: str) -> str:
    return _ELAPSED.format(t=t, day=DAY, opens=OPENS, closes=CLOSES)


_BUCKET = "CASE " + " ".join(f"WHEN secs <= {edge} THEN {i}" for i, edge in enumerate(BUCKETS)) + f" WHEN secs IS NOT NULL THEN {len(BUCKETS)} END"

#: Name and signature, result, body.
FUNCTIONS = {
    "work_seconds(started TIMESTAMP_NTZ, ended TIMESTAMP_NTZ)": ("BIGINT", f"CASE WHEN started IS NOT NULL AND ended IS NOT NULL THEN greatest(0, {_elapsed('ended')} - {_elapsed('started')}) END"),
    "is_overdue(asker_role STRING, started TIMESTAMP_NTZ, replied TIMESTAMP_NTZ, sla INT)": ("BOOLEAN", "asker_role = 'EXTERNAL' AND coalesce(work_seconds(started, replied) > sla, true)"),
    "reply_bucket(secs BIGINT)": ("INT", _BUCKET),
    "nearest_rank(counted ARRAY<STRUCT<v: BIGINT, n: BIGINT>>, p DOUBLE)": (
        "BIGINT",
        "aggregate(array_sort(counted), struct(0L AS seen, CAST(NULL AS BIGINT) AS v), (a, x) -> struct(a.seen + x.n AS seen, "
        "CASE WHEN a.v IS NULL AND a.seen + x.n >= least(aggregate(counted, 0L, (b, y) -> b + y.n), floor(aggregate(counted, 0L, (b, y) -> b + y.n) * p) + 1) THEN x.v ELSE a.v END AS v), a -> a.v)",
    ),
}

TABLE_FUNCTIONS = {
    "known_ok_days(corp STRING, since DATE, until DATE)": (
        "corpid STRING, roomid STRING, dt DATE",
        """SELECT g.corpid, g.roomid, g.dt FROM group_days g
           LEFT ANTI JOIN (SELECT corpid, roomid, window_since, window_until, max(gmt_created_time) AS failed_at FROM failures WHERE stage = 'extract' GROUP BY ALL) f
             ON f.corpid = g.corpid AND f.roomid = g.roomid AND (f.window_since IS NULL OR g.dt BETWEEN f.window_since AND f.window_until) AND f.failed_at >= g.fact_completed_time
           WHERE g.corpid = corp AND g.dt BETWEEN since AND until AND g.fact_completed_time IS NOT NULL""",
    ),
    "trusted_events(corp STRING, since DATE, until DATE)": (
        "id BIGINT, roomid STRING, occurred_on DATE, first_msg_time TIMESTAMP_NTZ, last_msg_time TIMESTAMP_NTZ, first_agent_reply_time TIMESTAMP_NTZ, asker_role STRING, agents ARRAY<STRING>, first_responder STRING, event_type STRING, summary STRING, secs BIGINT",
        """SELECT e.id, e.roomid, e.occurred_on, e.first_msg_time, e.last_msg_time, e.first_agent_reply_time, e.asker_role, e.agents, e.first_responder, e.event_type, e.summary,
             CASE WHEN e.asker_role = 'EXTERNAL' THEN work_seconds(e.first_msg_time, e.first_agent_reply_time) END
           FROM events e LEFT SEMI JOIN known_ok_days(corp, since, until) k ON k.corpid = e.corpid AND k.roomid = e.roomid AND k.dt = e.occurred_on
           WHERE e.corpid = corp AND e.occurred_on BETWEEN since AND until""",
    ),
}

KPI = f"""
WITH t AS (SELECT * FROM trusted_events(:corp, :since, :until)),
counted AS (SELECT secs AS v, count(*) AS n FROM t WHERE secs IS NOT NULL GROUP BY secs),
ranks AS (SELECT nearest_rank(collect_list(struct(v, n)), 0.5) AS p50, nearest_rank(collect_list(struct(v, n)), 0.9) AS p90 FROM counted)
SELECT count(DISTINCT roomid) AS rooms, count(*) AS events, count_if(asker_role = 'EXTERNAL') AS merchant, count_if(asker_role = 'EXTERNAL' AND first_agent_reply_time IS NULL) AS unreplied,
  count_if(is_overdue(asker_role, first_msg_time, first_agent_reply_time, {SLA})) AS overdue, any_value(p50) AS p50, any_value(p90) AS p90
FROM t CROSS JOIN ranks
"""


def register(spark: SparkSession, t: Tables) -> None:
    """Views of the tables' names, and the functions, in this session. Registering again replaces them."""
    for f in fields(t):
        if (frame := getattr(t, f.name)) is not None:
            frame.createOrReplaceTempView(f.name)
    for name, (result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} RETURNS {result} RETURN {body}")
    for name, (result, body) in TABLE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} RETURNS TABLE({result}) RETURN {body}")
