"""Which event rows a question is about: its days, the known-complete boundary and the filters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions import events as E
from parlance.operators.intervals import latest_covering


@dataclass(frozen=True)
class Tables:
    """The frames that queries read."""

    events: DataFrame
    group_days: DataFrame
    failures: DataFrame
    room_config: DataFrame
    merchants: DataFrame
    taxonomy: DataFrame
    participation: DataFrame | None = None  # events by agent, where they are kept


@dataclass(frozen=True)
class Filters:
    """Conjunction of optional conditions; what is None, blank or an unknown status adds nothing."""

    rooms: Sequence[str] = ()
    merchant_group: str | None = None
    manager_id: int | None = None
    agent: str | None = None
    responder: str | None = None
    types: Sequence[str] = ()
    types_exclude: Sequence[str] = ()
    status: str | None = None
    overdue: bool | None = None
    q: str | None = None

    @staticmethod
    def listed(value: str | None) -> list[str]:
        return [x.strip() for x in (value or "").split(",") if x.strip()]

    @property
    def narrows_rooms(self) -> bool:
        return bool(self.rooms or self.merchant_group or self.manager_id is not None)

    def conditions(self, sla: int, last_day: date) -> list[Column]:
        """On event rows, without the room part."""
        out = []
        if self.agent:
            out.append(F.array_contains("agents", self.agent))
        if self.responder:
            out.append(F.col("first_responder") == self.responder)
        if self.types:
            out.append(F.col("event_type").isin(list(self.types)))
        if self.types_exclude:
            out.append(F.col("event_type").isNotNull() & ~F.col("event_type").isin(list(self.types_exclude)))
        by_status = {"unreplied": E.is_unreplied(), "replied": E.is_replied(), "push": E.is_push(), "backlog": E.is_backlog(F.lit(last_day))}
        if self.status in by_status:
            out.append(by_status[self.status])
        if self.overdue is not None:
            out.append(E.is_overdue(sla) if self.overdue else ~E.is_overdue(sla))
        if self.q and self.q.strip():
            out.append(F.contains(F.lower("summary"), F.lit(self.q.strip().lower())))
        return out

    def in_rooms(self, df: DataFrame, t: Tables) -> DataFrame:
        """df's rows (column roomid) of the rooms asked for; a room without merchant never matches a merchant condition."""
        if self.rooms:
            df = df.where(F.col("roomid").isin(list(self.rooms)))
        if self.merchant_group or self.manager_id is not None:
            m = t.merchants
            if self.merchant_group:
                m = m.where(F.col("merchant_group_config_name") == self.merchant_group)
            if self.manager_id is not None:
                m = m.where(F.col("business_manager_id") == F.lit(self.manager_id).cast("decimal(20,0)"))
            rooms = t.room_config.join(m, "merchant_id", "left_semi").select(F.col("corp_id").alias("corpid"), F.col("official_room_id").alias("roomid"))
            df = df.join(rooms, ["corpid", "roomid"], "left_semi")
        return df


@dataclass(frozen=True)
class Scope:
    """Days since..until of one tenant, with filters."""

    since: date
    until: date
    corp: str = "C1"
    sla: int = E.SLA
    filters: Filters = field(default_factory=Filters)

    def days(self, column: str) -> Column:
        return (F.col("corpid") == self.corp) & F.col(column).between(F.lit(self.since), F.lit(self.until))

    def rows(self, t: Tables) -> DataFrame:
        """Event rows by days and filters alone (what detail pages and their count show)."""
        df = self.filters.in_rooms(t.events.where(self.days("occurred_on")), t)
        return reduce(lambda d, c: d.where(c), self.filters.conditions(self.sla, self.until), df).withColumn("secs", F.when(E.is_merchant(), E.reply_seconds()))

    def trusted(self, t: Tables) -> DataFrame:
        """Event rows of known-complete room-days (what every aggregate counts)."""
        ok = self.filters.in_rooms(known_ok_days(t, self), t).select("corpid", "roomid", F.col("dt").alias("occurred_on"))
        return self.rows(t).join(ok, ["corpid", "roomid", "occurred_on"], "left_semi")


def known_ok_days(t: Tables, s: Scope) -> DataFrame:
    """corpid, roomid, dt of the room-days whose facts are complete: no extraction failure that covers the day is as late as its credential."""
    g = t.group_days.where(s.days("dt")).select("corpid", "roomid", "dt", "fact_completed_time")
    return _last_failure(g, t, s).where("fact_completed_time is not null and (failed_at is null or failed_at < fact_completed_time)").select("corpid", "roomid", "dt")


def _last_failure(g: DataFrame, t: Tables, s: Scope) -> DataFrame:
    """g with failed_at: the latest extraction failure whose window covers the day; failures without window cover all days."""
    f = t.failures.where((F.col("corpid") == s.corp) & (F.col("stage") == "extract"))
    spans = f.select("corpid", "roomid", F.col("window_since").alias("start"), F.when(F.col("window_since").isNotNull(), F.col("window_until")).alias("end"), "gmt_created_time")
    return latest_covering(g, spans, ["corpid", "roomid"], "dt", "gmt_created_time", s.since, s.until, "failed_at")


def freshness(t: Tables, s: Scope) -> DataFrame:
    """Room-days with freshness: unknown without credential or where a failure is as late as it, else ok."""
    g = t.group_days.where(s.days("dt")).select("corpid", "roomid", "dt", "extraction_status", "classification_status", "msg_count", "sender_count", "fact_completed_time")
    unknown = F.col("fact_completed_time").isNull() | F.coalesce(F.col("failed_at") >= F.col("fact_completed_time"), F.lit(False))
    return _last_failure(g, t, s).withColumn("freshness", F.when(unknown, "unknown").otherwise("ok")).drop("failed_at", "fact_completed_time")
