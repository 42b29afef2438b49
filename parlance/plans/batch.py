"""A run: messages to events to daily rows, then labels. Jobs are keyed by room; a failing room leaves its old facts alone."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.operators import daily, detail, labels
from parlance.operators.extraction import Model, assemble, extract
from parlance.operators.scope import Tables
from parlance.plans.store import Store
from parlance.plans.window import Window
from parlance.schema import schema
from parlance.sources import messages as M


@dataclass(frozen=True)
class Tally:
    ok: int
    failed: int

    @property
    def good(self) -> bool:
        return self.failed == 0


def run_facts(store: Store, parsed: DataFrame, model: Model, run_date: date, w: Window, frozen_before: date | None = None, rooms: Sequence[str] | None = None, most: int = 400) -> Tally:
    """parsed: what sources.messages.parsed() gives of the window. Drafts are written once; the model isn't asked again on a retry."""
    w.check(run_date)
    if frozen_before:
        store.record_rewrite(run_date, w, frozen_before, rooms)
    bad = M.room_faults(parsed).select(F.col("corp").alias("corpid"), F.col("room").alias("roomid"), "reason")
    msgs = M.clean(parsed)
    path = f"{store.root}/drafts/{run_date}-{w.since}-{w.until}-{uuid.uuid4().hex}"
    extract(msgs, model, most).write.mode("overwrite").parquet(path)
    drafts = store.spark.read.parquet(path)
    failed = drafts.where("error is not null").select(F.col("corp").alias("corpid"), F.col("room").alias("roomid"), F.col("error").alias("reason"))
    ok = msgs.select(F.col("corp").alias("corpid"), F.col("room").alias("roomid")).distinct().join(failed, ["corpid", "roomid"], "left_anti")
    events = assemble(drafts, msgs)

    seen = msgs.select(F.col("corp").alias("corpid"), F.col("room").alias("roomid")).distinct()
    accounts = daily.account_map(msgs)
    group = daily.group_rows(msgs, events, failed.select(F.col("corpid").alias("corp"), F.col("roomid").alias("room")), w.since, w.until)
    group = group.join(accounts.select(F.col("corp").alias("corpid"), F.col("room").alias("roomid"), "agent_accounts"), ["corpid", "roomid"], "left")
    done = F.when(F.col("extraction_status") == "ok", F.localtimestamp())
    # agent rows are gone until their labels are published
    tables = {"event": events, "agent_msg_day": daily.agent_message_rows(msgs), "agent_day": store.spark.createDataFrame([], schema("agent_day"))}
    store.publish_facts(tables, group.withColumn("fact_completed_time", done), ok, seen, w)

    all_failed = bad.unionByName(failed)
    n = all_failed.count()
    if n:
        store.record_failures(all_failed, "extract", run_date, w)
    return Tally(ok.count(), n)


def run_labels(store: Store, cache: DataFrame, classify: labels.Classifier, types: Sequence[str], version: str, w: Window, run_date: date, only: DataFrame | None = None) -> tuple[DataFrame, Tally]:
    """Label the window's events (or those of the room-days in `only`); publish agent rows of days all of whose events are labelled.

    Returns the cache with new answers.
    """
    inside = F.col("occurred_on").between(F.lit(w.since), F.lit(w.until))
    pending = store.read("group_day", w).where("extraction_status = 'ok'").select("corpid", "roomid", "dt")
    if only is not None:
        pending = pending.join(only, ["corpid", "roomid", "dt"], "left_semi")
    # which room-days are meant is fixed before their states change, and their labels are withheld until all is written
    kept = f"{store.root}/pending/{run_date}-{w.since}-{w.until}-{uuid.uuid4().hex}"
    pending.write.parquet(kept)
    pending = store.spark.read.parquet(kept)
    store.set_label_states(pending.withColumn("state", F.lit("pending")))
    days = pending.withColumnRenamed("dt", "occurred_on")
    events = store.read("event").where(inside).join(days, ["corpid", "roomid", "occurred_on"], "left_semi")
    path = f"{store.root}/answers/{run_date}-{w.since}-{w.until}-{version}-{uuid.uuid4().hex}"
    labels.answers(events, cache, classify, types, version).write.mode("overwrite").parquet(path)
    cache = labels.first_answers(cache, store.spark.read.parquet(path))
    # events are read before they are replaced: what is known of their labels is written aside
    aside = f"{store.root}/labels/{run_date}-{w.since}-{w.until}-{uuid.uuid4().hex}"
    labels.labelled(events, cache, version).select("id", "corpid", "roomid", "occurred_on", "event_type", "taxonomy_version").write.parquet(aside)
    named = store.spark.read.parquet(aside)
    store.save_labels(named.where("event_type is not null").select("id", "event_type", "taxonomy_version"), w)
    open_ = named.where("event_type is null").select("corpid", "roomid", F.col("occurred_on").alias("dt")).distinct()
    done = pending.join(open_, ["corpid", "roomid", "dt"], "left_anti")
    published = store.read("event").where(inside).join(done.withColumnRenamed("dt", "occurred_on"), ["corpid", "roomid", "occurred_on"], "left_semi")
    accounts = store.read("group_day").where("agent_accounts is not null").groupBy(F.col("corpid").alias("corp"), F.col("roomid").alias("room")).agg(F.max_by("agent_accounts", "dt").alias("agent_accounts"))
    rows = daily.with_accounts(daily.agent_rows(published), accounts)
    # rows of days that this run doesn't look at stay
    others = store.read("agent_day", w).join(pending.withColumnRenamed("roomid", "room"), ["corpid", "room", "dt"], "left_anti")
    rooms = pending.select("corpid", "roomid").distinct()
    others = others.join(rooms.withColumnRenamed("roomid", "room"), ["corpid", "room"], "left_semi")
    store.replace_shards("agent_day", rows.unionByName(others, allowMissingColumns=True), rooms, w)
    failed = pending.join(open_, ["corpid", "roomid", "dt"], "left_semi")
    n = failed.count()
    if n:
        store.record_failures(failed.select("corpid", "roomid", F.lit("labels").alias("reason")).distinct(), "classify", run_date, w)
    good = pending.join(open_.withColumn("open", F.lit(True)), ["corpid", "roomid", "dt"], "left")
    store.set_label_states(good.withColumn("state", F.when(F.col("open"), "failed").otherwise("ok")))
    return cache, Tally(done.count(), n)


def recover(store: Store, cache: DataFrame, classify: labels.Classifier, types: Sequence[str], version: str, w: Window, run_date: date) -> tuple[DataFrame, Tally]:
    """Labels for the window's room-days that were extracted and not labelled, those without events too; no other day is touched."""
    g = store.read("group_day", w)
    open_ = g.where((F.col("extraction_status") == "ok") & F.col("classification_status").isin("pending", "failed")).select("corpid", "roomid", "dt")
    return run_labels(store, cache, classify, types, version, w, run_date, open_)


@dataclass(frozen=True)
class Retried:
    """What a retry did, or with dry_run would do: rooms by window, windows that begin before the freeze line, failures without window."""

    plan: dict[Window, list[str]]
    frozen: list[Window]
    legacy: int
    ok: int = 0
    failed: int = 0


def retry(store: Store, parsed: Callable[[Window, Sequence[str]], DataFrame], model: Model, cache: DataFrame, classify: labels.Classifier, types: Sequence[str], version: str, since: date, run_date: date, frozen_before: date, dry_run: bool = False) -> tuple[DataFrame, Retried]:
    """Run again what failed since a day and wasn't repaired, window by window, then label what is left. parsed: raw messages of a window and rooms.

    A window that fails is counted and the next one is run; its rooms' failures are on record for another retry. Failures without
    window are only counted: they'd mean all of history.
    """
    t = Tables(store.read("event"), store.read("group_day"), store.read("run_failure"), store.read("room_config"), store.read("merchant_summary"), store.read("taxonomy"))
    rows, legacy = detail.unrepaired_failures(t, since)
    plan = windows_to_retry(rows)
    frozen = [w for w in plan if w.since < frozen_before]
    told = Retried(plan, frozen, legacy.first()[0])
    if dry_run:
        return cache, told
    ok = failed = 0
    for w, rooms in plan.items():
        try:
            good = run_facts(store, parsed(w, rooms), model, run_date, w, frozen_before, rooms).good
            cache, tally = run_labels(store, cache, classify, types, version, w, run_date)
            good = good and tally.good
        except (ValueError, OSError, PySparkException):  # a failed Spark job is one window's failure
            good = False
        ok, failed = ok + good, failed + (not good)
    span = detail.label_failure_span(replace(t, failures=store.read("run_failure")), since).first()
    if span["since"]:
        cache, tally = recover(store, cache, classify, types, version, Window(span["since"], span["until"]), run_date)
        failed += not tally.good
    return cache, replace(told, ok=ok, failed=failed)


def relabel(store: Store, cache: DataFrame, classify: labels.Classifier, types: Sequence[str], version: str, w: Window, run_date: date) -> tuple[DataFrame, Tally]:
    """All labels of a window anew, with another vocabulary."""
    if version == "v0":
        raise ValueError("v0 has no vocabulary")
    return run_labels(store, cache, classify, types, version, w, run_date)


def windows_to_retry(unrepaired: DataFrame) -> dict[Window, list[str]]:
    """Rooms by window, the oldest first. unrepaired: operators.detail.unrepaired_failures()[0]; as many rows as failures of runs."""
    out: dict[Window, list[str]] = {}
    for r in unrepaired.orderBy("window_since", "window_until", "corpid", "roomid").toLocalIterator():
        out.setdefault(Window(r["window_since"], r["window_until"]), []).append(r["roomid"])
    return out


def projected_hours(model_seconds: float, ok: int, rooms: int, at_once: int) -> float | None:
    return model_seconds / ok * rooms / at_once / 3600 if ok else None
