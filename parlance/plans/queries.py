"""Every query by name, on the bridge's tables; plans/oracle.py has their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions import events as E
from parlance.functions import text as X
from parlance.functions import worktime
from parlance.operators import aggregates as A
from parlance.operators import daily, detail, extraction, labels
from parlance.operators import dayroll as D
from parlance.operators import rollup as R
from parlance.operators.scope import Filters, Scope, Tables, freshness, known_ok_days
from parlance.plans import surface
from parlance.sources import bridge as B
from parlance.sources import merchants
from parlance.sources import messages as M

Query = Callable[[SparkSession, str], DataFrame]

SINCE, UNTIL = B.SINCE, B.SINCE + timedelta(days=B.DAYS - 1)
LEAVES = [[f"t{i}"] for i in range(9)]
PARENTS = [[f"t{i}" for i in range(p, 9, 3)] for p in range(3)]
TYPES = [x[0] for x in LEAVES] + [E.UNTYPED]


def scope(**filters: object) -> Scope:
    return Scope(SINCE, UNTIL, B.CORP, filters=Filters(**filters))


def on(f: Callable[[Tables, Scope], DataFrame], *columns: str, **filters: object) -> Query:
    """The query that f makes over the whole window; columns: those it returns, all if none are named."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = f(B.tables(spark, sf_dir), scope(**filters))
        return out.select(*columns) if columns else out

    return run


def told(rows: str | Column, *fields: str) -> Column:
    """An array of structs as text: fields parted by colons, items by commas."""
    text = lambda x: F.concat_ws(":", *[F.coalesce(x[f].cast("string"), F.lit("-")) for f in fields])
    out = F.array_join(F.transform(rows, text), ",")
    return out.alias(rows) if isinstance(rows, str) else out


def _group_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = B.messages(spark, sf_dir)
    events = extraction.assemble(B.chat_drafts(m), m)
    failed = m.where("room = 'R3'").select("corp", "room").distinct()
    return daily.group_rows(m, events, failed, SINCE, UNTIL).drop("corpid")


def _assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = B.messages(spark, sf_dir)
    return extraction.assemble(B.chat_drafts(m), m)


def _followup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assembled(spark, sf_dir).select("summary", F.col("followup_wait_max_sec").cast("long").alias("followup_wait"))


def _facts(events: DataFrame, *more: str) -> DataFrame:
    facts = ["roomid", "asker", "asker_role", "first_responder", "last_msg_role", "first_msg_time", "last_msg_time", "first_agent_reply_time", "occurred_on"]
    return events.select(*more, *facts, F.array_join("source_msg_ids", ",").alias("msg_ids"), F.array_join("agents", ",").alias("agents"))


def _event_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(_assembled(spark, sf_dir), "summary")


def _segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = B.messages(spark, sf_dir)
    return _facts(extraction.assemble(extraction.extract(m, extraction.by_reply_chain, 60), m))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = B.events(spark, sf_dir)
    cache = spark.createDataFrame([], "digest string, event_type string")
    stub = lambda texts, types: [(i, types[len(t) % len(types)]) for i, t in enumerate(texts)]
    cache = labels.first_answers(cache, labels.answers(e, cache, stub, [x[0] for x in LEAVES], "v2"))
    return labels.labelled(e, cache, "v2").select("id", "event_type", "taxonomy_version")


def _label_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    counts = detail.summary_phrases(t, scope())
    cache = counts.select(F.sha2("summary", 256).alias("digest"), F.concat(F.lit("t"), (F.length("summary") % 9).cast("string")).alias("event_type"))
    out = labels.review(counts, cache)
    return out.select("event_type", "events", "share", F.array_join(F.transform("samples", lambda x: x["summary"]), "|").alias("samples"))


def _redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = B.read(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(X.redacted(F.col("text")).cast("binary")).alias("redacted_md5"), X.first_order(F.col("text")).alias("first_order"), X.first_phone(F.col("text")).alias("first_phone"))


def _dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = B.messages(spark, sf_dir)
    again = m.where("sender_role = 'INTERNAL'").withColumn("at", F.col("at") + F.expr("interval 1 hour"))
    return M.first_of_each(m.unionByName(again)).select("msg_id", "room", "at")


def _unrepaired(t: Tables, s: Scope) -> DataFrame:
    return detail.unrepaired_failures(t, s.since)[0].drop("corpid")


def _taxonomy_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = B.read(spark, sf_dir, "part").select(F.lit("v1").alias("version"), F.lower("p_brand").alias("type_id"), F.col("p_type").alias("parent_name"), F.col("p_name").alias("name"), F.lit("").alias("description"))
    return labels.vocabulary_faults(odd)


def _agent_options(t: Tables, s: Scope) -> DataFrame:
    names = t.taxonomy.select(F.concat(F.lit("acct"), F.substring("type_id", 2, 9)).alias("account"), F.concat(F.lit("Agent "), F.substring("type_id", 2, 9)).alias("name"))
    return detail.agent_options(detail.agent_accounts(t, s), names)


def _heat(t: Tables, s: Scope) -> DataFrame:
    cells = A.room_cells(t, s)
    most = cells.agg(F.max("events").alias("most"))
    return cells.crossJoin(most).select("roomid", "occurred_on", R.heat_level(F.col("events"), F.col("most")).alias("level"))


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.orphans(_assembled(spark, sf_dir)).select("summary", "roomid")


def _sources(t: Tables, s: Scope) -> DataFrame:
    """Every event's texts; gone where they were pruned."""
    texts = F.array_join(F.transform("source_messages", lambda m: F.concat_ws("|", m["msg_id"], m["text"])), ";")
    return t.events.select("id", F.col("source_messages").isNull().alias("gone"), texts.alias("texts"))


def _waited(t: Tables, s: Scope) -> DataFrame:
    return s.rows(t).where(E.is_backlog(F.lit(s.until))).select("id", worktime.waited_until(F.lit(s.until), F.col("first_msg_time")).alias("waited"))


def _faults(rows: DataFrame, faults: Column) -> DataFrame:
    return rows.select(F.explode(faults).alias("fault")).groupBy("fault").agg(F.count("*").alias("n"))


def _event_faults(t: Tables, s: Scope) -> DataFrame:
    """Odd ids have their last words before their first and a label of no version."""
    odd = F.col("id") % 2 == 1
    bent = t.events.withColumns({"last_msg_time": F.when(odd, F.col("first_msg_time") - F.expr("interval 1 second")).otherwise(F.col("last_msg_time")), "taxonomy_version": F.when(odd, None).otherwise(F.col("taxonomy_version"))})
    return _faults(bent, E.row_faults())


def _group_day_faults(t: Tables, s: Scope) -> DataFrame:
    """What failed days hold, as if their status were the other one; the bridge has no quantiles."""
    other = F.when(F.col("extraction_status") == "ok", "failed").otherwise("ok")
    none = F.lit(None).cast("int")
    return _faults(t.group_days.withColumns({"extraction_status": other, "first_reply_p50_sec": none, "first_reply_p90_sec": none}), E.group_day_faults())


def _disagreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = B.events(spark, sf_dir)
    cache = e.select("summary").distinct().select(F.sha2("summary", 256).alias("digest"), F.concat(F.lit("t"), (F.length("summary") % 9).cast("string")).alias("event_type"))
    return labels.disagreements(e, cache).select("id", "event_type", "answer")


def _merchant_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merchants.wanted(B.room_config(spark, sf_dir)).select(F.col("merchant_id").cast("string").alias("merchant_id"))


def _news(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All merchants, and news of them: every third has another name, and suppliers are new merchants."""
    m = B.merchants(spark, sf_dir)
    name = F.when(F.col("merchant_id") % 3 == 0, F.concat(F.lit("new "), F.col("merchant_name"))).otherwise(F.col("merchant_name"))
    none = F.lit(None).cast("string")
    new = B.read(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1_000_000_000).cast("decimal(20,0)").alias("merchant_id"), F.col("s_name").alias("merchant_name"), none.alias("merchant_group_config_name"), F.lit(None).cast("decimal(20,0)").alias("business_manager_id"), none.alias("business_manager_name"))
    return m, m.withColumn("merchant_name", name).unionByName(new)


def _upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merchants.upserted(*_news(spark, sf_dir)).select(F.col("merchant_id").cast("string").alias("merchant_id"), "merchant_name")


def _phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small texts of customers: blanks become null, numbers ids."""
    c = B.read(spark, sf_dir, "customer")
    digits = F.regexp_replace("c_name", "[^0-9]", "")
    return c.select("c_custkey", X.long_id(digits).cast("string").alias("id"), X.non_blank(F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit(" \t"), "c_name", F.lit("\n"))).otherwise(F.lit("  "))).alias("name"))


def _shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = B.read(spark, sf_dir, "events")
    kind = F.when(F.col("event_id") % 3 == 0, "IMAGE").when(F.col("event_id") % 3 == 1, "VIDEO").otherwise(F.col("event_type"))
    return e.groupBy(X.shown(F.col("event_type"), kind).alias("shown")).agg(F.count("*").alias("n"))


def _page(sort: str, descending: bool) -> Query:
    return on(lambda t, s: detail.event_page(t, s, 2, 50, sort, descending).select("id", "roomid", "event_type"))


def _deep_page(sort: str) -> Query:
    return on(lambda t, s: detail.page_by_index(t, s, detail.page_index(t, s, sort), 8, 100).select("id", "roomid", "event_type"))


def _category_trend(t: Tables, s: Scope) -> DataFrame:
    return R.category_trend(t, s)


def rolled(f: Callable[[DataFrame, Tables, Scope], DataFrame]) -> Query:
    return lambda spark, d: f(B.rolls(spark, d), B.tables(spark, d), scope())


def kept(f: Callable[[Tables, Scope], DataFrame]) -> Query:
    return lambda spark, d: f(B.with_participation(spark, d), scope())


def _kpi_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    surface.register(spark, B.tables(spark, sf_dir))
    return spark.sql(surface.KPI, {"corp": B.CORP, "since": SINCE, "until": UNTIL})


QUERIES: dict[str, Query] = {
    "rooms": on(A.rooms),
    "summary_counts": on(A.summary_counts),
    "summary_quantiles": on(A.summary_quantiles),
    "summary_agents": on(A.summary_agents),
    "summary_by_day": on(A.summary_by_day),
    "summary_by_hour": on(A.summary_by_hour),
    "reply_buckets": on(A.reply_buckets),
    "kpi_document": on(lambda t, s: A.kpi_document(t, s).select("events", "rooms", "merchant", "p50", "p90", "agents", "unreplied_rate", "overdue_rate", told("by_day", "occurred_on", "events", "p50", "p90"), told("by_hour", "hour", "events", "overdue"), told("reply_buckets", "bucket", "n"))),
    "room_cells": on(A.room_cells),
    "room_categories": on(A.room_categories),
    "room_top_groups": on(lambda t, s: A.room_top_groups(t, s, PARENTS)),
    "room_folded_categories": on(lambda t, s: A.folded(A.room_categories(t, s), "roomid").select("roomid", told(F.map_entries("by_type"), "key", "value").alias("by_type"), "unlabelled")),
    "agent_folded_categories": on(lambda t, s: A.folded(A.agent_categories(t, s), "agent").select("agent", told(F.map_entries("by_type"), "key", "value").alias("by_type"), "unlabelled")),
    "rooms_document": on(lambda t, s: A.rooms_document(t, s, PARENTS).select("roomid", "events", "p50", told("series", "occurred_on", "events"), told("top_groups", "rank", "key", "n"))),
    "agents_document": on(lambda t, s: A.agents_document(t, s).select("agent", "rooms", "owned", "p90", told("series", "occurred_on", "involved", "owned"), F.array_join("room_ids", ",").alias("room_ids"))),
    "categories_document": on(lambda t, s: A.categories_document(t, s, PARENTS).select("key", "events", "p50", told("series", "occurred_on", "events"))),
    "agents": on(A.agents),
    "agent_cells": on(A.agent_cells),
    "agent_memberships": on(A.agent_memberships),
    "agent_categories": on(A.agent_categories),
    "categories_l2": on(lambda t, s: A.categories(t, s, LEAVES)),
    "categories_l1": on(lambda t, s: A.categories(t, s, PARENTS)),
    "category_cells": on(lambda t, s: A.category_cells(t, s, PARENTS)),
    "known_ok_days": on(known_ok_days, "roomid", "dt"),
    "group_day_freshness": on(freshness, "roomid", "dt", "freshness"),
    "available_range": on(lambda t, s: detail.available_range(t, s.corp)),
    "room_options": on(detail.room_options),
    "agent_accounts": on(detail.agent_accounts),
    "event_page": on(lambda t, s: detail.event_page(t, s, 3, 100, "reply").drop("agents")),
    "event_count": on(detail.event_count),
    "mixed_version": on(lambda t, s: detail.mixed_version(t, s, B.VERSION)),
    "summary_phrases": on(detail.summary_phrases),
    "event_rooms": on(detail.event_rooms),
    "unfinished_days": on(detail.unfinished_days, "roomid", "dt", "event_count"),
    "unrepaired_failures": on(_unrepaired),
    "label_failure_span": on(lambda t, s: detail.label_failure_span(t, s.since)),
    "decorated_events": on(lambda t, s: detail.decorated(t, s.rows(t), B.VERSION).select("id", "level1", "level2", "cross_day", "state")),
    "merchant_semi_join": on(A.rooms, "roomid", "events", merchant_group="G1"),
    "manager_filter": on(A.summary_counts, "rooms", "events", "unreplied", manager_id=101),
    "agent_filter": on(A.rooms, "roomid", "events", "p50", agent="A3"),
    "responder_filter": on(A.rooms, "roomid", "events", "p50", responder="A3"),
    "exclude_types_filter": on(A.rooms, "roomid", "events", types_exclude=("t1", "t2")),
    "overdue_filter": on(detail.event_count, overdue=True),
    "not_overdue_filter": on(detail.event_count, overdue=False),
    "backlog_filter": on(detail.event_count, status="backlog"),
    "text_filter": on(detail.event_count, q="FUND 50%_o"),
    "coverage_grid": on(R.coverage_grid, "roomid", "dt", "state"),
    "coverage": on(R.coverage),
    "known_days": on(R.known_days),
    "room_rollup": on(R.room_rollup, "roomid", "ok_days", "failed_days", "unknown_days", "missing_days", "msgs", "senders", "events", "merchant", "unreplied", "overdue"),
    "room_series": on(R.room_series),
    "agent_series": on(R.agent_series),
    "agent_rollup": on(R.agent_rollup, "agent", "rooms", "involved", "owned", "failed_cells", "coverage_unknown"),
    "agent_rooms": on(R.agent_rooms),
    "category_rows": on(lambda t, s: R.category_rows(t, s, B.VERSION)),
    "category_slices": on(lambda t, s: R.category_slices(R.category_rows(t, s, B.VERSION))),
    "category_trend": on(_category_trend),
    "room_pivot": on(lambda t, s: R.room_pivot(t, s, TYPES)),
    "agent_pivot": on(lambda t, s: R.agent_pivot(t, s, TYPES)),
    "message_rollup": on(R.message_rollup),
    "response_states": on(R.response_states),
    "page_totals": on(R.page_totals),
    "manager_labels": on(lambda t, s: R.manager_labels(t)),
    "group_day_rows": _group_rows,
    "agent_day_rows": lambda spark, d: daily.agent_rows(B.events(spark, d)).drop("corpid"),
    "agent_day_rows_participants": lambda spark, d: daily.agent_rows(B.events(spark, d), owners_only=False).drop("corpid"),
    "agent_msg_rows": lambda spark, d: daily.agent_message_rows(B.messages(spark, d)).drop("corpid"),
    "message_counts": lambda spark, d: daily.message_counts(B.messages(spark, d)).drop("corp"),
    "dedup_messages": _dedup,
    "followup_wait": _followup,
    "event_assembly": _event_assembly,
    "redact_documents": _redacted,
    "taxonomy_faults": _taxonomy_faults,
    "segmented_extraction": _segmented,
    "label_with_cache": _labelled,
    "types_filter": on(A.rooms, "roomid", "events", types=("t1", "t2")),
    "unreplied_filter": on(detail.event_count, status="unreplied"),
    "replied_filter": on(detail.event_count, status="replied"),
    "push_filter": on(detail.event_count, status="push"),
    "rooms_filter": on(A.rooms, "roomid", "events", rooms=("R1", "R2", "none")),
    **{f"page_by_{sort}_{'down' if down else 'up'}": _page(sort, down) for sort in detail.SORTS for down in (True, False)},
    "room_insights": on(R.room_insights, "roomid", "dt", "state", "events", "msg_count", "sender_count", "unreplied"),
    "room_sheet": on(R.room_sheet),
    "agent_sheet": on(R.agent_sheet, "agent", "rooms", "involved", "p50", "overdue_rate", "failed_cells", "coverage_unknown"),
    "busiest_rooms": on(lambda t, s: R.top(A.rooms(t, s), "events", "roomid").select("roomid", "events")),
    "busiest_agents": on(lambda t, s: R.top(A.agents(t, s), "involved", "agent").select("agent", "involved")),
    "daily_counts": on(lambda t, s: R.daily_counts(s.rows(t), t, s)),
    "heat_levels": on(_heat),
    "parent_groups": on(lambda t, s: R.parent_groups(t, B.VERSION).select("parent_name", F.array_join("type_ids", ",").alias("type_ids"))),
    "taxonomy_index": on(lambda t, s: R.taxonomy_index(t, B.VERSION)),
    "agent_options": on(_agent_options),
    "agents_of_window": on(detail.agent_days_of_window),
    "one_event": on(lambda t, s: detail.event(t, s.corp, 17, B.VERSION).select("id", "roomid", "summary", "stale")),
    "event_sources": on(_sources),
    "available_days": on(lambda t, s: detail.available_days(t, s.corp)),
    "waited": on(_waited),
    "event_faults": on(_event_faults),
    "group_day_faults": on(_group_day_faults),
    "orphan_events": _orphans,
    "label_disagreements": _disagreements,
    "publishable_days": lambda spark, d: labels.publishable_days(B.events(spark, d)).drop("corpid"),
    "merchant_ids": _merchant_ids,
    "merchant_changes": lambda spark, d: merchants.changes(*_news(spark, d)),
    "merchant_upsert": _upserted,
    "small_texts": _phones,
    "shown_texts": _shown,
    "label_review": _label_review,
    "summary_from_rolls": rolled(D.summary),
    "rooms_from_rolls": rolled(D.rooms),
    "agents_from_rolls": rolled(D.agents),
    "categories_l1_from_rolls": rolled(lambda r, t, s: D.categories(r, t, s, PARENTS)),
    "categories_l2_from_rolls": rolled(lambda r, t, s: D.categories(r, t, s, LEAVES)),
    "agents_from_participation": kept(A.agents),
    "memberships_from_participation": kept(A.agent_memberships),
    "categories_both_levels": on(lambda t, s: A.categories_of_both_levels(t, s, LEAVES, PARENTS)),
    "kpi_by_sql": _kpi_by_sql,
    "deep_page_time": _deep_page("time"),
    "deep_page_reply": _deep_page("reply"),
}
