"""Roll-ups on the grid of rooms and days: coverage, dense series, wide tables. Null means not known and never becomes 0."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.events import rate
from parlance.operators import aggregates as A
from parlance.operators.scope import Scope, Tables, freshness

STATES = ("missing", "failed", "unknown", "ok")


def day_spine(t: Tables, s: Scope) -> DataFrame:
    one = t.events.sparkSession.range(1)
    return one.select(F.explode(F.sequence(F.lit(s.since), F.lit(s.until))).alias("dt"))


def room_dimension(t: Tables, s: Scope) -> DataFrame:
    return s.filters.in_rooms(t.group_days.where(s.days("dt")).select("corpid", "roomid").distinct(), t)


def coverage_grid(t: Tables, s: Scope) -> DataFrame:
    """Every room and day with its state: missing, failed, unknown or ok."""
    grid = room_dimension(t, s).crossJoin(day_spine(t, s))  # rooms x at most 31 days
    out = grid.join(freshness(t, s), ["corpid", "roomid", "dt"], "left")
    state = F.when(F.col("extraction_status").isNull(), "missing").when(F.col("extraction_status") == "failed", "failed").when(F.col("freshness") == "unknown", "unknown").otherwise("ok")
    return out.select("roomid", "dt", state.alias("state"), "classification_status", "extraction_status", "msg_count", "sender_count")


def _coverage_counts() -> list[Column]:
    extracted = F.col("extraction_status") == "ok"
    return [
        *[F.count_if(F.col("state") == x).alias(f"{x}_days") for x in STATES],
        F.count_if(extracted & (F.col("classification_status") == "pending")).alias("pending_labels"),
        F.count_if(extracted & (F.col("classification_status") == "failed")).alias("failed_labels"),
    ]


def coverage(t: Tables, s: Scope) -> DataFrame:
    """One row: cells by state, label gaps, and whether nothing is missing."""
    out = coverage_grid(t, s).agg(*_coverage_counts())
    gaps = F.col("missing_days") + F.col("failed_days") + F.col("unknown_days") + F.col("pending_labels") + F.col("failed_labels")
    return out.withColumn("complete", (F.col("ok_days") > 0) & (gaps == 0))


def coverage_label(label_of: dict[str, str] | None = None) -> Column:
    """Text for people: what is missing, or that nothing is."""
    names = label_of or {"failed_days": "failed", "missing_days": "missing", "unknown_days": "unknown", "pending_labels": "labels pending", "failed_labels": "labels failed"}
    parts = F.concat_ws(", ", *[F.when(F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit(f" {n}"))) for c, n in names.items()])
    return F.when(parts == "", "complete").otherwise(parts)


def known_days(t: Tables, s: Scope) -> DataFrame:
    return coverage_grid(t, s).groupBy("dt").agg(F.bool_or(F.col("state") == "ok").alias("known"))


def room_rollup(t: Tables, s: Scope) -> DataFrame:
    """Every room with its counts (null where no day is known), messages (summed) and most senders of a day."""
    cells = coverage_grid(t, s).groupBy("roomid").agg(*_coverage_counts(), F.sum("msg_count").alias("msgs"), F.max("sender_count").alias("senders"))
    out = cells.join(A.rooms(t, s), "roomid", "left")
    known = F.col("ok_days") > 0
    facts = {c: F.when(known, F.coalesce(c, F.lit(0))) for c in ("events", "merchant", "unreplied")} | {c: F.coalesce(c, F.lit(0)) for c in ("overdue", "backlog")}
    return out.withColumns(facts)


def room_series(t: Tables, s: Scope) -> DataFrame:
    """Every room and day: events on days that are ok, null on the others."""
    cells = A.room_cells(t, s).select("roomid", F.col("occurred_on").alias("dt"), "events")
    out = coverage_grid(t, s).join(cells, ["roomid", "dt"], "left")
    return out.select("roomid", "dt", "state", F.when(F.col("state") == "ok", F.coalesce("events", F.lit(0))).alias("events"))


def room_insights(t: Tables, s: Scope) -> DataFrame:
    """room_series with messages, senders and unreplied events, for one room's page."""
    cells = A.room_cells(t, s).select("roomid", F.col("occurred_on").alias("dt"), "unreplied")
    facts = coverage_grid(t, s).select("roomid", "dt", "msg_count", "sender_count")
    out = room_series(t, s).join(facts, ["roomid", "dt"]).join(cells, ["roomid", "dt"], "left")
    return out.withColumn("unreplied", F.when(F.col("state") == "ok", F.coalesce("unreplied", F.lit(0))))


def agent_series(t: Tables, s: Scope) -> DataFrame:
    """Every agent and day; null on days on which a room that the agent takes part in isn't ok."""
    gaps = coverage_grid(t, s).where("state <> 'ok'").select("roomid", "dt")
    uncertain = A.agent_memberships(t, s).join(gaps, "roomid").select("agent", "dt").distinct().withColumn("gap", F.lit(True))
    spine = A.agent_memberships(t, s).select("agent").distinct().crossJoin(day_spine(t, s))
    cells = A.agent_cells(t, s).withColumnRenamed("occurred_on", "dt")
    out = spine.join(uncertain, ["agent", "dt"], "left").join(cells, ["agent", "dt"], "left")
    return out.select("agent", "dt", *[F.when(F.col("gap").isNull(), F.coalesce(c, F.lit(0))).alias(c) for c in ("involved", "owned")])


def agent_rollup(t: Tables, s: Scope) -> DataFrame:
    """agents with how many of their rooms' cells failed and whether any day of theirs is uncertain."""
    failed = coverage_grid(t, s).groupBy("roomid").agg(F.count_if(F.col("state") == "failed").alias("failed"), F.count_if(F.col("state") != "ok").alias("gaps"))
    per_agent = A.agent_memberships(t, s).join(failed, "roomid", "left").groupBy("agent").agg(F.coalesce(F.sum("failed"), F.lit(0)).alias("failed_cells"), F.coalesce(F.sum("gaps") > 0, F.lit(False)).alias("coverage_unknown"))
    return A.agents(t, s).join(per_agent, "agent", "left")


def agent_rooms(t: Tables, s: Scope) -> DataFrame:
    """Per agent and room: events taken part in and owned."""
    return A.exploded(t, s).groupBy("agent", "roomid").agg(F.count("*").alias("involved"), F.count_if("owned").alias("owned"))


def category_rows(t: Tables, s: Scope, version: str) -> DataFrame:
    """Per label: names, count and share of all labelled events."""
    counts = A.room_categories(t, s).where("event_type is not null").groupBy("event_type").agg(F.sum("events").alias("events"))
    total = counts.agg(F.sum("events").alias("total"))
    names = t.taxonomy.where(F.col("version") == version).select(F.col("type_id").alias("event_type"), "parent_name", "name")
    return counts.crossJoin(total).join(names, "event_type", "left").select("event_type", "parent_name", "name", "events", rate(F.col("events"), F.col("total")).alias("share"))


def category_slices(rows: DataFrame, k: int = 5) -> DataFrame:
    """The k largest categories and one row for all others. rows: one per label of a closed vocabulary."""
    ranked = rows.withColumn("rank", F.least(F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("events"), "event_type")), F.lit(k + 1)))
    return ranked.groupBy("rank").agg(F.when(F.first("rank") > k, "other").otherwise(F.min("event_type")).alias("event_type"), F.sum("events").alias("events"), F.sum("share").alias("share"))


def category_trend(t: Tables, s: Scope) -> DataFrame:
    """Label and day: 0 on trusted days without events, null on days on which a cell isn't ok."""
    uncertain = coverage_grid(t, s).groupBy("dt").agg(F.bool_or(F.col("state") != "ok").alias("uncertain"))
    counts = s.trusted(t).where("event_type is not null").groupBy("event_type", F.col("occurred_on").alias("dt")).agg(F.count("*").alias("events"))
    spine = counts.select("event_type").distinct().crossJoin(day_spine(t, s))
    out = spine.join(uncertain, "dt", "left").join(counts, ["event_type", "dt"], "left")
    return out.select("event_type", "dt", F.when(F.coalesce("uncertain", F.lit(True)), None).otherwise(F.coalesce("events", F.lit(0))).alias("events"))


def category_pivot(counts: DataFrame, key: str, labels: Sequence[str], totals: DataFrame, total: str) -> DataFrame:
    """Wide table: key, one column per label, unlabelled, others and total. counts: key, event_type, events; totals: key, total.

    Stops where a row's columns do not add up to its total.
    """
    named = F.when(F.col("event_type").isNull(), "unlabelled").when(F.col("event_type").isin(list(labels)), F.col("event_type")).otherwise("others")
    columns = [*labels, "others", "unlabelled"]
    wide = counts.withColumn("_label", named).groupBy(key).pivot("_label", columns).agg(F.sum("events")).na.fill(0, columns)
    out = wide.join(totals.select(F.col(key), F.col(total).alias("total")), key, "left")
    sums = sum((F.col(f"`{c}`") for c in columns), F.lit(0))
    return out.withColumn("total", F.when(sums == F.col("total"), F.col("total")).otherwise(F.raise_error(F.concat(F.lit("columns don't add up for "), F.col(key))).cast("long")))


def room_pivot(t: Tables, s: Scope, labels: Sequence[str]) -> DataFrame:
    return category_pivot(A.room_categories(t, s), "roomid", labels, A.rooms(t, s), "events")


def agent_pivot(t: Tables, s: Scope, labels: Sequence[str]) -> DataFrame:
    return category_pivot(A.agent_categories(t, s), "agent", labels, A.agents(t, s), "involved")


def room_sheet(t: Tables, s: Scope) -> DataFrame:
    names = t.room_config.select(F.col("official_room_id").alias("roomid"), "group_name")
    out = room_rollup(t, s).join(names, "roomid", "left").withColumn("coverage", coverage_label())
    return out.select("roomid", "group_name", "msgs", "senders", "events", "merchant", "unreplied", "unreplied_rate", "overdue", "overdue_rate", "p50", "p90", "coverage").orderBy(F.desc_nulls_last("events"), "roomid")


def agent_sheet(t: Tables, s: Scope) -> DataFrame:
    return agent_rollup(t, s).orderBy(F.desc_nulls_last("involved"), "agent")


def message_rollup(t: Tables, s: Scope) -> DataFrame:
    """Per day: messages, sender visits (summed over rooms) and failed cells."""
    return t.group_days.where(s.days("dt")).groupBy("dt").agg(F.sum("msg_count").alias("msgs"), F.sum("sender_count").alias("sender_visits"), F.count_if(F.col("extraction_status") == "failed").alias("failed_cells"))


def response_states(t: Tables, s: Scope) -> DataFrame:
    """merchant = in time + late + unreplied."""
    c = A.summary_counts(t, s)
    return c.select("merchant", (F.col("merchant") - F.col("overdue")).alias("in_time"), (F.col("overdue") - F.col("unreplied")).alias("late"), "unreplied")


def page_totals(t: Tables, s: Scope) -> DataFrame:
    """One row over all rooms; null where nothing is known."""
    r = room_rollup(t, s)
    return r.agg(F.sum("msgs").alias("msgs"), F.count_if(F.col("events") > 0).alias("active_rooms"), F.sum("events").alias("events"), F.bool_or(F.col("ok_days") == 0).alias("rooms_unknown"), F.bool_or(F.col("failed_days") + F.col("missing_days") + F.col("unknown_days") > 0).alias("incomplete"))


def daily_counts(rows: DataFrame, t: Tables, s: Scope) -> DataFrame:
    counts = rows.groupBy(F.col("occurred_on").alias("dt")).agg(F.count("*").alias("n"))
    return day_spine(t, s).join(counts, "dt", "left").select("dt", F.coalesce("n", F.lit(0)).alias("n"))


def top(df: DataFrame, by: str, key: str, k: int = 10) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by), key).limit(k)


def heat_level(n: Column, most: Column) -> Column:
    """0 for 0, else 1 to 4 by share of the largest."""
    return F.when(n == 0, F.lit(0)).otherwise(F.least(F.lit(4), F.ceil(n / most * 4))).cast("int")


def parent_groups(t: Tables, version: str) -> DataFrame:
    v = t.taxonomy.where(F.col("version") == version)
    return v.groupBy("parent_name").agg(F.array_sort(F.collect_list("type_id")).alias("type_ids")).orderBy("parent_name")


def taxonomy_index(t: Tables, version: str, untyped: str = "unclassified", before: str = "unlabelled") -> DataFrame:
    """The vocabulary with a row for labels that fit nowhere; in version v0, where nothing is classified yet, it says so."""
    own = t.taxonomy.where(F.col("version") == version).select("type_id", "parent_name", "name")
    name = before if version == "v0" else untyped
    return own.unionByName(own.sparkSession.range(1).select(F.lit("__untyped__").alias("type_id"), F.lit(name).alias("parent_name"), F.lit(name).alias("name")))


def manager_labels(t: Tables) -> DataFrame:
    """Manager and any name of theirs, else the id."""
    m = t.merchants.where("business_manager_id is not null").groupBy("business_manager_id").agg(F.min(F.nullif(F.trim("business_manager_name"), F.lit(""))).alias("name"))
    return m.select(F.col("business_manager_id").cast("string").alias("manager_id"), F.coalesce("name", F.col("business_manager_id").cast("string")).alias("label"))
