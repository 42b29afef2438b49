"""Detail rows, look-ups and the facts that a page of filters needs."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from parlance.functions import events as E
from parlance.operators.scope import Scope, Tables

SORTS = {"time": "first_msg_time", "reply": "secs", "wait": "followup_wait_max_sec", "room": "roomid", "last": "last_msg_time"}
PAGE_COLUMNS = ["id", "roomid", "first_msg_time", "last_msg_time", "first_agent_reply_time", "occurred_on", "asker_role", "agents", "first_responder", "summary", "last_msg_role", "followup_wait_max_sec", "event_type", "taxonomy_version", "secs"]


def page_order(sort: str | None, descending: bool = True) -> list[Column]:
    """Nulls last either way; the id breaks ties."""
    c = F.col(SORTS[sort or "time"])
    return [c.desc_nulls_last(), F.desc("id")] if descending else [c.asc_nulls_last(), F.asc("id")]


def page_bounds(page: int, size: int) -> tuple[int, int]:
    if page < 1 or not 1 <= size <= 100 or (page - 1) * size >= 1 << 63:
        raise ValueError(f"page {page} of {size}")
    return (page - 1) * size, size


def pages(total: int, size: int) -> int:
    return ceil(total / page_bounds(1, size)[1])


def _page_rows(t: Tables, s: Scope) -> DataFrame:
    return s.rows(t).select("corpid", *PAGE_COLUMNS)


def _shown(t: Tables, s: Scope, rows: DataFrame, sort: str | None, descending: bool) -> DataFrame:
    """A page's rows in order. Labels of room-days that are still pending or failed are masked."""
    g = t.group_days.where(s.days("dt")).select("corpid", "roomid", F.col("dt").alias("occurred_on"), "classification_status")
    hidden = F.col("classification_status").isin("pending", "failed")
    shown = rows.join(g, ["corpid", "roomid", "occurred_on"], "left")
    masked = {c: F.when(F.coalesce(hidden, F.lit(False)), None).otherwise(F.col(c)) for c in ("event_type", "taxonomy_version")}
    return shown.withColumns(masked).select(*PAGE_COLUMNS).orderBy(*page_order(sort, descending))


def event_page(t: Tables, s: Scope, page: int = 1, size: int = 50, sort: str | None = None, descending: bool = True) -> DataFrame:
    """One page of detail rows by its number. Each task keeps all rows up to the page's last: deep pages go by key or by index."""
    offset, limit = page_bounds(page, size)
    return _shown(t, s, _page_rows(t, s).orderBy(*page_order(sort, descending)).offset(offset).limit(limit), sort, descending)


def beyond(key: Column, id_: Column, cursor: tuple[Column, Column], descending: bool) -> Column:
    """Whether a row comes after a cursor, a row's key and id, in a page's order; never null."""
    k, i = cursor
    on, tie = (key < k, id_ < i) if descending else (key > k, id_ > i)
    later = F.coalesce(on, F.lit(False)) | (key.eqNullSafe(k) & tie) | (key.isNull() & k.isNotNull())
    return F.coalesce(later, F.lit(False))


def _beyond(rows: DataFrame, key: str, at: Row | tuple, cursor: tuple[Column, Column], descending: bool, upto: bool = False) -> DataFrame:
    """Rows after a cursor, or up to it. What the files can be asked stands first: the key's side of the cursor."""
    k, c = F.col(key), cursor[0]
    if upto:
        rows = rows if at[0] is None else rows.where(k >= c if descending else k <= c)
        return rows.where(~beyond(k, F.col("id"), cursor, descending))
    side = k.isNull() if at[0] is None else (k <= c if descending else k >= c) | k.isNull()
    return rows.where(side).where(beyond(k, F.col("id"), cursor, descending))


def _cursor(rows: DataFrame, key: str, at: Row | tuple) -> tuple[Column, Column]:
    return tuple(F.lit(x).cast(rows.schema[c].dataType) for x, c in zip(at, (key, "id"), strict=True))


def page_after(t: Tables, s: Scope, after: tuple | None = None, size: int = 50, sort: str | None = None, descending: bool = True) -> DataFrame:
    """The page that follows a row, given by its sort key and id; the first one without. A task keeps one page of rows."""
    page_bounds(1, size)
    rows, key = _page_rows(t, s), SORTS[sort or "time"]
    if after is not None:
        rows = _beyond(rows, key, after, _cursor(rows, key, after), descending)
    return _shown(t, s, rows.orderBy(*page_order(sort, descending)).limit(size), sort, descending)


@dataclass(frozen=True)
class PageIndex:
    """Rows (key, id) that cut a sorted window into ranges, and how many rows come before each range."""

    sort: str | None
    descending: bool
    cuts: list[Row]
    before: list[int]


def page_index(t: Tables, s: Scope, sort: str | None = None, descending: bool = True, ranges: int = 64, seed: int = 1) -> PageIndex:
    """Cuts come from a sample of 32 rows a range or so; counts are exact, so pages are right whatever the sample."""
    name = SORTS[sort or "time"]
    rows = _page_rows(t, s).select(name, "id")
    n = rows.count()
    drawn = rows.sample(fraction=min(1.0, 32 * ranges / max(1, n)), seed=seed).orderBy(*page_order(sort, descending)).collect()  # 32 x ranges rows, whatever n is
    step = max(1, len(drawn) // ranges)
    cuts = drawn[step::step]
    if not cuts:
        return PageIndex(sort, descending, [], [0, n])
    table = F.array(*[F.struct(k.alias("k"), i.alias("i")) for k, i in (_cursor(rows, name, c) for c in cuts)])
    place = F.size(F.filter(table, lambda c: beyond(F.col(name), F.col("id"), (c["k"], c["i"]), descending)))
    found = {r["place"]: r["n"] for r in rows.groupBy(place.alias("place")).agg(F.count("*").alias("n")).collect()}
    before = [0]
    for k in range(len(cuts) + 1):
        before.append(before[-1] + found.get(k, 0))
    return PageIndex(sort, descending, cuts, before)


def page_by_index(t: Tables, s: Scope, index: PageIndex, page: int, size: int = 50) -> DataFrame:
    """A page by its number that reads the ranges it lies in alone."""
    offset, limit = page_bounds(page, size)
    first = max(k for k, n in enumerate(index.before) if n <= min(offset, index.before[-1]) and k <= len(index.cuts))
    last = next((k for k, n in enumerate(index.before) if n >= offset + limit), None)
    key, rows = SORTS[index.sort or "time"], _page_rows(t, s)
    if first:
        cut = index.cuts[first - 1]
        rows = _beyond(rows, key, cut, _cursor(rows, key, cut), index.descending)
    if last is not None and last - 1 < len(index.cuts):
        cut = index.cuts[last - 1]
        rows = _beyond(rows, key, cut, _cursor(rows, key, cut), index.descending, upto=True)
    rows = rows.orderBy(*page_order(index.sort, index.descending)).offset(offset - index.before[first]).limit(limit)
    return _shown(t, s, rows, index.sort, index.descending)


def event_count(t: Tables, s: Scope) -> DataFrame:
    return s.rows(t).agg(F.count("*").alias("n"))


def event(t: Tables, corp: str, id_: int, version: str) -> DataFrame:
    """The row of one event and whether its published label is of another version; none where there is no such event."""
    g = t.group_days.select("corpid", "roomid", F.col("dt").alias("occurred_on"), "classification_status")
    row = t.events.where((F.col("corpid") == corp) & (F.col("id") == id_)).join(g, ["corpid", "roomid", "occurred_on"], "left")
    stale = (F.col("classification_status") == "ok") & (F.col("taxonomy_version") != version)
    return row.withColumn("stale", F.coalesce(stale, F.lit(False)))


def source_messages(t: Tables, corp: str, id_: int) -> DataFrame:
    """No row: no such event; null: its texts are gone for good."""
    return t.events.where((F.col("corpid") == corp) & (F.col("id") == id_)).select("id", "source_messages")


def mixed_version(t: Tables, s: Scope, version: str) -> DataFrame:
    """One row: whether any published label in the window is of another version."""
    g = t.group_days.where(s.days("dt") & (F.col("classification_status") == "ok")).select("corpid", "roomid", F.col("dt").alias("occurred_on"))
    other = t.events.where(s.days("occurred_on") & (F.col("taxonomy_version") != version)).join(g, ["corpid", "roomid", "occurred_on"], "left_semi")
    return other.limit(1).agg((F.count("*") > 0).alias("mixed"))


def available_range(t: Tables, corp: str) -> DataFrame:
    days = t.events.where(F.col("corpid") == corp).select(F.col("occurred_on").alias("dt")).union(t.group_days.where(F.col("corpid") == corp).select("dt"))
    return days.agg(F.min("dt").alias("since"), F.max("dt").alias("until"))


def available_days(t: Tables, corp: str) -> DataFrame:
    return available_range(t, corp).select(F.explode(F.sequence("since", "until")).alias("dt"))


def room_options(t: Tables, s: Scope) -> DataFrame:
    """Rooms with group-days or failures in the window, with their name, merchant and manager where known."""
    failed = t.failures.where((F.col("corpid") == s.corp) & F.col("window_since").isNotNull() & (F.col("window_since") <= F.lit(s.until)) & (F.col("window_until") >= F.lit(s.since)))
    seen = t.group_days.where(s.days("dt")).select("corpid", "roomid").union(failed.select("corpid", "roomid")).distinct()
    config = t.room_config.select(F.col("corp_id").alias("corpid"), F.col("official_room_id").alias("roomid"), "group_name", "merchant_id")
    out = seen.join(config, ["corpid", "roomid"], "left").join(t.merchants, "merchant_id", "left")
    return out.select("roomid", "group_name", F.col("merchant_id").cast("string").alias("merchant_id"), "merchant_name", F.col("merchant_group_config_name").alias("merchant_group"), F.col("business_manager_id").cast("string").alias("manager_id"), "business_manager_name", F.col("group_name").isNotNull().alias("named"), F.col("merchant_name").isNotNull().alias("merchant_known"))


def agent_accounts(t: Tables, s: Scope) -> DataFrame:
    """agent and account; the latest day wins, then the room that comes last."""
    rows = t.group_days.where(s.days("dt") & F.col("agent_accounts").isNotNull()).select("dt", "roomid", F.explode("agent_accounts").alias("agent", "account"))
    return rows.groupBy("agent").agg(F.max_by("account", F.struct("dt", "roomid")).alias("account"))


def agent_options(accounts: DataFrame, names: DataFrame) -> DataFrame:
    """agent, label (name, else account, else the id) and whether the label is a real name. names: account, name."""
    out = accounts.join(names, "account", "left")
    return out.select("agent", F.coalesce("name", "account", "agent").alias("label"), F.col("name").isNotNull().alias("named"))


def agent_days_of_window(t: Tables, s: Scope) -> DataFrame:
    return s.rows(t).select(F.explode("agents").alias("agent")).distinct()


def summary_phrases(t: Tables, s: Scope) -> DataFrame:
    return t.events.where(s.days("occurred_on")).groupBy("summary").agg(F.count("*").alias("n"))


def event_rooms(t: Tables, s: Scope) -> DataFrame:
    return t.events.where(s.days("occurred_on")).select("corpid", "roomid").distinct()


def unfinished_days(t: Tables, s: Scope) -> DataFrame:
    """Room-days that were extracted but not labelled, those without events too."""
    g = t.group_days.where(s.days("dt") & (F.col("extraction_status") == "ok") & F.col("classification_status").isin("pending", "failed"))
    return g.select("corpid", "roomid", "dt", "event_count")


def unrepaired_failures(t: Tables, since) -> tuple[DataFrame, DataFrame]:
    """Distinct room windows of extraction failures that no later good room-day in the window repairs; and how many have no window.

    A window's latest failure decides, so a room's failures are reduced to its windows before they meet its days.
    """
    f = t.failures.where((F.col("stage") == "extract") & (F.col("run_date") >= F.lit(since)))
    dated = f.where("window_since is not null").groupBy("corpid", "roomid", "window_since", "window_until").agg(F.max("gmt_created_time").alias("failed_at")).alias("f")
    g = t.group_days.where("extraction_status = 'ok' and fact_completed_time is not null").alias("g")
    repairs = (F.col("f.corpid") == F.col("g.corpid")) & (F.col("f.roomid") == F.col("g.roomid")) & F.col("g.dt").between(F.col("f.window_since"), F.col("f.window_until")) & (F.col("g.fact_completed_time") > F.col("f.failed_at"))
    return dated.join(g, repairs, "left_anti").select("corpid", "roomid", "window_since", "window_until"), f.where("window_since is null").agg(F.count("*").alias("legacy"))


def label_failure_span(t: Tables, since) -> DataFrame:
    f = t.failures.where((F.col("stage") == "classify") & (F.col("run_date") >= F.lit(since)))
    return f.agg(F.min("window_since").alias("since"), F.max("window_until").alias("until"))


def checked_rows(df: DataFrame, most: int) -> DataFrame:
    """df, or an error where it has more rows: an answer is never cut."""
    if len(df.limit(most + 1).select(F.lit(1)).collect()) > most:
        raise ValueError(f"more than {most} rows")
    return df


def checked_bytes(df: DataFrame, most: int) -> DataFrame:
    """df, or an error where its rows as JSON take more bytes: the budget of an answer."""
    size = df.select(F.octet_length(F.to_json(F.struct("*"))).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if size > most:
        raise ValueError(f"{size} bytes of {most}")
    return df


def thread(t: Tables, corp: str, id_: int) -> DataFrame:
    """An event's messages by time and id, and `lost`: how many of its ids have no message."""
    e = t.events.where((F.col("corpid") == corp) & (F.col("id") == id_))
    lost = F.size(F.array_except("source_msg_ids", F.transform("source_messages", lambda m: m["msg_id"])))
    rows = e.select(lost.alias("lost"), F.explode_outer("source_messages").alias("m"))
    return rows.select("m.*", "lost").orderBy("at", "msg_id")


def decorated(t: Tables, rows: DataFrame, version: str) -> DataFrame:
    """rows with names of their labels and their state."""
    own = t.taxonomy.where(F.col("version") == version).select(F.col("type_id").alias("event_type"), F.col("parent_name").alias("level1"), F.col("name").alias("level2"))
    blank = F.when(F.col("event_type").isNull(), "unlabelled").otherwise("unclassified")
    out = rows.join(own, "event_type", "left")
    return out.withColumns({"level1": F.coalesce("level1", blank), "level2": F.coalesce("level2", blank), "cross_day": E.is_cross_day(), "state": E.status()})
