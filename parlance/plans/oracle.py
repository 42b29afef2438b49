"""The queries of plans/queries.py in DuckDB SQL, on the same parquet tables."""

from __future__ import annotations

from parlance.functions.text import FIELDS, MASK_AT, MASK_FIELD, MASK_PHONE, NAME, NOTE

_WORK = "CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL ELSE greatest(0, work({b}) - work({a})) END"

_BASE = """
WITH e0 AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(date_trunc('second', ts) AS TIMESTAMP) AS first_msg_time FROM events
), e1 AS (
  SELECT *, CASE WHEN event_type = 'signup' THEN first_msg_time WHEN k % 7 <> 0 THEN first_msg_time + to_seconds(CAST(floor(value * 60) AS BIGINT)) END AS first_agent_reply_time,
    CASE WHEN event_type = 'signup' THEN 'INTERNAL' ELSE 'EXTERNAL' END AS asker_role,
    CASE WHEN k % 17 = 0 THEN NULL WHEN k % 13 = 0 THEN '__untyped__' ELSE 't' || (k % 9) END AS label FROM e0
), ev AS (
  SELECT event_id AS id, 'R' || user_id AS roomid, first_msg_time, greatest(coalesce(first_agent_reply_time, first_msg_time), first_msg_time + to_seconds((k % 11) * 3600)) AS last_msg_time, first_agent_reply_time,
    CAST(first_msg_time AS DATE) AS occurred_on, asker_role,
    CASE WHEN first_agent_reply_time IS NULL THEN [] WHEN k % 3 = 0 THEN ['A' || (k % 12), 'A' || ((k + 5) % 12)] ELSE ['A' || (k % 12)] END AS agents,
    CASE WHEN first_agent_reply_time IS NOT NULL THEN 'A' || (k % 12) END AS first_responder,
    CASE WHEN k % 10 = 0 THEN 'Refund 50%_off ' ELSE 'topic ' END || (k % 25) AS summary, CASE WHEN k % 2 = 0 THEN 'EXTERNAL' ELSE 'INTERNAL' END AS last_msg_role,
    CASE WHEN k % 23 <> 0 THEN (k % 4) * 600 END AS followup_wait_max_sec, label AS event_type, CASE WHEN label IS NOT NULL THEN CASE WHEN k % 19 = 0 THEN 'v0' ELSE 'v1' END END AS taxonomy_version,
    CASE WHEN asker_role = 'EXTERNAL' AND first_agent_reply_time IS NOT NULL THEN greatest(0, {reply} - {first}) END AS secs
  FROM e1
), flagged AS (
  SELECT *, asker_role = 'EXTERNAL' AS merchant, asker_role = 'EXTERNAL' AND first_agent_reply_time IS NULL AS unreplied, asker_role = 'EXTERNAL' AND (first_agent_reply_time IS NULL OR secs > 1800) AS overdue FROM ev
), rows_ AS (SELECT * FROM flagged WHERE occurred_on BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'),
cells AS (
  SELECT *, k % 11 AS h FROM (SELECT 'R' || user_id AS roomid, CAST(first_msg_time AS DATE) AS dt, count(*) AS n, sum(k)::BIGINT AS k, count_if(event_type <> 'signup')::BIGINT AS asked, count_if(event_type <> 'signup' AND k % 7 = 0)::BIGINT AS open FROM e0 GROUP BY 1, 2)
), gd AS (
  SELECT k, roomid, dt, h, n * 3 + h AS msg_count, 2 + h % 4 AS sender_count, CASE WHEN h <> 0 THEN n END AS event_count, CASE WHEN h <> 0 THEN 'ok' ELSE 'failed' END AS extraction_status,
    CASE WHEN h = 3 THEN 'pending' WHEN h IN (0, 4) THEN 'failed' ELSE 'ok' END AS classification_status, CASE WHEN h NOT IN (0, 5) THEN CAST(dt AS TIMESTAMP) + INTERVAL 51 HOUR END AS fct
  FROM cells WHERE k % 29 <> 0
), fail AS (
  SELECT roomid, CASE WHEN h = 4 THEN 'classify' ELSE 'extract' END AS stage, dt + 2 AS run_date, dt AS ws, CAST(dt + CAST(1 + k % 4 AS INTEGER) AS DATE) AS wu, CAST(dt AS TIMESTAMP) + to_hours(CASE WHEN h = 7 THEN 36 WHEN h = 6 THEN 96 ELSE 72 END) AS at_ FROM cells WHERE h IN (0, 4, 5, 6, 7)
  UNION ALL SELECT roomid, 'extract', dt, NULL, NULL, CAST(dt AS TIMESTAMP) FROM cells WHERE day(dt) = 9 AND h = 7
), fresh AS (
  SELECT gd.*, (SELECT max(at_) FROM fail WHERE stage = 'extract' AND fail.roomid = gd.roomid AND (ws IS NULL OR gd.dt BETWEEN ws AND wu)) AS failed_at FROM gd
), ok AS (SELECT roomid, dt FROM fresh WHERE fct IS NOT NULL AND (failed_at IS NULL OR failed_at < fct)),
good AS (SELECT rows_.* FROM rows_ JOIN ok ON ok.roomid = rows_.roomid AND ok.dt = occurred_on),
ag AS (SELECT *, coalesce(first_responder = agent, false) AS owned FROM (SELECT *, unnest(agents) AS agent FROM good)),
config AS (SELECT 'R' || c_custkey AS roomid, 'Room ' || c_custkey AS group_name, CASE WHEN c_custkey % 10 <> 9 THEN c_custkey - c_custkey % 8 END AS merchant_id FROM customer),
shop AS (SELECT c_custkey AS merchant_id, c_name AS merchant_name, 'G' || n_regionkey AS grp, 100 + c_custkey % 3 AS manager_id, CASE WHEN c_custkey <> 5 THEN 'manager ' || (c_custkey % 3) END AS manager_name FROM customer JOIN nation ON c_nationkey = n_nationkey),
types AS (SELECT 't' || i AS type_id, 'P' || (i % 3) AS parent_name, 'Type ' || i AS name FROM (SELECT DISTINCT p_partkey % 9 AS i FROM part)),
days AS (SELECT DATE '2024-01-01' + CAST(d AS INTEGER) AS dt FROM range(30) a(d)),
rooms_ AS (SELECT DISTINCT roomid FROM gd),
grid AS (SELECT roomid, dt, CASE WHEN extraction_status IS NULL THEN 'missing' WHEN extraction_status = 'failed' THEN 'failed' WHEN fct IS NULL OR failed_at >= fct THEN 'unknown' ELSE 'ok' END AS state, extraction_status, classification_status, msg_count, sender_count FROM rooms_ CROSS JOIN days LEFT JOIN fresh USING (roomid, dt)),
msgs AS (
  SELECT conv_id, turn, conv_id || '-' || turn AS msg_id, 'R' || (conv_id // 25) AS room, TIMESTAMP '2024-01-01 08:00:00' + to_seconds((conv_id * 97 + turn * 613) % 2500000) AS at_,
    CASE WHEN role = 'user' THEN 'c' || (conv_id % 50) ELSE 'A' || (conv_id % 7) END AS sender_id, CASE WHEN role = 'user' THEN 'EXTERNAL' ELSE 'INTERNAL' END AS sender_role, coalesce(text, '') AS text FROM conversations
), numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY at_, msg_id) AS i, count(*) FILTER (sender_role = 'INTERNAL') OVER (PARTITION BY conv_id ORDER BY at_, msg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS g FROM msgs),
made AS (
  SELECT conv_id, any_value(room) AS room, min(at_) AS first_msg_time, max(at_) AS last_msg_time, min(at_) FILTER (sender_role = 'INTERNAL') AS first_agent_reply_time, arg_min(sender_id, i) AS asker, arg_min(sender_role, i) AS asker_role,
    arg_min(sender_id, i) FILTER (sender_role = 'INTERNAL') AS first_responder, arg_max(sender_role, i) AS last_msg_role, string_agg(msg_id, ',' ORDER BY i) AS msg_ids FROM numbered GROUP BY conv_id
)
"""


def _elapsed(t: str) -> str:
    of_day = f"CAST(hour({t}) * 3600 + minute({t}) * 60 + floor(second({t})) AS BIGINT)"
    return f"(date_diff('day', DATE '1970-01-01', CAST({t} AS DATE)) * 45000 + least(greatest({of_day}, 30600), 75600) - 30600)"


def _between(a: str, b: str) -> str:
    return f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL ELSE greatest(0, {_elapsed(b)} - {_elapsed(a)}) END"


BASE = _BASE.replace("{reply}", _elapsed("first_agent_reply_time")).replace("{first}", _elapsed("first_msg_time"))
_LAST = "DATE '2024-01-30'"
_N = {
    "events": "count(*)", "merchant": "count_if(merchant)::BIGINT", "replied": "count_if(merchant AND NOT unreplied)::BIGINT", "unreplied": "count_if(unreplied)::BIGINT", "push": "count_if(NOT merchant)::BIGINT",
    "overdue": "count_if(overdue)::BIGINT", "backlog": f"count_if(unreplied AND occurred_on < {_LAST})::BIGINT", "cross_day": "count_if(CAST(last_msg_time AS DATE) <> occurred_on)::BIGINT",
}


def _n(*names: str) -> str:
    return ", ".join(f"{_N[x]} AS {x}" for x in names or _N)


def _q(source: str, key: str = "") -> str:
    """Quantiles by row number."""
    part = f"PARTITION BY {key}" if key else ""
    pick = lambda p: f"min(CASE WHEN rn = least(n, CAST(floor(n * {p}) AS BIGINT) + 1) THEN secs END)"
    return f"SELECT {key + ', ' if key else ''}{pick(0.5)} AS p50, {pick(0.9)} AS p90 FROM (SELECT *, row_number() OVER ({part} ORDER BY secs) AS rn, count(*) OVER ({part}) AS n FROM {source} WHERE secs IS NOT NULL){f' GROUP BY {key}' if key else ''}"


def _rates(m: str = "merchant") -> str:
    return f"CASE WHEN {m} > 0 THEN overdue / {m} END AS overdue_rate"


def _group(groups: list[list[str]]) -> str:
    arms = " ".join(f"WHEN event_type IN ({', '.join(map(repr, g))}) THEN '{i}'" for i, g in enumerate(groups))
    return f"CASE {arms} ELSE '{len(groups)}' END"


_SPACE = r"\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_BLANK = f"[{_SPACE}]"


def _redaction() -> str:
    """A subquery of doc_id, text and its redacted form: one rule after the other, by lists.

    RE2 has no look-around: a phone's neighbours are matched with it, twice, as neighbours may be shared.
    """
    nl = "chr(10)"
    head = f"strpos(text[3:], '：' || {nl})"
    trim = lambda t: rf"regexp_replace({t}, '^{_BLANK}+|{_BLANK}+$', '', 'g')"
    phone = "t2"
    for _ in range(2):
        phone = rf"regexp_replace({phone}, '(^|[^0-9])1[3-9][0-9]{{9}}(?:-[0-9]{{4}})?($|[^0-9])', '\1{MASK_PHONE}\2', 'g')"
    name = f"least({NAME}, len(regexp_extract(p, '^[^{_SPACE}(（]*')))"
    rest = "p[w + 1:]"
    close = f"len(regexp_extract({rest}, '(?s)^[(（][^)）]*[)）]'))"
    left = rf"regexp_replace(CASE WHEN {close} BETWEEN 2 AND {NOTE + 2} THEN {rest}[{close} + 1:] ELSE {rest} END, '^{_BLANK}+', '')"
    field = rf"regexp_extract(p, '(?s)^.*?({FIELDS})[:：]')"
    return rf"""(
  SELECT doc_id, text, {trim("t5")} AS redacted FROM (
  SELECT doc_id, text, array_to_string([CASE WHEN {field} = '' THEN p ELSE {field} || '{MASK_FIELD}' || CASE WHEN i < len(parts) THEN regexp_extract(p, '{_BLANK}*$') ELSE '' END END for p, i in parts], '/') AS t5 FROM (
  SELECT doc_id, text, string_split(array_to_string([x for x, i in lines if x <> '' OR i IN (1, len(lines))], ' / '), '/') AS parts FROM (
  SELECT doc_id, text, [{trim("x")} for x in string_split_regex(t3, '[
]')] AS lines FROM (
  SELECT doc_id, text, {phone} AS t3 FROM (
  SELECT doc_id, text, pieces[1] || coalesce(array_to_string([CASE WHEN s.w = 0 THEN '@' || s.p ELSE '{MASK_AT} ' || {left.replace("p[w", "s.p[s.w")} END for s in [{{'p': p, 'w': {name}}} for p in pieces[2:]]], ''), '') AS t2 FROM (
  SELECT doc_id, text, string_split(CASE WHEN starts_with(text, '"') AND {head} > 0 AND regexp_matches(text[3 + {head} + 1:], '"
-+
') THEN regexp_extract(text[3 + {head} + 1:], '(?s)^.*?"
-+
(.*)$', 1) ELSE text END, '@') AS pieces FROM documents))))))
)"""


_LEAVES = [[f"t{i}"] for i in range(9)]
_PARENTS = [[f"t{i}" for i in range(p, 9, 3)] for p in range(3)]
_TYPES = [x[0] for x in _LEAVES] + ["__untyped__"]
_STATES = ", ".join(f"count_if(state = '{s}')::BIGINT AS {s}_days" for s in ("missing", "failed", "unknown", "ok"))
_LABEL_GAPS = "count_if(extraction_status = 'ok' AND classification_status = 'pending')::BIGINT AS pending_labels, count_if(extraction_status = 'ok' AND classification_status = 'failed')::BIGINT AS failed_labels"
_AGENTS = f"SELECT agent, count(DISTINCT roomid) AS rooms, count(*) AS involved, count_if(owned)::BIGINT AS owned, count_if(owned AND merchant)::BIGINT AS merchant_owned, count_if(owned AND merchant AND secs IS NOT NULL)::BIGINT AS reply_samples, count_if(owned AND overdue)::BIGINT AS overdue FROM ag GROUP BY agent"
_ROLLUP = f"SELECT roomid, {_STATES}, sum(msg_count)::BIGINT AS msgs, max(sender_count) AS senders FROM grid GROUP BY roomid"
_ROOMS = f"SELECT roomid, {_n('events', 'merchant', 'unreplied', 'overdue', 'backlog')} FROM good GROUP BY roomid"


def _pivot(key: str, source: str) -> str:
    named = ", ".join(f"count_if(event_type = '{x}')::BIGINT AS \"{x}\"" for x in _TYPES)
    return f"SELECT {key}, {named}, count_if(event_type NOT IN ({', '.join(map(repr, _TYPES))}))::BIGINT AS others, count_if(event_type IS NULL)::BIGINT AS unlabelled, count(*) AS total FROM {source} GROUP BY {key}"

_BY_DAY = f"SELECT a.*, p50, p90 FROM (SELECT occurred_on, {_n('events', 'merchant', 'replied', 'unreplied', 'overdue')} FROM good GROUP BY occurred_on) a LEFT JOIN ({_q('good', 'occurred_on')}) q USING (occurred_on)"
_BY_HOUR = f"SELECT hour(first_msg_time)::INTEGER AS hour, {_n('events', 'overdue')} FROM good GROUP BY 1"
_BUCKETS = "SELECT b::INTEGER AS bucket, count(g) AS n FROM range(8) s(b) LEFT JOIN (SELECT CASE WHEN secs <= 60 THEN 0 WHEN secs <= 300 THEN 1 WHEN secs <= 900 THEN 2 WHEN secs <= 1800 THEN 3 WHEN secs <= 3600 THEN 4 WHEN secs <= 7200 THEN 5 WHEN secs <= 14400 THEN 6 ELSE 7 END AS g FROM good WHERE secs IS NOT NULL) ON g = b GROUP BY b"
_TOP = f"SELECT roomid, key, n, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY roomid ORDER BY n DESC, key) AS rank FROM (SELECT roomid, {_group(_PARENTS)} AS key, count(*) AS n FROM good WHERE event_type IS NOT NULL GROUP BY 1, 2)) WHERE rank <= 4"
_KEYED = f"(SELECT *, {_group(_PARENTS)} AS key FROM good WHERE event_type IS NOT NULL)"
_COVERAGE = "concat_ws(', ', " + ", ".join(f"CASE WHEN {c} > 0 THEN {c} || ' {n}' END" for c, n in (("failed_days", "failed"), ("missing_days", "missing"), ("unknown_days", "unknown"), ("pending_labels", "labels pending"), ("failed_labels", "labels failed"))) + ")"
_SORT = {"time": "first_msg_time", "reply": "secs", "wait": "followup_wait_max_sec", "room": "roomid", "last": "last_msg_time"}
_FACTS = "('description', coalesce(trim(description) = '', true)), ('id', NOT regexp_full_match(type_id, '[a-z0-9_]{1,64}')), ('name', length(name) > 128), ('name joins', regexp_matches(name, '[与和及、/／]')), ('parent', length(parent_name) > 64), ('parent joins', regexp_matches(parent_name, '[与和及、/／]')), ('repeated id', same > 1)"


def _folded(key: str, source: str) -> str:
    return f"SELECT {key}, coalesce(string_agg(event_type || ':' || n, ',' ORDER BY event_type) FILTER (event_type IS NOT NULL), '') AS by_type, coalesce(sum(n) FILTER (event_type IS NULL), 0)::BIGINT AS unlabelled FROM (SELECT {key}, event_type, count(*) AS n FROM {source} GROUP BY 1, 2) GROUP BY {key}"


def _page(sort: str, down: bool, size: int = 50, offset: int = 50) -> str:
    way = "DESC" if down else "ASC"
    return f"SELECT id, r.roomid, CASE WHEN classification_status IN ('pending', 'failed') THEN NULL ELSE event_type END AS event_type FROM (SELECT * FROM rows_ ORDER BY {_SORT[sort]} {way} NULLS LAST, id {way} LIMIT {size} OFFSET {offset}) r LEFT JOIN gd ON gd.roomid = r.roomid AND dt = occurred_on"



_QUERIES = {
    "rooms": f"SELECT a.*, p50, p90, CASE WHEN merchant > 0 THEN unreplied / merchant END AS unreplied_rate, {_rates()} FROM ({_ROOMS}) a LEFT JOIN ({_q('good', 'roomid')}) q USING (roomid)",
    "summary_counts": f"SELECT count(DISTINCT roomid) AS rooms, {_n()} FROM good",
    "summary_quantiles": _q("good"),
    "summary_agents": "SELECT count(DISTINCT agent) AS agents FROM ag",
    "summary_by_day": _BY_DAY,
    "summary_by_hour": _BY_HOUR,
    "reply_buckets": _BUCKETS,
    "kpi_document": f"SELECT c.events, c.rooms, c.merchant, p50, p90, (SELECT count(DISTINCT agent) FROM ag) AS agents, unreplied / merchant AS unreplied_rate, {_rates()}, (SELECT string_agg(concat_ws(':', occurred_on, events, coalesce(p50::VARCHAR, '-'), coalesce(p90::VARCHAR, '-')), ',' ORDER BY occurred_on) FROM ({_BY_DAY})) AS by_day, (SELECT string_agg(concat_ws(':', hour, events, overdue), ',' ORDER BY hour) FROM ({_BY_HOUR})) AS by_hour, (SELECT string_agg(concat_ws(':', bucket, n), ',' ORDER BY bucket) FROM ({_BUCKETS})) AS reply_buckets FROM (SELECT count(DISTINCT roomid) AS rooms, {_n()} FROM good) c, ({_q('good')}) q",
    "room_cells": f"SELECT roomid, occurred_on, {_n('events', 'unreplied')} FROM good GROUP BY roomid, occurred_on",
    "room_categories": f"SELECT roomid, event_type, {_n('events')} FROM good GROUP BY roomid, event_type",
    "room_top_groups": _TOP,
    "room_folded_categories": _folded("roomid", "good"),
    "agent_folded_categories": _folded("agent", "ag"),
    "rooms_document": f"SELECT roomid, events, p50, series, top_groups FROM (SELECT roomid, count(*) AS events FROM good GROUP BY roomid) LEFT JOIN ({_q('good', 'roomid')}) USING (roomid) LEFT JOIN (SELECT roomid, string_agg(concat_ws(':', occurred_on, n), ',' ORDER BY occurred_on) AS series FROM (SELECT roomid, occurred_on, count(*) AS n FROM good GROUP BY 1, 2) GROUP BY roomid) USING (roomid) LEFT JOIN (SELECT roomid, string_agg(concat_ws(':', rank, key, n), ',' ORDER BY rank) AS top_groups FROM ({_TOP}) GROUP BY roomid) USING (roomid)",
    "agents_document": f"SELECT agent, rooms, owned, p90, series, room_ids FROM ({_AGENTS}) LEFT JOIN ({_q('(SELECT * FROM ag WHERE owned)', 'agent')}) USING (agent) LEFT JOIN (SELECT agent, string_agg(concat_ws(':', occurred_on, n, o), ',' ORDER BY occurred_on) AS series FROM (SELECT agent, occurred_on, count(*) AS n, count_if(owned)::BIGINT AS o FROM ag GROUP BY 1, 2) GROUP BY agent) USING (agent) LEFT JOIN (SELECT agent, string_agg(roomid, ',' ORDER BY roomid) AS room_ids FROM (SELECT DISTINCT agent, roomid FROM ag) GROUP BY agent) USING (agent)",
    "categories_document": f"SELECT key, events, p50, series FROM (SELECT key, count(*) AS events FROM {_KEYED} GROUP BY key) LEFT JOIN ({_q(_KEYED, 'key')}) USING (key) LEFT JOIN (SELECT key, string_agg(concat_ws(':', occurred_on, n), ',' ORDER BY occurred_on) AS series FROM (SELECT key, occurred_on, count(*) AS n FROM {_KEYED} GROUP BY 1, 2) GROUP BY key) USING (key)",
    "agents": f"SELECT a.*, p50, p90, {_rates('merchant_owned')} FROM ({_AGENTS}) a LEFT JOIN ({_q('(SELECT * FROM ag WHERE owned)', 'agent')}) q USING (agent)",
    "agent_cells": "SELECT agent, occurred_on, count(*) AS involved, count_if(owned)::BIGINT AS owned FROM ag GROUP BY agent, occurred_on",
    "agent_memberships": "SELECT DISTINCT agent, roomid FROM ag",
    "agent_categories": "SELECT agent, event_type, count(*) AS events FROM ag GROUP BY agent, event_type",
    "known_ok_days": "SELECT roomid, dt FROM ok",
    "group_day_freshness": "SELECT roomid, dt, CASE WHEN fct IS NULL OR failed_at >= fct THEN 'unknown' ELSE 'ok' END AS freshness FROM fresh",
    "available_range": "SELECT min(dt) AS since, max(dt) AS until FROM (SELECT occurred_on AS dt FROM ev UNION ALL SELECT dt FROM gd)",
    "room_options": "SELECT roomid, group_name, CAST(config.merchant_id AS VARCHAR) AS merchant_id, merchant_name, grp AS merchant_group, CAST(manager_id AS VARCHAR) AS manager_id, manager_name AS business_manager_name, group_name IS NOT NULL AS named, merchant_name IS NOT NULL AS merchant_known FROM (SELECT roomid FROM gd UNION SELECT roomid FROM fail WHERE ws IS NOT NULL AND ws <= DATE '2024-01-30' AND wu >= DATE '2024-01-01') LEFT JOIN config USING (roomid) LEFT JOIN shop ON shop.merchant_id = config.merchant_id",
    "agent_accounts": "SELECT 'A' || (k % 12) AS agent, arg_max('acct' || h, (dt, roomid)) AS account FROM gd GROUP BY 1",
    "event_page": "SELECT id, r.roomid, first_msg_time, last_msg_time, first_agent_reply_time, occurred_on, asker_role, first_responder, summary, last_msg_role, followup_wait_max_sec, CASE WHEN classification_status IN ('pending', 'failed') THEN NULL ELSE event_type END AS event_type, CASE WHEN classification_status IN ('pending', 'failed') THEN NULL ELSE taxonomy_version END AS taxonomy_version, secs FROM (SELECT * FROM rows_ ORDER BY secs DESC NULLS LAST, id DESC LIMIT 100 OFFSET 200) r LEFT JOIN gd ON gd.roomid = r.roomid AND dt = occurred_on",
    "event_count": "SELECT count(*) AS n FROM rows_",
    "mixed_version": "SELECT count(*) > 0 AS mixed FROM rows_ JOIN gd ON gd.roomid = rows_.roomid AND dt = occurred_on WHERE classification_status = 'ok' AND taxonomy_version <> 'v1'",
    "summary_phrases": "SELECT summary, count(*) AS n FROM rows_ GROUP BY summary",
    "event_rooms": "SELECT DISTINCT 'C1' AS corpid, roomid FROM rows_",
    "unfinished_days": "SELECT roomid, dt, event_count FROM gd WHERE extraction_status = 'ok' AND classification_status IN ('pending', 'failed')",
    "unrepaired_failures": "SELECT DISTINCT roomid, ws AS window_since, wu AS window_until FROM fail WHERE stage = 'extract' AND ws IS NOT NULL AND run_date >= DATE '2024-01-01' AND NOT EXISTS (SELECT 1 FROM gd WHERE gd.roomid = fail.roomid AND extraction_status = 'ok' AND fct IS NOT NULL AND gd.dt BETWEEN ws AND wu AND fct > at_)",
    "label_failure_span": "SELECT min(ws) AS since, max(wu) AS until FROM fail WHERE stage = 'classify'",
    "decorated_events": "SELECT id, coalesce(parent_name, CASE WHEN event_type IS NULL THEN 'unlabelled' ELSE 'unclassified' END) AS level1, coalesce(name, CASE WHEN event_type IS NULL THEN 'unlabelled' ELSE 'unclassified' END) AS level2, CAST(last_msg_time AS DATE) <> occurred_on AS cross_day, CASE WHEN NOT merchant THEN 'push' WHEN unreplied THEN 'unreplied' WHEN overdue THEN 'overdue' ELSE 'replied' END AS state FROM rows_ LEFT JOIN types ON type_id = event_type",
    "merchant_semi_join": "SELECT roomid, count(*) AS events FROM good WHERE roomid IN (SELECT roomid FROM config JOIN shop USING (merchant_id) WHERE grp = 'G1') GROUP BY roomid",
    "manager_filter": "SELECT count(DISTINCT roomid) AS rooms, count(*) AS events, coalesce(count_if(unreplied), 0)::BIGINT AS unreplied FROM good WHERE roomid IN (SELECT roomid FROM config JOIN shop USING (merchant_id) WHERE manager_id = 101)",
    "agent_filter": f"SELECT roomid, events, p50 FROM (SELECT roomid, count(*) AS events FROM good WHERE list_contains(agents, 'A3') GROUP BY roomid) LEFT JOIN ({_q('''(SELECT * FROM good WHERE list_contains(agents, 'A3'))''', 'roomid')}) q USING (roomid)",
    "responder_filter": f"SELECT roomid, events, p50 FROM (SELECT roomid, count(*) AS events FROM good WHERE first_responder = 'A3' GROUP BY roomid) LEFT JOIN ({_q('''(SELECT * FROM good WHERE first_responder = 'A3')''', 'roomid')}) q USING (roomid)",
    "exclude_types_filter": "SELECT roomid, count(*) AS events FROM good WHERE event_type IS NOT NULL AND event_type NOT IN ('t1', 't2') GROUP BY roomid",
    "overdue_filter": "SELECT count(*) AS n FROM rows_ WHERE overdue",
    "not_overdue_filter": "SELECT count(*) AS n FROM rows_ WHERE NOT overdue",
    "backlog_filter": "SELECT count(*) AS n FROM rows_ WHERE unreplied AND occurred_on < DATE '2024-01-30'",
    "text_filter": "SELECT count(*) AS n FROM rows_ WHERE contains(lower(summary), 'fund 50%_o')",
    "coverage_grid": "SELECT roomid, dt, state FROM grid",
    "coverage": f"SELECT *, ok_days > 0 AND missing_days + failed_days + unknown_days + pending_labels + failed_labels = 0 AS complete FROM (SELECT {_STATES}, {_LABEL_GAPS} FROM grid)",
    "known_days": "SELECT dt, bool_or(state = 'ok') AS known FROM grid GROUP BY dt",
    "room_rollup": f"SELECT roomid, ok_days, failed_days, unknown_days, missing_days, msgs, senders, CASE WHEN ok_days > 0 THEN coalesce(events, 0) END AS events, CASE WHEN ok_days > 0 THEN coalesce(merchant, 0) END AS merchant, CASE WHEN ok_days > 0 THEN coalesce(unreplied, 0) END AS unreplied, coalesce(overdue, 0) AS overdue FROM ({_ROLLUP}) LEFT JOIN ({_ROOMS}) USING (roomid)",
    "room_series": "SELECT grid.roomid, dt, state, CASE WHEN state = 'ok' THEN coalesce(n, 0) END AS events FROM grid LEFT JOIN (SELECT roomid, occurred_on AS dt, count(*) AS n FROM good GROUP BY 1, 2) USING (roomid, dt)",
    "agent_series": "SELECT agent, dt, CASE WHEN gap IS NULL THEN coalesce(involved, 0) END AS involved, CASE WHEN gap IS NULL THEN coalesce(owned, 0) END AS owned FROM (SELECT DISTINCT agent FROM ag) CROSS JOIN days LEFT JOIN (SELECT DISTINCT agent, dt, true AS gap FROM ag JOIN grid USING (roomid) WHERE state <> 'ok') USING (agent, dt) LEFT JOIN (SELECT agent, occurred_on AS dt, count(*) AS involved, count_if(owned)::BIGINT AS owned FROM ag GROUP BY 1, 2) USING (agent, dt)",
    "agent_rollup": f"SELECT agent, rooms, involved, owned, failed_cells, coverage_unknown FROM ({_AGENTS}) LEFT JOIN (SELECT agent, count_if(state = 'failed')::BIGINT AS failed_cells, count_if(state <> 'ok') > 0 AS coverage_unknown FROM (SELECT DISTINCT agent, roomid FROM ag) JOIN grid USING (roomid) GROUP BY agent) USING (agent)",
    "agent_rooms": "SELECT agent, roomid, count(*) AS involved, count_if(owned)::BIGINT AS owned FROM ag GROUP BY agent, roomid",
    "category_rows": "SELECT event_type, parent_name, name, events, events / total AS share FROM (SELECT event_type, count(*) AS events, (SELECT count(event_type) FROM good) AS total FROM good WHERE event_type IS NOT NULL GROUP BY event_type) LEFT JOIN types ON type_id = event_type",
    "category_slices": "SELECT rank::INTEGER AS rank, CASE WHEN rank > 5 THEN 'other' ELSE min(event_type) END AS event_type, sum(events)::BIGINT AS events, sum(events) / min(total) AS share FROM (SELECT event_type, events, total, least(6, row_number() OVER (ORDER BY events DESC, event_type)) AS rank FROM (SELECT event_type, count(*) AS events, (SELECT count(event_type) FROM good) AS total FROM good WHERE event_type IS NOT NULL GROUP BY event_type)) GROUP BY rank",
    "category_trend": "SELECT event_type, dt, CASE WHEN uncertain THEN NULL ELSE coalesce(n, 0) END AS events FROM (SELECT DISTINCT event_type FROM good WHERE event_type IS NOT NULL) CROSS JOIN (SELECT dt, bool_or(state <> 'ok') AS uncertain FROM grid GROUP BY dt) LEFT JOIN (SELECT event_type, occurred_on AS dt, count(*) AS n FROM good GROUP BY 1, 2) USING (event_type, dt)",
    "room_pivot": _pivot("roomid", "good"),
    "agent_pivot": _pivot("agent", "ag"),
    "message_rollup": "SELECT dt, sum(msg_count)::BIGINT AS msgs, sum(sender_count)::BIGINT AS sender_visits, count_if(extraction_status = 'failed')::BIGINT AS failed_cells FROM gd GROUP BY dt",
    "response_states": f"SELECT merchant, merchant - overdue AS in_time, overdue - unreplied AS late, unreplied FROM (SELECT {_n()} FROM good)",
    "page_totals": f"SELECT sum(msgs)::BIGINT AS msgs, count_if(events > 0)::BIGINT AS active_rooms, sum(CASE WHEN ok_days > 0 THEN coalesce(events, 0) END)::BIGINT AS events, bool_or(ok_days = 0) AS rooms_unknown, bool_or(failed_days + missing_days + unknown_days > 0) AS incomplete FROM ({_ROLLUP}) LEFT JOIN ({_ROOMS}) USING (roomid)",
    "manager_labels": "SELECT CAST(manager_id AS VARCHAR) AS manager_id, coalesce(min(manager_name), CAST(manager_id AS VARCHAR)) AS label FROM shop GROUP BY manager_id",
    "agent_day_rows": "SELECT roomid AS room, first_responder AS agent, occurred_on AS dt, event_type, taxonomy_version, count(*) AS event_count FROM ev WHERE first_responder IS NOT NULL GROUP BY 1, 2, 3, 4, 5",
    "agent_day_rows_participants": "SELECT roomid AS room, agent, occurred_on AS dt, event_type, taxonomy_version, count(*) AS event_count FROM (SELECT *, unnest(agents) AS agent FROM ev) GROUP BY 1, 2, 3, 4, 5",
    "agent_msg_rows": "SELECT room, sender_id AS agent, CAST(at_ AS DATE) AS dt, count(*) AS msg_count FROM msgs WHERE sender_role = 'INTERNAL' GROUP BY 1, 2, 3",
    "message_counts": "SELECT room, CAST(at_ AS DATE) AS dt, count(*) AS msg_count, count(DISTINCT sender_id) AS sender_count FROM msgs GROUP BY 1, 2",
    "dedup_messages": 'SELECT msg_id, room, min(at_) AS "at" FROM msgs GROUP BY msg_id, room',
    "followup_wait": f"SELECT 'conversation ' || conv_id AS summary, coalesce(max(wait), 0)::BIGINT AS followup_wait FROM (SELECT conv_id, g, {_between('min(at_) FILTER (sender_role = $$EXTERNAL$$)', 'min(at_) FILTER (sender_role = $$INTERNAL$$)')} AS wait, g > 0 AS after FROM numbered GROUP BY conv_id, g) WHERE after GROUP BY conv_id UNION ALL SELECT 'conversation ' || conv_id, 0 FROM numbered GROUP BY conv_id HAVING max(g) = 0",
    "segmented_extraction": """
      SELECT room AS roomid, arg_min(sender_id, i) AS asker, arg_min(sender_role, i) AS asker_role, arg_min(sender_id, i) FILTER (sender_role = 'INTERNAL') AS first_responder, arg_max(sender_role, i) AS last_msg_role, min(at_) AS first_msg_time, max(at_) AS last_msg_time,
        min(at_) FILTER (sender_role = 'INTERNAL') AS first_agent_reply_time, CAST(min(at_) AS DATE) AS occurred_on, string_agg(msg_id, ',' ORDER BY i) AS msg_ids,
        array_to_string([x for x, k in coalesce(list(sender_id ORDER BY i) FILTER (sender_role = 'INTERNAL'), []) if list_position(coalesce(list(sender_id ORDER BY i) FILTER (sender_role = 'INTERNAL'), []), x) = k], ',') AS agents
      FROM (SELECT *, row_number() OVER (PARTITION BY room, root ORDER BY at_, msg_id) AS i FROM (
        WITH RECURSIVE up AS (
          SELECT msg_id, msg_id AS top, conv_id, turn FROM msgs
          UNION ALL SELECT up.msg_id, p.msg_id, p.conv_id, p.turn FROM up JOIN msgs p ON up.turn % 3 = 2 AND p.conv_id = up.conv_id AND p.turn = up.turn - 1)
        SELECT msgs.*, roots.root FROM msgs JOIN (SELECT msg_id, arg_min(top, turn) AS root FROM up GROUP BY msg_id) roots USING (msg_id)))
      GROUP BY room, root""",
    "event_assembly": "SELECT 'conversation ' || made.conv_id AS summary, room AS roomid, asker, asker_role, first_responder, last_msg_role, first_msg_time, last_msg_time, first_agent_reply_time, CAST(first_msg_time AS DATE) AS occurred_on, msg_ids, coalesce((SELECT string_agg(sender_id, ',' ORDER BY i) FROM (SELECT sender_id, min(i) AS i FROM numbered WHERE numbered.conv_id = made.conv_id AND sender_role = 'INTERNAL' GROUP BY sender_id)), '') AS agents FROM made",
    "group_day_rows": f"""SELECT room AS roomid, dt, coalesce(m, 0)::INTEGER AS msg_count, coalesce(s, 0)::INTEGER AS sender_count, CASE WHEN room <> 'R3' THEN coalesce(e, 0) END::INTEGER AS event_count, CASE WHEN room <> 'R3' THEN coalesce(me, 0) END::INTEGER AS merchant_event_count, CASE WHEN room <> 'R3' THEN coalesce(u, 0) END::INTEGER AS unreplied_count, CASE WHEN room <> 'R3' THEN p50 END::INTEGER AS first_reply_p50_sec, CASE WHEN room <> 'R3' THEN p90 END::INTEGER AS first_reply_p90_sec, CASE WHEN room <> 'R3' THEN 'ok' ELSE 'failed' END AS extraction_status, CASE WHEN room <> 'R3' THEN 'pending' ELSE 'failed' END AS classification_status
FROM (SELECT DISTINCT room FROM msgs) CROSS JOIN days LEFT JOIN (SELECT room, CAST(at_ AS DATE) AS dt, count(*) AS m, count(DISTINCT sender_id) AS s FROM msgs GROUP BY 1, 2) USING (room, dt)
LEFT JOIN (SELECT room, CAST(first_msg_time AS DATE) AS dt, count(*) AS e, count_if(asker_role = 'EXTERNAL') AS me, count_if(asker_role = 'EXTERNAL' AND first_agent_reply_time IS NULL) AS u FROM made GROUP BY 1, 2) USING (room, dt)
LEFT JOIN ({_q(f"(SELECT room, CAST(first_msg_time AS DATE) AS dt, CASE WHEN asker_role = 'EXTERNAL' THEN {_between('first_msg_time', 'first_agent_reply_time')} END AS secs FROM made)", 'room, dt')}) USING (room, dt)""",
    "types_filter": "SELECT roomid, count(*) AS events FROM good WHERE event_type IN ('t1', 't2') GROUP BY roomid",
    "unreplied_filter": "SELECT count(*) AS n FROM rows_ WHERE unreplied",
    "replied_filter": "SELECT count(*) AS n FROM rows_ WHERE merchant AND NOT unreplied",
    "push_filter": "SELECT count(*) AS n FROM rows_ WHERE NOT merchant",
    "rooms_filter": "SELECT roomid, count(*) AS events FROM good WHERE roomid IN ('R1', 'R2', 'none') GROUP BY roomid",
    **{f"page_by_{sort}_{'down' if down else 'up'}": _page(sort, down) for sort in _SORT for down in (True, False)},
    "room_insights": "SELECT grid.roomid, dt, state, CASE WHEN state = 'ok' THEN coalesce(n, 0) END AS events, msg_count, sender_count, CASE WHEN state = 'ok' THEN coalesce(u, 0) END AS unreplied FROM grid LEFT JOIN (SELECT roomid, occurred_on AS dt, count(*) AS n, count_if(unreplied)::BIGINT AS u FROM good GROUP BY 1, 2) USING (roomid, dt)",
    "room_sheet": f"SELECT roomid, group_name, msgs, senders, CASE WHEN ok_days > 0 THEN coalesce(events, 0) END AS events, CASE WHEN ok_days > 0 THEN coalesce(merchant, 0) END AS merchant, CASE WHEN ok_days > 0 THEN coalesce(unreplied, 0) END AS unreplied, CASE WHEN merchant > 0 THEN unreplied / merchant END AS unreplied_rate, coalesce(overdue, 0) AS overdue, {_rates()}, p50, p90, CASE WHEN cov = '' THEN 'complete' ELSE cov END AS coverage FROM (SELECT *, {_COVERAGE} AS cov FROM (SELECT roomid, {_STATES}, {_LABEL_GAPS}, sum(msg_count)::BIGINT AS msgs, max(sender_count) AS senders FROM grid GROUP BY roomid)) LEFT JOIN ({_ROOMS}) USING (roomid) LEFT JOIN ({_q('good', 'roomid')}) USING (roomid) LEFT JOIN config USING (roomid)",
    "agent_sheet": f"SELECT agent, rooms, involved, p50, {_rates('merchant_owned')}, failed_cells, coverage_unknown FROM ({_AGENTS}) LEFT JOIN ({_q('(SELECT * FROM ag WHERE owned)', 'agent')}) USING (agent) LEFT JOIN (SELECT agent, count_if(state = 'failed')::BIGINT AS failed_cells, count_if(state <> 'ok') > 0 AS coverage_unknown FROM (SELECT DISTINCT agent, roomid FROM ag) JOIN grid USING (roomid) GROUP BY agent) USING (agent)",
    "busiest_rooms": "SELECT roomid, count(*) AS events FROM good GROUP BY roomid ORDER BY events DESC, roomid LIMIT 10",
    "busiest_agents": "SELECT agent, count(*) AS involved FROM ag GROUP BY agent ORDER BY involved DESC, agent LIMIT 10",
    "daily_counts": "SELECT dt, count(id) AS n FROM days LEFT JOIN rows_ ON occurred_on = dt GROUP BY dt",
    "heat_levels": "SELECT roomid, occurred_on, CASE WHEN n = 0 THEN 0 ELSE least(4, ceil(n / (max(n) OVER ()) * 4)) END::INTEGER AS level FROM (SELECT roomid, occurred_on, count(*) AS n FROM good GROUP BY 1, 2)",
    "parent_groups": "SELECT parent_name, string_agg(type_id, ',' ORDER BY type_id) AS type_ids FROM types GROUP BY parent_name",
    "taxonomy_index": "SELECT type_id, parent_name, name FROM types UNION ALL SELECT '__untyped__', 'unclassified', 'unclassified'",
    "agent_options": "SELECT agent, CASE WHEN n < 9 THEN 'Agent ' || n ELSE account END AS label, n < 9 AS named FROM (SELECT agent, account, CAST(account[5:] AS INTEGER) AS n FROM (SELECT 'A' || (k % 12) AS agent, arg_max('acct' || h, (dt, roomid)) AS account FROM gd GROUP BY 1))",
    "agents_of_window": "SELECT DISTINCT unnest(agents) AS agent FROM rows_",
    "one_event": "SELECT id, ev.roomid, summary, coalesce(classification_status = 'ok' AND taxonomy_version <> 'v1', false) AS stale FROM ev LEFT JOIN gd ON gd.roomid = ev.roomid AND dt = occurred_on WHERE id = 17",
    "event_sources": "SELECT event_id AS id, k % 5 = 0 AS gone, CASE WHEN k % 5 <> 0 THEN 'm' || event_id || '|' || summary END AS texts FROM e0 JOIN ev ON ev.id = event_id",
    "available_days": "SELECT unnest(generate_series(min(dt), max(dt), INTERVAL 1 DAY))::DATE AS dt FROM (SELECT occurred_on AS dt FROM ev UNION ALL SELECT dt FROM gd)",
    "waited": f"SELECT id, {_between('first_msg_time', 'TIMESTAMP $$2024-01-31 00:00:00$$')}::BIGINT AS waited FROM rows_ WHERE unreplied AND occurred_on < {_LAST}",
    "event_faults": "SELECT fault, count(*) AS n FROM (SELECT 'order' AS fault FROM ev WHERE id % 2 = 1 UNION ALL SELECT 'label pair' FROM ev WHERE id % 2 = 1 AND event_type IS NOT NULL) GROUP BY fault",
    "group_day_faults": "SELECT CASE WHEN extraction_status = 'ok' THEN 'failed with metrics' ELSE 'ok without counts' END AS fault, count(*) AS n FROM gd GROUP BY 1",
    "orphan_events": "SELECT 'conversation ' || conv_id AS summary, any_value(room) AS roomid FROM numbered GROUP BY conv_id HAVING arg_min(sender_role, i) = 'INTERNAL' AND NOT bool_or(regexp_matches(text, '[A-Za-z]{0,6}[0-9]{16,}'))",
    "label_disagreements": "SELECT id, event_type, 't' || (len(summary) % 9) AS answer FROM ev WHERE event_type <> 't' || (len(summary) % 9)",
    "publishable_days": "SELECT roomid, occurred_on AS dt FROM ev GROUP BY 1, 2 HAVING count(*) = count(event_type)",
    "merchant_ids": "SELECT DISTINCT CAST(merchant_id AS VARCHAR) AS merchant_id FROM config WHERE merchant_id <> 0",
    "merchant_changes": "SELECT (SELECT count(*) FROM supplier)::BIGINT AS inserted, count_if(merchant_id % 3 = 0)::BIGINT AS changed FROM shop",
    "merchant_upsert": "SELECT CAST(merchant_id AS VARCHAR) AS merchant_id, CASE WHEN merchant_id % 3 = 0 THEN 'new ' ELSE '' END || merchant_name AS merchant_name FROM shop UNION ALL SELECT CAST(1000000000 + s_suppkey AS VARCHAR), s_name FROM supplier",
    "small_texts": "SELECT c_custkey, CAST(CAST(regexp_replace(c_name, '[^0-9]', '', 'g') AS HUGEINT) AS VARCHAR) AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name FROM customer",
    "shown_texts": "SELECT CASE event_id % 3 WHEN 0 THEN '[图片]' WHEN 1 THEN '[视频]' ELSE event_type END AS shown, count(*) AS n FROM events GROUP BY 1",
    "taxonomy_faults": f"SELECT DISTINCT 'v1' AS version, type_id, fault FROM (SELECT *, count(*) OVER (PARTITION BY type_id) AS same FROM (SELECT lower(p_brand) AS type_id, p_type AS parent_name, p_name AS name, '' AS description FROM part)), LATERAL (SELECT * FROM (VALUES {_FACTS}) f(fault, bad)) WHERE bad",
    "label_with_cache": "SELECT id, 't' || (len(summary) % 9) AS event_type, 'v2' AS taxonomy_version FROM ev",
    "label_review": "SELECT event_type, events::BIGINT AS events, events / total AS share, samples FROM (SELECT event_type, sum(n) AS events, string_agg(summary, '|' ORDER BY n DESC, summary) FILTER (r <= 3) AS samples FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, summary) AS r FROM (SELECT summary, 't' || (len(summary) % 9) AS event_type, count(*) AS n FROM rows_ GROUP BY 1, 2)) GROUP BY event_type), (SELECT count(*) AS total FROM rows_)",
    "redact_documents": rf"SELECT doc_id, CASE WHEN text IS NOT NULL THEN md5(redacted) END AS redacted_md5, nullif(regexp_extract(text, '[A-Za-z]{{0,6}}[0-9]{{16,}}'), '') AS first_order, nullif(regexp_extract(text, '(?:^|[^0-9])(1[3-9][0-9]{{9}}(?:-[0-9]{{4}})?)(?:$|[^0-9])', 1), '') AS first_phone FROM {_redaction()}",
}


def sql() -> dict[str, str]:
    out = {k: f"{BASE}\n{q}" for k, q in _QUERIES.items()}
    for key, groups in (("categories_l2", _LEAVES), ("categories_l1", _PARENTS)):
        keyed = f"(SELECT *, {_group(groups)} AS key FROM good WHERE event_type IS NOT NULL)"
        out[key] = f"{BASE}\nSELECT a.*, p50, p90 FROM (SELECT key, {_n('events', 'merchant', 'unreplied')} FROM {keyed} GROUP BY key) a LEFT JOIN ({_q(keyed, 'key')}) q USING (key)"
    out["category_cells"] = f"{BASE}\nSELECT {_group(_PARENTS)} AS key, occurred_on, count(*) AS events FROM good WHERE event_type IS NOT NULL GROUP BY 1, 2"
    for sort in ("time", "reply"):
        out[f"deep_page_{sort}"] = f"{BASE}\n{_page(sort, True, 100, 700)}"
    for level in ("l1", "l2"):
        out[f"categories_{level}_from_rolls"] = out[f"categories_{level}"]
    both = [f"SELECT {i} AS level, * FROM ({out[name]})" for i, name in ((1, "categories_l1"), (2, "categories_l2"))]
    out["categories_both_levels"] = " UNION ALL BY NAME ".join(both)
    out |= {"rooms_from_rolls": out["rooms"], "agents_from_rolls": out["agents"], "agents_from_participation": out["agents"], "memberships_from_participation": out["agent_memberships"]}
    out["summary_from_rolls"] = f"{BASE}\nSELECT * FROM (SELECT {_n('events', 'merchant', 'unreplied', 'push', 'overdue', 'backlog', 'cross_day')} FROM good) CROSS JOIN ({_q('good')})"
    out["kpi_by_sql"] = f"{BASE}\nSELECT * FROM (SELECT count(DISTINCT roomid) AS rooms, {_n('events', 'merchant', 'unreplied', 'overdue')} FROM good) CROSS JOIN ({_q('good')})"
    return out
