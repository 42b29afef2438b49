"""The registered queries of the training-data operators, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm import chat, lattice, license_scan, minhash, mix, periodic, pieces, quality_classifier, quality_rules, ring, toxicity, trie, warc
from parlance.llm.common import WORD, let, stash, table


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_packs(stash(chat.format_chats(rows)))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(table(spark, sf_dir, "documents"))


def remainder(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = labels.where(remainder(5) != 0).select(F.col("doc_id").alias("key"), F.col("toxic").alias("label"))
    out = toxicity.score(docs, toxicity.fit(docs, known))
    return out.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = labels.where(remainder(4) != 2).select(F.col("doc_id").alias("key"), F.col("quality").alias("label"))
    out = quality_classifier.score(docs.select("doc_id", "text"), quality_classifier.fit(docs, known))
    return out.select("doc_id", (remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), check="same")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), (F.col("same") == 1).alias("round_trip"), "ids")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents")).drop("matches")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = quality_rules.trusted_ids(table(spark, sf_dir, "labels"))
    out = quality_rules.quality_rules(table(spark, sf_dir, "documents"), trusted)
    return out.select("doc_id", *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")])


def with_planted_period(docs: DataFrame) -> DataFrame:
    """doc_id and text of documents; a tenth of them, chosen by their ids, repeat the words from some word on with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n, a = F.size(words), (g % F.size(words)).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        ends = F.struct(a.alias("a"), p.alias("p"))
        return F.when(n > 0, let(ends, lambda e: F.array_join(F.transform(words, lambda w, i: F.when(i < e["a"], w).otherwise(F.get(words, e["a"] + (i - e["a"]) % e["p"]))), " ")))

    planted = let(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(0)), repeated)
    return docs.select("doc_id", F.when(h % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic.find_runs(with_planted_period(table(spark, sf_dir, "documents")))
    order = lambda r: F.struct((r["length"] / r["period"]).alias("x"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r.alias("run"))
    out = out.withColumn("best", F.array_max(F.transform("runs", order))["run"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        sha(lines).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


def rebuilt(paths: DataFrame) -> DataFrame:
    """Every conversation with the first turns of the fifth one at or before it in place of its own; how many, its id says."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    donors = paths.select(F.col("conv_id").alias("donor"), F.col("path").alias("d_path"), F.col("sizes").alias("d_sizes"))
    both = paths.withColumns({"h": h, "donor": F.col("conv_id") - F.col("conv_id") % 5}).join(donors, "donor", "left")
    spliced = lambda c: F.concat(F.coalesce(F.slice(f"d_{c}", F.lit(1), F.col("h")), F.slice(c, 1, 0)), F.slice(c, F.col("h") + 1, F.greatest(F.size(c), F.lit(1)))).alias(c)
    return both.select("conv_id", spliced("path"), spliced("sizes"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(rebuilt(stash(trie.turn_paths(table(spark, sf_dir, "conversations")))))


def op13_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ring.shard_rows(table(spark, sf_dir, "documents"))
    return out.select(F.col("key").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_lattice": op2_lattice,
    "op3_chat": op3_chat,
    "op4_mix": op4_mix,
    "op5_toxicity": op5_toxicity,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_warc": op7_warc,
    "op8_pieces": op8_pieces,
    "op9_license_scan": op9_license_scan,
    "op10_quality_rules": op10_quality_rules,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_ring": op13_ring,
}

_MIX = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS total FROM sizes GROUP BY source
), weighted AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY (source IS NULL), source) - 1) % 3 + 1)::BIGINT] AS weight FROM totals
), walk AS (
  SELECT *, total * 2.0::DOUBLE AS cap, row_number() OVER (ORDER BY total * 2.0::DOUBLE / weight, (source IS NULL), source) AS k FROM weighted
), sums AS (
  SELECT *, (sum(total) OVER ())::DOUBLE * 1.5::DOUBLE AS budget,
    coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open
  FROM walk
), levels AS (
  SELECT *, (budget - capped) / open AS level FROM sums
), final AS (
  SELECT arg_min(level, k) AS level FROM levels WHERE cap >= level * weight
), targets AS (
  SELECT source, total, CASE WHEN final.level IS NULL THEN cap ELSE least(cap, final.level * weight) END AS target FROM levels CROSS JOIN final
), plan AS (
  SELECT *, CASE WHEN total > 0 THEN floor(target / total)::BIGINT ELSE 0 END AS times FROM targets
), runs AS (
  SELECT s.doc_id, s.size, p.total AS source_size, p.target, p.times, round(p.target)::BIGINT - p.times * p.total AS quota,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.digest, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS before
  FROM sizes s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, (times * size + greatest(0, least(size, quota - before)))::BIGINT AS taken FROM runs
"""


def _license_sql() -> str:
    sets = [sorted(set(license_scan.words_of(x))) for _, x in license_scan.TEMPLATES]
    from math import ceil

    rows = ", ".join(f"({k}, '{label}', {words!r}, {ceil(license_scan.THRESHOLD * len(words) - 1e-9)}, {len(license_scan.words_of(text))})" for k, ((label, text), words) in enumerate(zip(license_scan.TEMPLATES, sets, strict=True)))
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    places = " || ".join(
        f"[{{'label': '{label}', 'pos': i - 1}} for i in range(1, len(words) + 1) if words[i : i + {phrase.count(' ')}] = {phrase.split(' ')!r}]"
        for label, phrase in license_scan.PHRASES.items()
    )
    return rf"""
WITH templates(template, label, words, need, length) AS (VALUES {rows}),
texts AS (SELECT row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
docs AS (SELECT row, doc_id, t, regexp_extract_all(t, '{word}') AS words FROM texts),
placed AS (SELECT row, doc_id, len(words) AS n_words, CASE WHEN contains(t, 'license') THEN {places} ELSE [] END AS places FROM docs),
able AS (SELECT row, template, label, templates.words AS wanted, need, length FROM docs JOIN templates ON len(list_intersect(list_distinct(docs.words), templates.words)) >= need),
cut AS (SELECT row, unnest(range(len(parts))) AS line, unnest(parts) AS words FROM (SELECT row, [regexp_extract_all(x, '{word}') for x in string_split(t, chr(10))] AS parts FROM texts WHERE row IN (SELECT row FROM able))),
lines AS (SELECT row, line, len(words) AS n, list_distinct(words) AS held, sum(len(words)) OVER w - len(words) AS at_, sum((len(words) = 0)::INT) OVER w AS para FROM cut WINDOW w AS (PARTITION BY row ORDER BY line)),
hits AS (SELECT able.*, line, n, at_, para, list_intersect(held, wanted) AS got FROM lines JOIN able USING (row)),
pieces AS (SELECT * FROM hits WHERE len(got) BETWEEN 1 AND need - 1),
blocks AS (
  SELECT row, label, wanted, need, got FROM hits
  UNION ALL SELECT row, any_value(label), any_value(wanted), any_value(need), list_distinct(flatten(list(got))) FROM pieces GROUP BY row, template, para
  UNION ALL SELECT x.row, any_value(x.label), any_value(x.wanted), any_value(x.need), list_distinct(flatten(list(y.got)))
    FROM pieces x JOIN pieces y ON y.row = x.row AND y.template = x.template AND y.line >= x.line AND y.at_ <= x.at_ + x.n + x.length - 2 GROUP BY x.row, x.template, x.line),
found AS (SELECT row, list_distinct(list(label)) AS labels, max(len(got) / len(wanted)) AS share FROM blocks WHERE len(got) >= need GROUP BY row)
SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min([p.pos for p in places])::BIGINT AS first_word, list_max([p.pos for p in places])::BIGINT AS last_word,
  array_to_string(list_sort(list_distinct([p.label for p in places])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct([p.label for p in places] || coalesce(labels, []))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM placed LEFT JOIN found USING (row)
"""


_LATTICE = """
WITH RECURSIVE sane AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([x for x in embedding if x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sane a JOIN sane b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN n ON n.a = vec_id
"""

_MINHASH = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] for i in range(1, len(w) - 3)]) END AS s FROM words
), posts AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM posts a JOIN posts b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""

_CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, len('<|turn|>') + len(replace(replace(replace(role, '\', '\\'), '<', '\l'), chr(10), '\n')) + 1 + len(replace(replace(text, '\', '\\'), '<', '\l')) + len('<|end|>') AS chars FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM q
"""

#: tab: CRC-32 by byte, from its polynomial; crc(bytes) of a list of bytes.
_CRC_TABLE = "crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab FROM (SELECT unnest(range(256)) AS i))"


def _crc(hexes: str) -> str:
    """Of the hex digits of bytes, where crc is in scope."""
    each = f"[('0x' || substr({hexes}, 2 * k + 1, 2))::BIGINT for k in range(len({hexes}) // 2)]"
    return f"xor(list_reduce([4294967295] || {each}, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


_RUNS = rf"""
WITH {_CRC_TABLE}, texts AS (
  SELECT row_number() OVER () AS row, doc_id, hex(encode(doc_id::VARCHAR)) AS digits, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS own FROM documents
), hashed AS (
  SELECT *, {_crc("digits")} AS h FROM texts, crc
), cut AS (
  SELECT *, CASE WHEN h % 10 = 0 AND len(own) > 0 THEN (h // 10) % len(own) END AS a, 3 + (h // 10) % 8 AS parts FROM hashed
), docs AS (
  SELECT row, doc_id, len(own) AS n, CASE WHEN a IS NULL THEN own ELSE [own[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(own) - a) // parts) END + 1] for i in range(len(own))] END AS words FROM cut
), places AS (
  SELECT row, unnest(words) AS w, unnest(range(n)) AS i FROM docs
), lags AS (
  SELECT row, n, unnest(range(1, n // 4 + 1)) AS q FROM docs
), steps AS (
  SELECT row, q, unnest(range((n - 1) // q)) AS k FROM lags
), same AS (
  SELECT s.row, s.q, s.k FROM steps s JOIN places x ON x.row = s.row AND x.i = s.k * s.q JOIN places y ON y.row = s.row AND y.i = (s.k + 1) * s.q AND y.w = x.w
), likely AS (
  SELECT DISTINCT a.row, a.q FROM same a JOIN same b ON b.row = a.row AND b.q = a.q AND b.k = a.k + 1 JOIN same c ON c.row = a.row AND c.q = a.q AND c.k = a.k + 2
), equal AS (
  SELECT l.row, l.q, x.i, x.i - row_number() OVER (PARTITION BY l.row, l.q ORDER BY x.i) AS island FROM likely l JOIN places x ON x.row = l.row JOIN places y ON y.row = l.row AND y.i = x.i + l.q AND y.w = x.w
), stretches AS (
  SELECT row, q, min(i) AS start, count(*) + q AS length FROM equal GROUP BY row, q, island
), runs AS (
  SELECT row, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY row, start, length
), dropped AS (
  SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT row, string_agg(w, ' ' ORDER BY i) AS text FROM places ANTI JOIN dropped USING (row, i) GROUP BY row
), told AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY row
), best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY row ORDER BY length::DOUBLE / period DESC, start, period) = 1
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM docs LEFT JOIN told USING (row) LEFT JOIN best USING (row) LEFT JOIN kept USING (row)
"""

_TRIE = f"""
WITH {_CRC_TABLE}, convs AS (
  SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns, hex(encode(conv_id::VARCHAR)) AS digits
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), hashed AS (
  SELECT *, {_crc("digits")} % 9 AS h FROM convs, crc
), paths AS (
  SELECT a.c, coalesce(b.turns[1:a.h], []) || a.turns[a.h + 1:] AS path FROM hashed a LEFT JOIN convs b ON b.c = a.c - a.c % 5
), members AS (
  SELECT c, d, len(path) AS n, path[d].text AS text, min(c) OVER (PARTITION BY d, path[1:d]) AS node FROM (SELECT c, path, unnest(range(len(path) + 1)) AS d FROM paths)
), nodes AS (
  SELECT node, d, count(*) AS n_convs, (count(*) - 1) * coalesce(any_value(strlen(text)), 0) AS saved, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d) AS ends FROM members GROUP BY node, d
), parents AS (
  SELECT nodes.*, members.node AS parent FROM nodes LEFT JOIN members ON members.c = nodes.node AND members.d = nodes.d - 1
), children AS (
  SELECT parent, d - 1 AS d, count(*) AS n FROM parents WHERE d > 0 GROUP BY parent, d
), counted AS (
  SELECT parents.*, coalesce(children.n, 0) AS n_children FROM parents LEFT JOIN children ON children.parent = parents.node AND children.d = parents.d
), above AS (
  SELECT m.node, m.d, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved FROM counted x JOIN members m ON m.c = x.node AND m.d <= x.d GROUP BY m.node, m.d
)
SELECT node AS conv_id, d AS depth, parent AS parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children, above.n_leaves::BIGINT AS n_leaves, above.saved::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM counted JOIN above USING (node, d)
"""


def _ring_sql() -> str:
    """Rows one after the other: shard by shard, the row at which it becomes full (its number in the order) joins the list full."""
    s, never = ring.SHARDS, 1 << 60
    number = lambda text: f"('0x' || substr(md5({text}), 1, 4))::BIGINT"
    turns = f"""
WITH {_CRC_TABLE}, bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
), light AS (
  SELECT doc_id, len(digits) // 2 + 1 AS size, {_crc("digits")} AS crc FROM bytes, crc
), copies AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, size, crc) - 1 AS copy FROM light
), named AS (
  SELECT *, concat_ws('-', coalesce(doc_id::VARCHAR, ''), size, crc, copy) AS own FROM copies
), placed AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY md5('turn:' || own)) AS k, doc_id, size, crc, {number("'place:' || coalesce(doc_id::VARCHAR, own)")} AS place FROM named
), points AS (
  SELECT DISTINCT shard, {number("'point:' || shard || ':' || point")} AS spot FROM (SELECT unnest(range({s})) AS shard) CROSS JOIN (SELECT unnest(range({ring.POINTS})) AS point)
), steps AS (
  SELECT k, shard, min((spot - place + {ring.PLACES}) % {ring.PLACES}) AS steps FROM placed CROSS JOIN points GROUP BY k, shard
), prefers AS MATERIALIZED (
  SELECT k, list(shard ORDER BY steps, shard) AS prefers FROM steps GROUP BY k
), room AS (
  SELECT [count(*) // {s} + (s < count(*) % {s})::INT for s in range({s})] AS room FROM placed
), full0 AS (
  SELECT [CASE WHEN r = 0 THEN 0 ELSE {never} END for r in room] AS filled FROM room
)"""
    for i in range(1, s):
        turns += f""", go{i} AS MATERIALIZED (
  SELECT k, list_filter(prefers, lambda x: k <= filled[x + 1])[1] AS shard, filled FROM prefers, full{i - 1}
), nth{i} AS (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY k) AS n FROM go{i}
), hit{i} AS MATERIALIZED (
  SELECT arg_min(shard, k) AS shard, min(k) AS k FROM nth{i}, room WHERE n = room[shard + 1] AND filled[shard + 1] = {never}
), full{i} AS MATERIALIZED (
  SELECT [CASE WHEN x = shard THEN k ELSE filled[x + 1] END for x in range({s})] AS filled FROM full{i - 1}, hit{i}
)"""
    return f"""{turns}
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, shard::INTEGER AS shard, (row_number() OVER (PARTITION BY shard ORDER BY k) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM (SELECT placed.*, list_filter(prefers, lambda x: k <= filled[x + 1])[1] AS shard FROM placed JOIN prefers USING (k), full{s - 1})
"""


ORACLE_SQL = {
    "op1_minhash": _MINHASH,
    "op2_lattice": _LATTICE,
    "op3_chat": _CHAT,
    "op7_warc": _WARC,
    "op4_mix": _MIX,
    "op9_license_scan": _license_sql(),
    "op11_periodic_runs": _RUNS,
    "op12_prefix_trie": _TRIE,
    "op13_ring": _ring_sql(),
}
