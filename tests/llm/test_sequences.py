"""Periodic runs, the prefix trie and the ring against brute force, with odd inputs and forced partition boundaries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from parlance.llm import chat, lattice, mix, periodic, queries, ring, trie
from parlance.llm.common import table

DATA = "/root/testdata/sf0.001"


# periodic runs


def runs_by_hand(words):
    """Every maximal stretch with its smallest period, by definition."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed_by_hand(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts():
    rng = random.Random(4)
    out = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "a b a b a b a", "a b a b a b a b", "é é é é é é é", "a " * 40, "x y " * 7]
    for _ in range(120):
        w = [rng.choice("ab") for _ in range(rng.randrange(1, 60))]
        out.append(" ".join(w))
    for _ in range(40):
        block = [f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 40))]
        w = [f"v{i}" for i in range(rng.randrange(20))] + block * rng.randrange(2, 9) + block[: rng.randrange(len(block) + 1)] + ["end"]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("short", "work"), [(2**17, 2**30), (1, 2**30), (1, 40)])
def test_runs_against_brute_force(spark, monkeypatch, short, work):
    """In place, by one range of lags, and by many."""
    monkeypatch.setattr(periodic, "SHORT_CHARS", short)
    monkeypatch.setattr(periodic, "LAG_WORK", work)
    texts = periodic_texts()
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(0, None, 2), (5, texts[5], 2), (None, texts[7], 2)]
    got = periodic.find_runs(spark.createDataFrame(rows, "doc_id long, text string, digest int")).collect()
    assert len(got) == len(rows)
    for r in got:
        words = (r["text"] or "").encode().split()
        runs = runs_by_hand(words)
        assert [(x["start"], x["length"], x["period"]) for x in r["runs"]] == runs, r["text"]
        assert r["collapsed"] == collapsed_by_hand([w.decode() for w in words], runs)
    assert periodic.find_runs(spark.createDataFrame([], "text string")).count() == 0
    with pytest.raises(ValueError, match="taken"):
        periodic.find_runs(spark.createDataFrame([], "text string, Runs int"))


def test_long_text(spark):
    rng = random.Random(5)
    block = [f"w{rng.randrange(9999)}" for _ in range(9_000)]
    words = [f"a{i}" for i in range(777)] + block * 4 + block[:100] + ["z"]
    r = periodic.find_runs(spark.createDataFrame([(" ".join(words),)] * 2, "text string")).collect()
    assert len(r) == 2 and [tuple(x) for x in r[0]["runs"]] == [(777, 36_100, 9_000)] and r[0]["collapsed"] == " ".join([*words[: 777 + 9_000], "z"])


def test_planted_period(spark):
    docs = table(spark, DATA, "documents").select("doc_id", "text")
    for r in queries.with_planted_period(docs).join(docs.withColumnRenamed("text", "own"), "doc_id").collect():
        h = zlib.crc32(str(r["doc_id"]).encode())
        w = (r["own"] or "").encode().split()
        if h % 10 or not w:
            assert (r["text"] or "").encode().split() == w
            continue
        a = h // 10 % len(w)
        p = 1 + (len(w) - a) // (3 + h // 10 % 8)
        assert r["text"].encode().split() == [w[i if i < a else a + (i - a) % p] for i in range(len(w))]


# prefix trie


def trie_by_hand(paths):
    """paths: conversation to its turns (digest, size)."""
    members = defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    rows = []

    def below(node):
        parts = [below(x) for x in children[node]]
        leaves = sum(x[0] for x in parts) or 1
        saved = sum(x[1] for x in parts) + (len(members[node]) - 1) * (node[-1][1] if node else 0)
        ends = ",".join(str(c) for c in sorted(members[node]) if len(paths[c]) == len(node))
        rows.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(children[node]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if members:
        below(())
    return Counter(rows)


def some_paths(seed, n):
    rng = random.Random(seed)
    paths = {}
    for c in range(n):
        turns = [rng.choice("abc") for _ in range(rng.choice([0, 1, 2, 3, 5, 8]))]
        if rng.random() < 0.4:
            turns = list("abcab")[: rng.randrange(3, 6)]  # a large group of copies
        paths[c * 7 % 1009] = [(bytes([ord(x)] * 16), ord(x) - 90) for x in turns]
    return paths


def run_trie(spark, paths):
    rows = [(c, [bytearray(x) for x, _ in t], [s for _, s in t]) for c, t in paths.items()]
    out = trie.prefix_trie(spark.createDataFrame(rows, "conv_id long, path array<binary>, sizes array<long>"))
    return Counter(tuple(r[c] for c in trie.NODE_COLUMNS) for r in out.collect())


@pytest.mark.parametrize(("partitions", "chunk", "waiting"), [("1", 65_536, 50_000), ("4", 3, 2), ("40", 5, 50_000), ("200", 65_536, 1)])
def test_trie_against_brute_force(spark, monkeypatch, partitions, chunk, waiting):
    """Groups of copies and open stacks over many partition boundaries."""
    monkeypatch.setattr(trie, "CHUNK", chunk)
    monkeypatch.setattr(trie, "WAITING", waiting)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for seed in (1, 2):
            paths = some_paths(seed, 300)
            assert run_trie(spark, paths) == trie_by_hand(paths)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed", range(40))
def test_sweep_and_stitch(seed):
    """The two sweeps without Spark, the sorted rows cut anywhere."""
    rng = random.Random(seed)
    paths = some_paths(seed, rng.randrange(1, 60))
    ordered = sorted(paths.items(), key=lambda x: ([k for k, _ in x[1]], x[0]))
    cuts = sorted(rng.randrange(len(ordered) + 1) for _ in range(rng.randrange(6)))
    rows = []
    for part, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(ordered)])):
        sweep = trie._Sweep(part)
        for c, turns in ordered[a:b]:
            sweep.add(c, [k for k, _ in turns], [s for _, s in turns])
        sweep.close()
        rows += [r for batch in sweep.out.take() for r in batch.to_pylist()]
    stitch = trie._Stitch()
    for r in sorted((r for r in rows if r["kind"] >= trie.HEAD), key=lambda r: (r["part"], r["kind"], r["seq"] or 0)):
        stitch.add(r)
    stitch.close()
    stitched = [r for batch in stitch.out.take() for r in batch.to_pylist()]
    names = {(r["part"], r["serial"]): r["conv_id"] for r in rows + stitched if r["kind"] == trie.NAME}
    nodes = [r | ({"parent_conv_id": names[r["part"], r["up"]]} if r["up"] is not None else {}) for r in rows + stitched if r["kind"] == trie.NODE]
    assert Counter(tuple(r[c] for c in trie.NODE_COLUMNS) for r in nodes) == trie_by_hand(paths)


def test_turn_paths(spark):
    rows = [(1, 1, "assistant", "b", 0), (1, None, "user", None, 0), (1, 1, None, "é", 0), (2, 0, "user", "", 5), (None, 0, "user", "x", 0), (1, 1, "assistant", "b", 0), (3, 0, "user", "long " * 50_000, 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path int")
    got = {r["conv_id"]: r for r in trie.turn_paths(df).collect()}
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()[:16]
    assert [bytes(x) for x in got[1]["path"]] == [digest("user", ""), digest("", "é"), digest("assistant", "b"), digest("assistant", "b")]
    assert got[1]["sizes"] == [0, 2, 1, 1] and got[2]["sizes"] == [0] and got[3]["sizes"] == [250_000] and set(got) == {1, 2, 3}
    empty = spark.createDataFrame([], df.schema)
    assert trie.prefix_trie(trie.turn_paths(empty)).count() == 0


def test_rebuilt(spark):
    rows = [(c, t, "user", f"{c}-{t}") for c in (0, 1, 4, 5, 9, 13) for t in range(1 + c % 6)]
    paths = trie.turn_paths(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    own = {r["conv_id"]: list(map(bytes, r["path"])) for r in paths.collect()}
    for r in queries.rebuilt(paths).collect():
        c = r["conv_id"]
        h = zlib.crc32(str(c).encode()) % 9
        assert list(map(bytes, r["path"])) == own.get(c - c % 5, [])[:h] + own[c][h:] and len(r["sizes"]) == len(r["path"])


# ring


def ring_by_hand(rows, shards=ring.SHARDS):
    """rows: key, size, checksum. One after the other, each to the first shard clockwise that has room."""
    number = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:4], 16)
    points = {s: {number(f"point:{s}:{p}") for p in range(ring.POINTS)} for s in range(shards)}
    seen, light = Counter(), []
    for key, size, crc in rows:
        copy = seen[key, size, crc]
        seen[key, size, crc] += 1
        own = f"{'' if key is None else key}-{size}-{crc}-{copy}"
        light.append((hashlib.md5(f"turn:{own}".encode()).hexdigest(), key, size, crc, copy, number(f"place:{own if key is None else key}")))
    room = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    load, out = [0] * shards, []
    for _, key, size, crc, copy, place in sorted(light, key=lambda x: x[0]):
        for s in sorted(range(shards), key=lambda s: (min((p - place) % ring.PLACES for p in points[s]), s)):
            if load[s] < room[s]:
                out.append((key, size, crc, copy, s, load[s]))
                load[s] += 1
                break
    return Counter(out)


@pytest.mark.parametrize("n", [0, 1, 5, 8, 300])
def test_ring_against_brute_force(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, 3, *range(10, 400)]), rng.choice([None, "", "é", f"t{rng.randrange(5)}", "x" * 100_000]), "z") for _ in range(n)] + [(7, "same", "z")] * (n // 3)
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    got = ring.shard_rows(df).collect()
    facts = [(k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t, _ in rows]
    assert Counter(tuple(r) for r in got) == ring_by_hand(facts)


def test_ring_moves_little(spark):
    """A ninth shard takes a ninth; besides, a few rows that had gone on come back or go elsewhere."""
    rows = spark.range(20_000).select(F.col("id").alias("key"), F.lit(1).cast("long").alias("size"), F.lit(0).cast("long").alias("crc"), F.lit(0).alias("copy"))
    a, b = ring.assign(rows), ring.assign(rows, 9)
    moved = a.join(b.select("key", F.col("shard").alias("now")), "key").where("shard <> now").groupBy((F.col("now") == 8).alias("new")).count()
    counts = {r["new"]: r["count"] for r in moved.collect()}
    assert counts[True] >= 20_000 // 9 and counts[False] < 0.15 * 20_000
    loads = [r["count"] for r in a.groupBy("shard").count().collect()]
    assert max(loads) - min(loads) <= 1


def test_ring_plan_is_native(spark, capsys):
    queries.op13_ring(spark, DATA).explain()
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "RDD", "CartesianProduct"))


# odd tables of earlier operators


def test_lattice_of_an_empty_table_and_of_vectors_that_link_with_nothing(spark):
    ddl = "vec_id long, embedding array<double>, label int"
    assert lattice.near_duplicates(spark.createDataFrame([], ddl)).count() == 0
    rows = [(1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0, 2.0], None)]
    got = lattice.near_duplicates(spark.createDataFrame(rows, ddl)).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got} == {(i, 0, i, True) for i in (1, 2, 3)}


def test_chats_without_ids_and_with_one_text(spark):
    rows = [(None, 0, "user", "same")] * 300 + [(1, 0, "user", "same"), (1, 1, "assistant", "é" * 200_000)]
    packs = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), pack_conversations=50)
    got = chat.read_packs(packs).collect()
    assert Counter((r["conv_id"], r["n_turns"], r["loss_chars"]) for r in got) == Counter({(None, 1, 0): 300, (1, 2, 200_000): 1})


def test_mix_without_ids_and_with_a_very_long_text(spark):
    rows = [(None, "a b c", "s"), (None, "a b c", "s"), (1, "w " * 200_000, "s"), (2, "x y", None), (3, None, None), (4, "z " * 50_000, "t")]
    got = mix.mix(spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _, _ in rows) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    by = {}
    for r in got:
        by.setdefault(r["target"], []).append(r["taken"])
    assert all(abs(sum(x) - t) <= 1 for t, x in by.items())
