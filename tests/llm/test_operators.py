"""The training-data operators against brute force, round trips and held-out accuracy, with odd inputs."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import time
from collections import Counter
from math import ceil, sqrt

import numpy as np
import pytest
import regex
import sentencepiece
import xxhash
import zstandard
from pyspark.sql import functions as F

from parlance.llm import chat, common, e8, graph, lattice, license_scan, minhash, mix, pieces, quality_classifier, quality_rules, queries, shingles, toxicity, warc
from parlance.llm.common import table

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0d]+")
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


def docs(spark, rows, extra=""):
    return spark.createDataFrame([(*r, *[1 if x.endswith(" int") else "z" for x in extra.split(",")[1:]]) for r in rows], DOCS + extra)


ODD = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "one two", "en", None, 7), (4, "one two", "en", None, 7), (None, "one two three four five six", "en", "b", 10), (5, LONG, "en", "b", len(LONG)), (6, "One two THREE four five six", "en", "b", 10)]


def components(edges):
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {x: find(x) for x in top}


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (2000, 2001)] + [(3000, 3001 + i) for i in range(50)]
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == components([e for e in edges if e[0] != e[1]])
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def sets_of(text):
    w = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_minhash_against_brute_force(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(25):
        base = [f"t{rng.randrange(500)}" for _ in range(rng.randrange(6, 60))]
        for _ in range(4):
            w = list(base)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = f"u{rng.randrange(500)}"
            texts.append(" ".join(w))
    rows = [*ODD, *[(100 + i, t, "en", "a", 1) for i, t in enumerate(texts)]]
    got = minhash.near_duplicates(docs(spark, rows, ", key string, n string, digest string, id string")).collect()
    sets = [(r[0], sets_of(r[1])) for r in rows if r[0] is not None]
    edges = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if x and y and 100 * len(x & y) >= 75 * len(x | y)]
    want = components(edges)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None) == Counter((k, len(s), want.get(k, k)) for k, s in sets)
    assert sum(r["kept"] for r in got if r["doc_id"] == 4) == 2 and not any(r["kept"] for r in got if r["doc_id"] is None)
    kept = minhash.drop_near_duplicates(docs(spark, rows)).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter({k: 1 for k, _ in sets if want.get(k, k) == k} | {None: 1})
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize(("rounds", "block"), [(0, 4), (2, 4), (0, 10_000)])
def test_large_groups_lose_no_link(spark, monkeypatch, rounds, block):
    """Chains, stars and loose groups at once: however blocks are cut and rounds go, links connect the same."""
    monkeypatch.setattr(minhash, "ROUNDS", rounds)
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(11)
    words = [f"t{i}" for i in range(400)]
    texts = [words[i : i + 80] for i in range(0, 60)]  # a chain: neighbours are alike, the ends are not
    for edits in (1, 3, 5):  # groups around one text, some of whose members are alike and some not quite
        base = [f"v{edits}.{i}" for i in range(90)]
        for _ in range(40):
            w = list(base)
            for _ in range(rng.randrange(edits + 1)):
                w[rng.randrange(len(w))] = f"u{rng.randrange(10**6)}"
            texts.append(w)
    rows = [(i, " ".join(w), "en", "a", 1) for i, w in enumerate(texts)]
    sets = [(r[0], sets_of(r[1])) for r in rows]
    want = components([(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if 100 * len(x & y) >= 75 * len(x | y)])
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs(spark, rows)).collect()}
    assert got == {k: want.get(k, k) for k, _ in sets}


def test_minhash_keys_with_several_texts_and_none(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(7, a), (7, b), (5, a + " z"), (6, b + " z"), (None, c), (9, c + " z"), (None, "x y z"), (None, "x y z"), (3, "x Y z")]
    got = minhash.near_duplicates(docs(spark, [(*r, "en", "s", 1) for r in rows])).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter([(7, 5), (7, 5), (5, 5), (6, 5), (9, 9), (3, 3)] + [(None, None)] * 3)


def test_shingles_are_exact():
    for t in ("", "A b", "a B c d e f a b c d e", LONG):
        assert len(shingles.shingles(t)) == len(sets_of(t))


def test_e8_finds_the_nearest_point():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)) * 2
    p = e8.nearest(x)
    near = p[:, None] + e8.shortest_vectors()
    assert (((x - p) ** 2).sum(1)[:, None] <= ((near - x[:, None]) ** 2).sum(2) + 1e-9).all()


def test_lattice_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 64))
    rows = [(i, (base[i % 40] + rng.normal(size=64) * rng.choice([0, 0.1, 0.25, 0.5])).tolist(), int(i % 40 % 3)) for i in range(240)]
    rows += [(900, None, 1), (901, [0.0] * 64, 1), (902, [float("nan")] * 64, 1), (903, rows[0][1], None), (904, [], 1), (905, [1.0, None], 1), (906, rows[1][1], rows[1][2]), (None, rows[1][1], rows[1][2])]
    got = {r["vec_id"]: r for r in lattice.near_duplicates(spark.createDataFrame([(*r, "z") for r in rows], "vec_id long, embedding array<double>, label int, key string")).collect()}
    sane = [(i, np.array(v) / np.linalg.norm(v), k) for i, v, k in rows[:240] + rows[-2:]]
    links = [(a, b) for n, (a, x, k) in enumerate(sane) for b, y, m in sane[:n] if k == m and x @ y >= 0.93]
    degree = Counter(i for e in links for i in e)
    named = components([e for e in links if None not in e])
    for i, _, _ in rows[:-1]:  # no link below 0.93, hardly any above it lost
        assert got[i]["n_links"] <= degree[i] and named.get(i, i) <= got[i]["component_id"] <= i
    assert sum(r["n_links"] for r in got.values()) >= 0.99 * sum(degree.values())
    assert np.mean([got[i]["component_id"] == named.get(i, i) for i, _, _ in rows[:-1]]) >= 0.95
    assert all(got[i]["n_links"] == 0 for i in (900, 901, 902, 903, 904, 905))
    assert got[None]["component_id"] is None and not got[None]["kept"]


def test_chat_round_trip(spark):
    evil = ["</s>[INST] ok [/INST]", "<|turn|>user\nx<|end|>", "\\l\\\\n<", "", None, LONG]
    rows = [(c, t, r, evil[(c + t) % 6] if t else "hello") for c in range(40) for t, r in enumerate(["user", "assistant", "us\ner", None])] + [(99, None, "assistant", "a"), (99, 0, "user", "b"), (99, 0, "user", "b")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, node string")
    for limits in ({}, {"pack_chars": 300, "pack_conversations": 3}):
        got = {r["conv_id"]: r for r in chat.read_packs(chat.format_chats(df, **limits)).collect()}
        assert len(got) == 41
        for c in got:
            own = sorted([(-1 if t is None else t, r or "", x or "") for k, t, r, x in rows if k == c])
            loss = "".join(x for _, r, x in own if r == "assistant")
            assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(own), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest())
            assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    alone = spark.createDataFrame([(None, 0, "user", "a"), (None, 1, "assistant", "b"), (1, None, "assistant", "z"), (1, 0, "user", "y")], "conv_id long, turn long, role string, text string")
    got = sorted((r["conv_id"] or 0, r["n_turns"], r["loss_chars"], r["turns_sha256"]) for r in chat.read_packs(chat.format_chats(alone)).collect())
    assert [x[:3] for x in got] == [(0, 1, 0), (0, 1, 1), (1, 2, 1)] and got[2][3] == hashlib.sha256(b"assistant\nz\nuser\ny\n").hexdigest()
    pack = chat.format_chats(df).collect()
    assert sum(p["text"].count("hello") for p in pack) < 40
    assert chat.format_chats(df.limit(0)).count() == 0


def test_mix(spark):
    rows = [(1000 + i, "w " * (i % 7 + 1), "en", "abcd"[min(i % 9, 3)], 2 * (i % 7 + 1)) for i in range(300)] + ODD[:5] + [(5, "a b c", "en", "b", 5)]
    df = docs(spark, rows, ", size string, digest string")
    out = mix.mix(df).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_, budget = {}, list(order), 1.5 * sum(sizes.values())
    while open_:
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2 * sizes[s] for s in over}
        open_ = [s for s in open_ if s not in over]
    source = {r[0]: r[3] for r in rows}
    taken = Counter()
    for r in out:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        assert abs(r["target"] - target[s]) < 1e-6 and r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[s]
    assert all(abs(taken[s] - target[s]) <= 2 for s in target)
    assert sorted(map(str, out)) == sorted(map(str, mix.mix(df.repartition(3)).collect()))
    whole = mix.mixed(df).collect()
    assert df.columns == whole[0].__fields__
    words = Counter()
    for r in whole:
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    want = Counter()
    for r in out:
        want[r["doc_id"]] += r["taken"]
    assert +words == +want
    assert mix.mix(df.limit(0)).count() == 0 == mix.mixed(df.limit(0)).count()


def test_classifiers_on_held_out_rows(spark):
    known = {r["doc_id"]: r for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    for query, column, least in ((queries.op5_toxicity, "toxic", 0.9), (queries.op6_quality_classifier, "quality", 0.9)):
        rows = [r for r in query(spark, "/root/testdata/sf0.01").collect() if r["held_out"] and r["doc_id"] in known and known[r["doc_id"]][column] is not None]
        ones = [r["score"] for r in rows if known[r["doc_id"]][column]]
        zeros = [r["score"] for r in rows if not known[r["doc_id"]][column]]
        auc = np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])
        assert len(rows) > 20 and auc >= least, (column, auc)


def test_classifiers_without_labels(spark):
    d = docs(spark, ODD, ", Score string, label int, key string")
    none = spark.createDataFrame([], "key long, label int")
    one = spark.createDataFrame([(2, 1), (3, 1), (4, None)], "key long, label int")
    for labels, want in ((none, 0.0), (one, 1.0)):
        assert all(abs(r["score"] - want) < 1e-6 for r in toxicity.score(d, toxicity.fit(d, labels)).collect())
        assert all(abs(r["score"] - want) < 1e-6 for r in quality_classifier.score(d, quality_classifier.fit(d, labels), out="Other").withColumnRenamed("Other", "score_").select("score_").toDF("score").collect())
    both = spark.createDataFrame([(i, i % 2) for i in range(1, 7)], "key long, label int")
    for f, name in ((toxicity, "score"), (quality_classifier, "score_")):
        got = f.score(d, f.fit(d, both)).collect()
        assert len(got) == len(ODD) and all(0 <= r[name] <= 1 for r in got)
        assert f.score(d.limit(0), f.fit(d.limit(0), both)).count() == 0


def test_factorization_machine_learns_a_pair():
    rng = np.random.default_rng(2)
    rows = [np.flatnonzero(rng.random(6) < 0.5) for _ in range(3000)]
    y = np.array([float(0 in r and 1 in r) for r in rows])
    m = toxicity.train(rows, y, 6, epochs=30)
    assert np.mean((m.score(rows) >= 0.5) == (y == 1)) > 0.97


def test_factorization_machine_against_all_pairs():
    rng = np.random.default_rng(4)
    m = toxicity.Machine(0.3, rng.random(50).astype(np.float32), rng.normal(size=50).astype(np.float32), rng.normal(size=(50, 4)).astype(np.float32))
    rows = [np.flatnonzero(rng.random(50) < 0.3) for _ in range(40)] + [[], [7]]
    for r, got in zip(rows, m.score(rows), strict=True):
        x = m.values[r] / np.sqrt((m.values[r] ** 2).sum() + 1e-3) if len(r) else []
        z = m.bias + sum(m.weights[i] * a for i, a in zip(r, x, strict=True))
        z += sum(float(m.factors[r[p]] @ m.factors[r[q]]) * x[p] * x[q] for p in range(len(r)) for q in range(p))
        assert np.isclose(got, 1 / (1 + np.exp(-z)), atol=1e-5)


def test_size_difference_against_direct_compression():
    samples = [[f"{k} word{i % 7} {i}".encode() * 4 for i in range(400)] for k in ("good", "bad")]
    (good, a), (bad, b) = (quality_classifier.dictionary(x, 4_096) for x in samples)
    sizes = quality_classifier.Sizes(good, bad, (a, b))

    def size(data, d, raw):
        d = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_AUTO)
        z = zstandard.ZstdCompressor(level=quality_classifier.LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
        return sum(len(z.compress(data[i : i + quality_classifier.PIECE])) for i in range(0, len(data), quality_classifier.PIECE))

    for text in ("good word3 17 " * 90, "bad word3 17", "é" * 700, "", None):
        data = (text or "").encode()
        g, b_ = size(data, good, a), size(data, bad, b)
        assert sizes(text) == (b_ - g) / max(1, b_ + g)
    assert sizes("good word3 17 good word4 18") > 0 > sizes("bad word3 17 bad word4 18")


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "é" * 100
    rows = [(1, "http://a b", big), (2, None, big), (3, "x\r\ny", ""), (4, "u", None), (5, "u", "tiny"), (6, "u", "tiny"), (0, "u", LONG), (7, "u", big)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.archive_pages(df).collect()}
    for i, _, h in rows:
        data = (h or "").encode()
        first = min(j for j, _, x in rows if (x or "") == (h or ""))
        revisit = len(data) >= 100 and first != i
        assert got[i] == (len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None)
    warc.write_archive(df, f"file://{tmp_path}/a")
    first, heads, payloads = warc.read_archive(spark, f"file://{tmp_path}/a")
    assert payloads.count() == 4 and first.count() == 2 and heads.count() == len(rows) - 2
    records = warc.reconstruct(spark, f"file://{tmp_path}/a")
    parsed = {r["key"]: r for r in warc.parse(records).collect()}
    assert {k: bytes(r["payload"]).decode() for k, r in parsed.items() if r["kind"] == "response"} == {1: big, 3: "", 4: "", 5: "tiny", 6: "tiny", 0: LONG}
    record = next(bytes(r["record"]) for r in records.collect() if b"urn:page:1>\r\nWARC-Target" in bytes(r["record"]))
    assert record.endswith(big.encode() + b"\r\n\r\n") and record.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and f"\r\nContent-Length: {len(big.encode())}\r\n".encode() in record
    assert warc.archive_pages(df.limit(0)).count() == 0


def test_warc_with_more_payload_than_buckets_allow(spark, tmp_path):
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "3")
    try:
        df = spark.createDataFrame([(i, "u", f"{i % 40} " * 60) for i in range(60)], "page_id long, url string, html string")
        warc.write_archive(df, f"file://{tmp_path}/a", bucket=10)
        assert spark.read.parquet(f"file://{tmp_path}/a/layout").first()[0] == 3
        assert warc.parse(warc.reconstruct(spark, f"file://{tmp_path}/a")).where("kind = 'response'").count() == 40
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")


def test_warc_without_keys_and_with_repeated_ones(spark):
    big = "x" * 200
    df = spark.createDataFrame([(None, big), (None, big), (2, big), (2, big), (3, big), (None, "y" * 200), (None, "y" * 200), (None, "s")], "page_id long, html string").withColumn("url", F.lit(None).cast("string"))
    got = Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.archive_pages(df).collect())
    assert got == Counter([(None, "revisit", 2, 200)] * 2 + [(2, "response", None, 200)] * 2 + [(3, "revisit", 2, 200)] + [(None, "response", None, 200)] * 2 + [(None, "response", None, 1)])


def test_warc_stops_at_damage(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "z" * 300)], "page_id long, url string, html string")
    warc.write_archive(df, f"file://{tmp_path}/b")
    record = warc.reconstruct(spark, f"file://{tmp_path}/b")
    cut = record.select(F.expr("substring(record, 1, octet_length(record) - 1)").alias("record"))
    with pytest.raises(Exception, match="lengths aren't those"):
        warc.parse(cut).collect()


def test_pieces_round_trip(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [r["text"] for r in table(spark, DATA, "documents").limit(60).collect()] + ["", None, "  a  b ", "日本語 😀 \x01", "a" * 400, "ﬁ ▁x", LONG]
    df = spark.createDataFrame([(i, t, "z", "y") for i, t in enumerate(texts)], "doc_id long, text string, IDS string, same string")
    out = pieces.encode(df, check="Same")
    assert out.columns == ["doc_id", "text", "IDS", "same", "ids_", "Same_"]
    got = {r["doc_id"]: r for r in pieces.decode(out, ids="ids_", out="back").collect()}
    for i, t in enumerate(texts):
        ids = got[i]["ids_"]
        assert (ids is None) == (t is None) and got[i]["back"] == (None if t is None else sp.decode(ids)) == (None if t is None else sp.decode(sp.encode(t)))
        assert got[i]["Same_"] == (None if t is None else int(sp.decode(ids) == t))
    assert pieces.encode(df.limit(0), check="same").count() == 0 == pieces.decode(out.limit(0), ids="ids_").count()


def codec(vocabulary, memory=1000):
    c = object.__new__(pieces.Codec)
    c.pieces, c.plain, c.byte_id, c.unknown, c.known, c.memory = list(vocabulary), list(range(len(vocabulary))), {}, 99, {}, memory
    c._tables(np.array(list(vocabulary.values())))
    return c


def best_sum(word, vocabulary, unknown):
    best = [0.0]
    for end in range(1, len(word) + 1):
        best.append(max([best[s] + vocabulary[word[s:end]] for s in range(end) if word[s:end] in vocabulary] + [best[end - 1] + unknown]))
    return best[-1]


def test_viterbi_takes_the_best_sum(monkeypatch):
    rng = random.Random(8)
    vocabulary = {"".join(rng.choice("abcde") for _ in range(rng.randrange(1, 6))): -rng.random() * 9 for _ in range(120)}
    vocabulary.pop("e", None)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 40))) for _ in range(1000)]
    for cells in (100_000, 7):
        monkeypatch.setattr(pieces, "CELLS", cells)
        c = codec(vocabulary)
        c._spell = lambda symbols: symbols
        c._learn(sorted(set(words)))
        for w in words:
            ids = c.known[w] if w in c.known else None
            if ids is None:  # forgotten: memory is bounded
                continue
            assert "".join(c.pieces[i] if i >= 0 else chr(-1 - i) for i in ids) == w
            total = sum(vocabulary[c.pieces[i]] if i >= 0 else c.unknown_score for i in ids)
            assert abs(total - best_sum(w, vocabulary, c.unknown_score)) < 1e-3
    assert codec(vocabulary)._viterbi(np.array([[ord("z"), ord("y")]], np.uint32)) == [[99]]


def test_viterbi_compares_what_hashes_find(monkeypatch):
    monkeypatch.setattr(pieces, "_BASE", np.uint64(1))  # now all orders of the same letters collide
    c = codec({"ab": -1.0, "a": -3.0, "b": -3.0})
    assert [[c.pieces[i] for i in x] for x in c._viterbi(np.array([[98, 97], [97, 98]], np.uint32))] == [["b", "a"], ["ab"]]


def test_long_words_take_linear_time():
    with open(pieces.MODEL, "rb") as f:
        c = pieces.Codec(f.read())
    began = time.perf_counter()
    (ids,) = c.encode(["日本ab" * 50_000])
    assert time.perf_counter() - began < 20 and c.decode([ids]) == ["日本ab" * 50_000]


def test_ranks_become_log_probabilities():
    assert np.allclose(pieces.log_probabilities([-0.5, -1.25]), [-0.5, -1.25])
    got = pieces.log_probabilities([0.0, -1.0, -2.0])
    assert np.isclose(np.exp(got).sum(), 1) and got[0] > got[1] > got[2]


def test_license_scan(spark):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    notice = license_scan.TEMPLATES[5][1]
    texts = ["MIT License, mit\nlicense", "x Apache-License 2 apache license", "GNU General Public License", notice, notice.replace("binary", "other"), " ".join(notice.split()[:8]), LONG + " mit license", None, "", "ünder the mit license"]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)] + [(3, notice, "z")], "doc_id long, text string, words string")
    got = license_scan.license_scan(df).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        w = word.findall((texts[r["doc_id"]] or "").translate({i: i + 32 for i in range(65, 91)}))
        at = [(i, k) for k, p in license_scan.PHRASES.items() for i in range(len(w)) if w[i : i + p.count(" ") + 1] == p.split(" ")]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(w), len(at), ",".join(sorted({k for _, k in at})))
        assert (r["first_word"], r["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))
        held = set(w)
        assert ("bsd" in r["labels"]) == (len(held & set(license_scan.words_of(notice))) >= 0.9 * len(set(license_scan.words_of(notice))))
    assert license_scan.license_scan(df.limit(0)).count() == 0


def test_license_lines_that_end_in_carriage_returns(spark):
    rows = [(k, ("first words\r\n" + text.replace("\n", "\r\n") + "\r\nlast words")) for k, (_, text) in enumerate(license_scan.TEMPLATES)]
    got = {r["doc_id"]: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (label, _) in enumerate(license_scan.TEMPLATES):
        assert label in got[k]["labels"].split(",") and k in [m["template"] for m in got[k]["matches"]]


def brute_rules(text):
    w = WORD.findall(text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(again)


def test_quality_rules(spark):
    rows = [*ODD, (7, "a b c d e a b c d e f\n# x\n# x\n", "en", "a", 1), (8, "a a a a a a a a a a a a", "en", "a", 1), (9, "a b c d e x a b c d e y " * 3, "en", "a", 1)]
    real = [(r["doc_id"] + 100, r["text"], "en", "a", 1) for r in table(spark, DATA, "documents").limit(80).collect()]
    rows += real
    trusted = spark.createDataFrame([(r[0],) for r in real[:40]], "doc_id long")
    df = docs(spark, rows, ", quality_ string, _text string, h string, _base string")
    got = quality_rules.quality_rules(df, trusted).select("doc_id", "text", "quality.*").collect()
    for r in got:
        want = brute_rules(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["llr"] >= quality_rules.THRESHOLD)
    plain = quality_rules.quality_rules(df, trusted.limit(0)).select("quality.*").collect()
    assert all(r["llr"] == 0 and r["kept"] == (not r["base_failed"]) for r in plain)


def xx(value, seed=42):
    """Spark's xxhash64 of a string or a number, by another library."""
    out = xxhash.xxh64_intdigest(value.encode() if isinstance(value, str) else struct.pack("<q", value), seed & (2**64 - 1))
    return out - 2**64 if out >= 2**63 else out


def brute_grams(text):
    h = [xx(w) for w in regex.findall(quality_rules.TOKEN, text or "")]
    int_hash = lambda n, seed: (lambda v: v - 2**64 if v >= 2**63 else v)(xxhash.xxh64_intdigest(struct.pack("<i", n), seed & (2**64 - 1)))
    return h + [int_hash(2, xx(b, xx(a)) if b is not None else xx(a)) for a, b in zip(h, [*h[1:], None])]


def test_likelihood_ratio_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, DATA, "documents").limit(40).collect()] + [(None, "good words"), (1, None), (7, "good # words"), (7, "good # words")]
    trusted = [r[0] for r in rows[:15]] + [7, 7, None, 10**12]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, Quality string")
    keys = spark.createDataFrame([(k,) for k in trusted], "doc_id long")
    n = quality_rules.n_buckets(df)
    assert n == ceil(4 * sqrt(sum(len(t or "") for _, t in rows)))
    raw, good = Counter(), Counter()
    for k, t in rows:
        found = Counter(g % n for g in brute_grams(t))
        raw += found
        if k is not None and k in trusted:
            good += found
    want = [np.log((good[b] + 1) / (good.total() + n)) - np.log((raw[b] + 1) / (raw.total() + n)) for b in range(n)]
    assert np.allclose(quality_rules.fit_ratio(df, keys), want, atol=1e-6)
    got = quality_rules.quality_rules(df, keys)
    assert got.columns == ["doc_id", "text", "Quality", "quality_"]
    scores = Counter((r["doc_id"], r["text"], round(r["llr"], 5)) for r in got.select("doc_id", "text", "quality_.llr").collect())
    assert scores == Counter((k, t, round(float(np.mean([want[g % n] for g in x])) if (x := brute_grams(t)) else 0.0, 5)) for k, t in rows)
    assert quality_rules.quality_rules(df.limit(0), keys).count() == 0


def test_likelihood_ratio_counts_every_trusted_row(spark):
    df = spark.range(31_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 30_000, "good").otherwise("bad").alias("text"))
    df = df.unionByName(spark.createDataFrame([(None, "good")], "doc_id long, text string"))
    ratio = quality_rules.fit_ratio(df, spark.range(30_000).unionByName(spark.range(50)), buckets=64)
    of = lambda good, raw: np.log((good + 1) / (60_000 + 64)) - np.log((raw + 1) / (62_002 + 64))
    assert np.isclose(ratio[xx("good") % 64], of(30_000, 30_001), rtol=0, atol=1e-6)
    assert np.isclose(ratio[xx("bad") % 64], of(0, 1_000), rtol=0, atol=1e-6)


def test_license_notices_wrapped_over_lines(spark):
    import textwrap

    def wrapped(notice):
        return "\n".join("# " + x for x in textwrap.wrap(notice, 72))

    rows = []
    for k, (_, notice) in enumerate(license_scan.TEMPLATES):
        rows.append((10 * k, f"other words first\nand so on {wrapped('Copyright 2020 by A. ' + notice + ' and more of it')}\nother words last"))
        rows.append((10 * k + 1, wrapped(notice.replace(" ", " very much so ", 4))))  # longer than the template, one paragraph
        need = -(-9 * len(set(license_scan.words_of(notice))) // 10)
        half = " ".join(notice.split()[: need // 2])
        rows.append((10 * k + 2, wrapped(half) + "\n\n" + "\n".join(["x y z"] * 60) + "\n\n" + wrapped(notice[len(half) :])))  # torn apart
    got = {r["doc_id"]: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for k, (label, _) in enumerate(license_scan.TEMPLATES):
        for i in (0, 1):
            assert label in got[10 * k + i]["labels"].split(",") and got[10 * k + i]["score"] == 1.0
        assert k not in [m["template"] for m in got[10 * k + 2]["matches"]]


def test_stashed_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda spark: f"{tmp_path}/own")
    assert common.stash(spark.range(3)).count() == 3 and (tmp_path / "own").exists()
    common.drop_shared(spark)
    assert not (tmp_path / "own").exists()


def test_rows_with_a_key_of_their_own_that_stay_are_not_joined(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(1, text(1)), (2, text(2)), (3, text(1)), (4, text(4)), (4, text(5)), (6, ""), (None, text(7)), (None, text(2))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.drop_near_duplicates(docs)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got.collect() if r["doc_id"] != 4) == sorted([(1, text(1)), (2, text(2)), (6, ""), (0, text(7)), (0, text(2))])
    assert [r["text"] in (text(4), text(5)) for r in got.where("doc_id = 4").collect()] == [True]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Scan" in plan[plan.index("Union") : plan.index("Join")]
