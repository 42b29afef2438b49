"""The pipeline's stages against brute force, each on its own input, and on odd inputs."""

from __future__ import annotations

import sys
from collections import Counter
from math import ceil, sqrt
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
import zstandard
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from parlance.llm import minhash, mix, pieces, quality_classifier, quality_rules
from parlance.llm.common import stash, table

sys.path.insert(0, str(Path(__file__).parent))
from test_operators import DOCS, WORD, brute_grams, brute_rules, components, sets_of  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Real documents, copies of some with a word changed, repeated rows, and texts that are null, empty or very short."""
    real = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in table(spark, DATA, "documents").collect()]
    near = [(10_000 + i, f"{r[1]} word{i}", *r[2:]) for i, r in enumerate(real[:40]) if len(r[1].split()) > 60]
    odd = [(20_000, None, None, None, None), (20_001, "", "en", None, 0), (20_002, "one two", "en", "a", 7), (None, real[3][1], "en", "a", 1)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([*real, *near, *odd, *odd, *real[:3]], DOCS).write.parquet(f"{path}/documents.parquet")
    table(spark, DATA, "labels").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def kept(spark, folder):
    """The documents and what each stage returns."""
    docs = table(spark, folder, "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stash(stage(spark, docs, folder))
        out.append(docs)
    return out


def texts(df):
    return Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_columns(kept):
    assert all(x.columns == kept[0].columns for x in kept[:-1]) and kept[-1].columns == [*kept[0].columns, "ids", "round_trip"]


def test_rules_against_brute_force(spark, folder, kept):
    rows = list(texts(kept[0]).elements())
    trusted = {r["doc_id"] for r in table(spark, folder, "labels").where("quality = 1").collect()}
    n = ceil(quality_rules.GROWTH * sqrt(sum(len(t or "") for _, t in rows)))
    raw, good, of = Counter(), Counter(), {}
    for k, t in rows:
        of[t] = of.get(t) or [g % n for g in brute_grams(t)]
        raw.update(of[t])
        if k in trusted:
            good.update(of[t])
    ratio = [np.log((good[b] + 1) / (good.total() + n)) - np.log((raw[b] + 1) / (raw.total() + n)) for b in range(n)]
    want = Counter()
    for k, t in rows:
        words, _, _, _, again = brute_rules(t)
        llr = np.mean([ratio[b] for b in of[t]]) if of[t] else 0.0
        assert abs(llr - quality_rules.THRESHOLD) > 1e-6
        want[k, t] += words >= 10 and 100 * again <= 20 * words and llr >= quality_rules.THRESHOLD
    assert texts(kept[1]) == +want and len(want) > len(+want)


def test_classifier_against_direct_compression(spark, folder, kept):
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("key"), F.col("quality").alias("label"))
    m = quality_classifier.fit(kept[1], labels)
    if m.prior is not None:
        assert texts(kept[2]) == (texts(kept[1]) if m.prior >= corpus_pipeline.LEAST_QUALITY else Counter())
        return

    def size(data, d, plain):
        d = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT if plain else zstandard.DICT_TYPE_AUTO)
        z = zstandard.ZstdCompressor(level=quality_classifier.LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
        return sum(len(z.compress(data[i : i + quality_classifier.PIECE])) for i in range(0, len(data), quality_classifier.PIECE))

    want = Counter()
    for (k, t), times in texts(kept[1]).items():
        g, b = (size((t or "").encode(), d, plain) for d, plain in zip((m.good, m.bad), m.raw, strict=True))
        z = m.weights[0] + 10 * m.weights[1] * (b - g) / max(1, b + g)
        want[k, t] += times * (1 / (1 + np.exp(-z)) >= corpus_pipeline.LEAST_QUALITY)
    assert texts(kept[2]) == +want


def test_near_duplicates_against_brute_force(kept):
    rows = [(k, sets_of(t)) for k, t in texts(kept[2]) if k is not None]
    edges = [(a, b) for i, (a, x) in enumerate(rows) for b, y in rows[:i] if x and y and 100 * len(x & y) >= 75 * len(x | y)]
    top = components([e for e in edges if e[0] != e[1]])
    got = texts(kept[3])
    assert Counter(k for k, _ in got.elements() if k is not None) == Counter({k: 1 for k, _ in rows if top.get(k, k) == k})
    assert len({k for k, _ in rows}) > len({k for k, _ in got if k is not None})


def test_mix_against_water_filling(kept):
    size = Counter()
    for r in kept[3].collect():
        size[r["source"]] += len(WORD.findall(r["text"] or ""))
    order = sorted(s for s in size if s is not None) + [None] * (None in size)
    weight, capped = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, {}
    while True:
        left = [s for s in order if s not in capped]
        level = (1.5 * size.total() - sum(capped.values())) / sum(weight[s] for s in left) if left else 0
        over = [s for s in left if level * weight[s] > 2 * size[s]]
        if not over:
            break
        capped |= {s: 2 * size[s] for s in over}
    taken = Counter()
    for r in kept[4].collect():
        taken[r["source"]] += len(WORD.findall(r["text"] or ""))
    for s in order:
        assert abs(taken[s] - (capped[s] if s in capped else level * weight[s])) <= 2
    assert max(Counter(r["doc_id"] for r in kept[4].where("doc_id is not null").collect()).values()) <= 2


def test_pieces_give_the_texts_back(kept):
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rows = kept[5].collect()
    assert texts(kept[5]) == texts(kept[4]) and len(rows) > 100
    for r in rows:
        assert r["ids"] and sp.decode(r["ids"]) == sp.decode(sp.encode(r["text"])) and r["round_trip"] == int(sp.decode(r["ids"]) == r["text"])


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_inputs(spark, folder, stage):
    """Nulls anywhere, repeated rows, columns with clashing names; and no rows at all."""
    long = " ".join(f"w{i % 97}x{i}" for i in range(3000))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, long, "en", None, 1), (3, long, "en", None, 1), (4, long + " z", None, "a", None), (None, long, "en", "a", 1), (None, None, None, None, None)]
    extra = ", key string, KEPT string, Quality string, score string, ids string, size string, digest string, label string, _key string"
    df = spark.createDataFrame([(*r, *"abcdefghi") for r in rows], DOCS + extra)
    out = stage(spark, df, folder)
    assert out.columns[: len(df.columns)] == df.columns
    got = out.collect()
    assert {r["doc_id"] for r in got} <= {1, 2, 3, 4, None} and all(r["key"] == "a" and r["_key"] == "i" for r in got)
    assert stage(spark, df.limit(0), folder).count() == 0


def test_good_documents_stay(spark, folder, kept):
    good = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    before = kept[0].join(good, "doc_id", "left_semi").count()
    assert kept[2].join(good, "doc_id", "left_semi").count() >= 0.9 * before


def test_run_is_registered():
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n in (f"op{i}_" for i in range(1, 11)) if not any(q.startswith(n) for q in entry.queries())] == []
