"""Labelling of summaries with a closed vocabulary: one answer per distinct summary, kept under its digest, the first answer wins."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.events import UNTYPED

BATCH = 50
# Characters that join two things in a name.
JOINING = "与和及、/／"

#: summaries and the vocabulary's type ids -> (index, type id) pairs, or an exception
Classifier = Callable[[list[str], Sequence[str]], list[tuple[int, str]]]


def vocabulary_faults(taxonomy: DataFrame) -> DataFrame:
    """type_id and fault for everything wrong with a vocabulary, all at once."""
    rules = {
        "reserved id": F.col("type_id") == UNTYPED,
        "id": ~F.coalesce(F.col("type_id").rlike(r"\A[a-z0-9_]{1,64}\z"), F.lit(False)),
        "repeated id": F.col("_same") > 1,
        "name": F.coalesce(F.trim("name") == "", F.lit(True)) | (F.length("name") > 128) | F.col("name").rlike(r"[\r\n]"),
        "name joins": F.col("name").rlike(f"[{JOINING}]"),
        "parent": F.coalesce(F.trim("parent_name") == "", F.lit(True)) | (F.length("parent_name") > 64) | F.col("parent_name").rlike(r"[\r\n]"),
        "parent joins": F.col("parent_name").rlike(f"[{JOINING}]"),
        "description": F.coalesce(F.trim("description") == "", F.lit(True)) | (F.length("description") > 200) | F.col("description").rlike(r"[\r\n]"),
    }
    counted = taxonomy.withColumn("_same", F.count("*").over(Window.partitionBy("version", "type_id")))
    faults = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return counted.select("version", "type_id", F.explode(faults).alias("fault")).distinct()


def prompt(types: Sequence[tuple[str, str, str, str]]) -> str:
    """The closed list, by parent. types: type_id, parent_name, name, description."""
    lines, parent = [], None
    for type_id, group, name, text in sorted(types, key=lambda x: (x[1], x[0])):
        if group != parent:
            lines.append(f"## {group}")
            parent = group
        lines.append(f"- {type_id} {name}: {text}")
    return "\n".join(lines)


def fingerprint(version: str, text: str, settings: Mapping[str, object]) -> str:
    """Key of the answers that one vocabulary, prompt and model setting give: another one asks anew."""
    return sha256(json.dumps([version, text, dict(settings)], sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def usable(cache: DataFrame, key: str, types: Sequence[str]) -> DataFrame:
    """digest and event_type of a cache's answers under a key (columns made_by, digest, event_type); a label outside the closed list is an error."""
    own = cache.where(F.col("made_by") == key)
    odd = own.where(~F.coalesce(F.col("event_type").isin([*types, UNTYPED]), F.lit(False))).select("digest", "event_type").take(1)
    if odd:
        raise ValueError(f"a saved answer isn't a label: {odd[0]['event_type']}")
    return own.select("digest", "event_type")


def checked(found: list[tuple[int, str]], n: int, known: Sequence[str]) -> list[str]:
    """One label for each of n summaries in order, or a ValueError: unknown type, index out of range, twice or missing."""
    closed, out = {*known, UNTYPED}, {}
    for i, label in found:
        if not 0 <= i < n or i in out or label not in closed:
            raise ValueError(f"answer {i}: {label}")
        out[i] = label
    if len(out) != n:
        raise ValueError(f"{n - len(out)} summaries without answer")
    return [out[i] for i in range(n)]


def answers(summaries: DataFrame, cache: DataFrame, classify: Classifier, types: Sequence[str], version: str, batch: int = BATCH) -> DataFrame:
    """digest and event_type for summaries that the cache lacks; batches that fail twice have null labels and are tried next time.

    summaries: column summary. cache: digest, event_type. Version v0 has an empty vocabulary and labels nothing.
    """
    new = summaries.select("summary").distinct().withColumn("digest", F.sha2("summary", 256)).join(cache, "digest", "left_anti")
    if version == "v0":
        return new.select("digest", F.lit(UNTYPED).alias("event_type"))

    def ask(texts: list[str]) -> list[str] | None:
        for _ in range(2):
            try:
                return checked(classify(texts, types), len(texts), types)
            except ValueError:
                continue
        return None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                yield pd.DataFrame({"digest": part["digest"], "event_type": ask(part["summary"].tolist()) or [None] * len(part)})

    return new.select("digest", "summary").mapInPandas(run, "digest string, event_type string")


def first_answers(cache: DataFrame, found: DataFrame) -> DataFrame:
    """The cache with new answers; an answer that is there already stays."""
    good = found.where("event_type is not null").groupBy("digest").agg(F.min("event_type").alias("event_type"))
    return cache.unionByName(good.join(cache, "digest", "left_anti").select(*cache.columns))


def labelled(events: DataFrame, cache: DataFrame, version: str) -> DataFrame:
    """events with label and version from the cache; both null where there is no answer yet."""
    known = cache.select("digest", F.col("event_type").alias("_label"))
    out = events.withColumn("digest", F.sha2("summary", 256)).join(known, "digest", "left")
    return out.withColumns({"event_type": F.col("_label"), "taxonomy_version": F.when(F.col("_label").isNotNull(), F.lit(version))}).drop("_label", "digest")


def publishable_days(events: DataFrame) -> DataFrame:
    """Room-days all of whose events are labelled."""
    return events.groupBy("corpid", "roomid", F.col("occurred_on").alias("dt")).agg(F.bool_and(F.col("event_type").isNotNull()).alias("done")).where("done").drop("done")


def disagreements(events: DataFrame, cache: DataFrame) -> DataFrame:
    """Saved labels that aren't the cache's answer, or half of a label pair."""
    saved = events.select("id", "event_type", "taxonomy_version", F.sha2("summary", 256).alias("digest"))
    known = cache.select("digest", F.col("event_type").alias("answer"))
    half = F.col("event_type").isNull() != F.col("taxonomy_version").isNull()
    return saved.join(known, "digest", "left").where(half | (F.col("event_type") != F.col("answer")))


def review(counts: DataFrame, cache: DataFrame, samples: int = 3, untyped_samples: int = 40, types: DataFrame | None = None) -> DataFrame:
    """Per label: events, distinct summaries, share of all events, and its most frequent summaries. counts: summary, n.

    The label for what fits nowhere has its row like any other, with more samples: its share tells when a vocabulary is due.
    types: column type_id of the vocabulary; types without events then have a row of zeros.
    """
    rows = counts.withColumn("digest", F.sha2("summary", 256)).join(cache, "digest").select("event_type", "summary", "n")
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("event_type").orderBy(F.desc("n"), "summary")))
    few = F.when(F.col("event_type") == UNTYPED, untyped_samples).otherwise(samples)
    best = ranked.where(F.col("r") <= few).groupBy("event_type").agg(F.array_sort(F.collect_list(F.struct("r", "summary", "n"))).alias("samples"))
    sums = rows.groupBy("event_type").agg(F.sum("n").alias("events"), F.count("*").alias("phrases"))
    if types is not None:
        sums = types.select(F.col("type_id").alias("event_type")).join(sums, "event_type", "full")
    sums = sums.select("event_type", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("events", "phrases")])
    out = sums.crossJoin(sums.agg(F.sum("events").alias("total"))).join(best, "event_type", "left")
    share = F.when(F.col("total") > 0, F.col("events") / F.col("total"))
    return out.select("event_type", "events", "phrases", share.alias("share"), F.coalesce("samples", F.array().cast("array<struct<r:int,summary:string,n:bigint>>")).alias("samples"))
