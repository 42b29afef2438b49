"""Operator 4, mixing sources to target weights: capped water-filling and seeded whole and fractional repetitions. Native.

Targets are min(cap_i, level * weight_i) with the one level that spends the budget: sources are walked in order of
cap / weight, and those below the level are clamped. That is the end of the usual loop (clamp, reshare, repeat) in one window
over the table of sources.

Repetitions: each document is taken floor(target / source size) whole times. What is still missing is taken from documents
in an order seeded by a digest of (seed, key): all words of those before the quota ends, the first words of the one that it
ends in. A source is never sorted whole: it is cut into 65,536 slices by digest, slice totals tell the slice the quota ends in,
and only that slice's rows are ordered. What meets the documents is one row per source: no text is shuffled for its decision.

Edge cases: a null text has size 0. A null source is a source of its own, ranked last. Sources without words get target 0.
Repeated rows with one key share a digest and are ordered by size; where the quota ends in equal ones, they share what is left
evenly (less than a word each is lost). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import WORD, stash

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
EPOCHS = 2
SEED = "mix-1"
DIGITS = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """totals (one row per source: source, total, weight) with target. Rows are as many as there are sources."""
    everything = Window.partitionBy(F.lit(0))
    walk = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = walk.rowsBetween(Window.unboundedPreceding, -1)
    df = totals.withColumn("cap", F.col("total") * F.lit(float(epochs)))
    df = df.withColumns({
        "_budget": F.sum("total").over(everything) * F.lit(float(share)),
        "_capped": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "_open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    df = df.withColumn("_level", (F.col("_budget") - F.col("_capped")) / F.col("_open"))
    # the first source whose cap reaches the level of those still open sets it; sources before it are clamped
    fits = F.col("cap") >= F.col("_level") * F.col("weight")
    df = df.withColumn("_final", F.min(F.when(fits, F.struct(F.col("_capped"), F.col("_level"))).otherwise(None)).over(everything)["_level"])
    target = F.when(F.col("_final").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("_final") * F.col("weight")))
    return df.withColumn("target", target).drop("cap", "_budget", "_capped", "_open", "_level", "_final")


def cyclic_weights(totals: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """Weights repeat over the sources in code point order, null last."""
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), "source")) - 1
    return totals.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), rank % len(weights)))


def digest(key: Column, seed: str = SEED) -> Column:
    """The seeded order of a source's documents."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))


def _ends(slices: DataFrame, quotas: DataFrame) -> DataFrame:
    """source, slice and left: the slice in which the running total of a source reaches its quota, and how much of it is left before it."""
    run = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s, q = slices.withColumn("before", F.sum("n").over(run) - F.col("n")).alias("s"), quotas.alias("q")
    found = s.join(q, F.col("s.source").eqNullSafe(F.col("q.source"))).where((F.col("before") < F.col("left")) & (F.col("left") <= F.col("before") + F.col("n")))
    return found.select("s.source", "s.slice", (F.col("left") - F.col("before")).alias("left"))


def plan(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """One row per source: source, source_size, target, times (whole copies of each document) and cut.

    sizes: key, source, size, digest. cut: the place in the seeded order at which the fractional copy ends, and `words`, how many
    words it takes of the row there; null where no row is cut into (then nothing is missing, or nothing is left).
    """
    sizes = sizes.withColumn("slice", F.substring("digest", 1, 2 * DIGITS))
    slices = stash(sizes.groupBy("source", "slice").agg(F.sum("size").alias("n")))
    totals = targets(cyclic_weights(slices.groupBy("source").agg(F.sum("n").alias("total"))), share, epochs)
    times = F.when(F.col("total") > 0, F.floor(F.col("target") / F.col("total"))).otherwise(F.lit(0)).cast("long")
    totals = stash(totals.withColumn("times", times).withColumn("quota", F.round("target").cast("long") - F.col("times") * F.col("total")))

    # the slice in which each source's quota ends, and what is left of the quota there: first among the 256 of two digits, then
    # among the 256 that begin with those
    wide = slices.groupBy("source", F.substring("slice", 1, DIGITS).alias("slice")).agg(F.sum("n").alias("n"))
    ends = stash(_ends(wide, totals.select("source", F.col("quota").alias("left"))))
    inside = slices.withColumn("wide", F.substring("slice", 1, DIGITS)).alias("s")
    e = ends.alias("e")
    inside = inside.join(e, F.col("s.source").eqNullSafe(F.col("e.source")) & (F.col("s.wide") == F.col("e.slice"))).select("s.source", "s.slice", "s.n")
    ends = stash(_ends(inside, ends.select("source", "left")))
    t = totals.alias("t")

    # the row of that slice in which it ends; equal rows (one digest, key and size) share what is left evenly
    d, e = sizes.where("size > 0").alias("d"), ends.alias("e")
    rows = d.join(e, F.col("d.source").eqNullSafe(F.col("e.source")) & (F.col("d.slice") == F.col("e.slice")))
    equal = rows.groupBy(F.col("d.source").alias("source"), "digest", "key", "size", "left").agg(F.count("*").alias("copies"))
    order = Window.partitionBy("source").orderBy("digest", "key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    equal = equal.withColumn("all", F.col("size") * F.col("copies")).withColumn("before", F.sum("all").over(order) - F.col("all"))
    cut = equal.where((F.col("before") < F.col("left")) & (F.col("left") <= F.col("before") + F.col("all")))
    place = F.struct("digest", "key", "size", F.expr("(left - before) div copies").alias("words"))
    cut = cut.select("source", place.alias("cut")).alias("c")
    out = t.join(cut, F.col("t.source").eqNullSafe(F.col("c.source")), "left")
    return stash(out.select("t.source", F.col("total").alias("source_size"), "target", "times", "cut"))


def planned(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows (source, key, size, digest and more) with source_size, target, times and more: the words of the fractional copy."""
    r, p = rows.alias("r"), sources.withColumnRenamed("source", "_source").alias("p")
    here, end = F.struct("r.digest", "r.key", "r.size"), F.struct("p.cut.digest", "p.cut.key", "p.cut.size")
    more = F.when(F.col("p.cut").isNull(), F.lit(0)).when(here < end, F.col("r.size")).when(here == end, F.col("p.cut.words")).otherwise(F.lit(0))
    joined = r.join(p, F.col("r.source").eqNullSafe(F.col("p._source")))
    return joined.select("r.*", "source_size", "target", "times", F.coalesce(more, F.lit(0)).cast("long").alias("more"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document: key, size, source_size, target (its source's) and taken (words the mix takes)."""
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(key).alias("_key"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"), digest(F.col(key), seed).alias("digest"))
    rows = stash(rows)
    out = planned(rows, plan(rows, weights, share, epochs))
    return out.select(F.col("_key").alias(key), "size", "source_size", "target", (F.col("times") * F.col("size") + F.col("more")).alias("taken"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: docs' rows as often as their source's target asks for, with docs' columns.

    Each whole copy is the row as it is; a fractional copy ends after its last word. Rows of which the mix takes no word go. A
    column n_chars, where docs has one, is set to the length of the fractional copy's text.
    """
    own, facts = "_row", ["key", "source", "size", "digest"]
    one = [F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"), digest(F.col(key), seed).alias("digest")]
    sources = plan(stash(docs.select(*one)), weights, share, epochs)
    rows = planned(docs.select(*one, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(own)), sources)
    # cuts: words of each copy, null for a whole one
    part = F.when((F.col("more") > 0) & (F.col("more") < F.col("size")), F.array(F.col("more").cast("int"))).otherwise(F.array().cast("array<int>"))
    wholes = F.when(F.col("size") > 0, F.col("times") + (F.col("more") == F.col("size")).cast("long")).otherwise(F.lit(0)).cast("int")
    copies = F.concat(F.array_repeat(F.lit(None).cast("int"), wholes), part)
    rows = rows.select(own, F.explode(copies).alias("_words"))
    body = F.col(f"{own}.{text}")
    pattern = F.concat(F.lit(r"^(?:[\x20\x09-\x0D]*+" + WORD + r"+){"), F.col("_words").cast("string"), F.lit("}+"))
    ended = F.when(F.col("_words").isNull(), body).otherwise(F.regexp_substr(body, pattern))
    out = []
    for c in docs.columns:
        field = F.col(f"{own}.`{c}`")
        if c == text:
            field = ended
        elif c == "n_chars":
            field = F.when(F.col("_words").isNull(), field).otherwise(F.length(ended).cast(dict(docs.dtypes)[c]))
        out.append(field.alias(c))
    return rows.select(*out)
