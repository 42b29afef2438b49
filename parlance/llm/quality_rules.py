"""Operator 10, quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Every document is scored by the mean over its hashed uni- and bigrams of log(p_trusted / p_raw). Both multinomials count every
n-gram of all documents and of all trusted ones. All work is native Spark SQL.

Size of the model: by Heaps' law a corpus of n characters has some multiple of sqrt(n) distinct words, so the model has
GROWTH * sqrt(n) buckets, and a bucket mixes about as many words at any size. It's one array of 4-byte numbers in one row:
0.6 MB for 1.5 * 10^9 characters and 160 MB for 10^14, which bounds what the scoring job broadcasts.

Edge cases: a null or empty text has no words, fails the base rules and is not kept. Repeated rows are scored one by one; a
trusted key trusts all rows with it. Rows without key are counted as raw text. Without trusted rows (no labels, or none that
are good) the ratio is 0 everywhere and only the base rules decide. Extra columns stay; where one is called like the output,
the output's name gets underscores. An empty table gives none.
"""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import WORD, fresh, let, stash, text_or_empty

#: Words and runs of other visible characters are tokens of the ratio.
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"
BLANKS = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Buckets of the model for each unit of the square root of the corpus's characters.
GROWTH = 4.0
SMOOTHING = 1.0
THRESHOLD = -0.8
#: Bits of the filter that trusted keys are looked up in first: 16 MB at any size.
BITS = 1 << 27
_PART = 32_768


def without(text: Column, characters: str, instead: str = "") -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(instead))
    return text


def n_repeat_words(words: Column) -> Column:
    """Words in windows of five that stand at least twice in the text, each word once.

    Most texts have no such window: as many distinct ones as there are. For the others, windows are sorted by their hash,
    those with an equal neighbour are kept, and their starts in order tell how many words they cover together.
    """
    rest = lambda x, k: F.slice(x, k, 1 << 30)
    joined = lambda a, b: F.xxhash64(a, b)

    def of(hashes: Column) -> Column:
        twos = lambda h: F.zip_with(h, rest(h, 2), joined)
        windows = let(twos(hashes), lambda two: F.zip_with(F.zip_with(two, rest(two, 3), joined), rest(hashes, 5), joined))
        full = F.slice(windows, 1, F.size(hashes) - 4)  # zip_with fills the shorter side up with nulls
        return F.when(F.size(hashes) >= 6, let(full, counted)).otherwise(F.lit(0).cast("long"))

    def counted(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(placed, covered)).otherwise(F.lit(0).cast("long"))

    def covered(ordered: Column) -> Column:
        hash_at = lambda k: F.get(ordered, k)["h"]
        twice = F.filter(ordered, lambda x, k: x["h"].eqNullSafe(hash_at(k - 1)) | x["h"].eqNullSafe(hash_at(k + 1)))
        return F.aggregate(
            F.sort_array(F.transform(twice, lambda x: x["i"])),
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-5).alias("last")),
            lambda acc, p: F.struct((acc["n"] + F.least(F.lit(5), p - acc["last"])).alias("n"), p.alias("last")),
            lambda acc: acc["n"],
        )

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def base_counts(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    blank = without(text, BLANKS, " ")
    return F.struct(
        F.length(F.replace(blank, F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        let(F.array_remove(F.split(blank, " "), ""), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), n_repeat_words(w).alias("n_repeat_words"))).alias("words"),
    )


def tokens(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda w: F.xxhash64(w))


def pairs(hashes: Column) -> Column:
    """Hashes of the bigrams; the last one is that of the last token and the text's end."""
    return F.zip_with(hashes, F.slice(hashes, 2, 1 << 30), lambda a, b: F.xxhash64(a, b, F.lit(2)))


def grams(hashes: Column) -> Column:
    return F.concat(hashes, pairs(hashes))


def n_buckets(docs: DataFrame, text: str = "text", growth: float = GROWTH) -> int:
    """growth times the square root of the corpus's characters."""
    return ceil(growth * sqrt(docs.agg(F.sum(F.length(text))).first()[0] or 1))


def key_filter(keys: DataFrame) -> DataFrame:
    """One row, one column `bits`: a bitmap of the keys' hashes, of one size however many keys there are."""
    (key,) = keys.columns
    bits = keys.select(F.pmod(F.xxhash64(key), F.lit(BITS)).alias("bit"))
    parts = bits.groupBy(F.floor(F.col("bit") / _PART).cast("int").alias("part")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit + 1))").alias("bits"))
    return parts.agg(F.map_from_entries(F.collect_list(F.struct("part", "bits"))).alias("bits"))


def count_grams(docs: DataFrame, trusted: DataFrame, text: str, key: str, buckets: int) -> DataFrame:
    """b, raw, good: how many n-grams of all and of trusted documents fall into each bucket that has any.

    trusted: one column with keys of trusted documents. They grow with the corpus, so they aren't broadcast: documents that a
    bitmap of the keys' hashes lets through meet the keys in a shuffled join; all other texts are counted where they are.
    """
    ids = stash(trusted.select(F.col(trusted.columns[0]).alias("_key")).where("_key is not null").distinct())
    mask = stash(key_filter(ids))
    rows = docs.select(F.col(key).alias("_key"), text_or_empty(text).alias("_text"))
    bit = F.pmod(F.xxhash64("_key"), F.lit(BITS))
    part = F.col("bits")[F.floor(bit / _PART).cast("int")]
    place = (bit % _PART).cast("int")
    byte = F.conv(F.hex(F.substring(part, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(F.getbit(byte.cast("long"), place % 8) == 1, F.lit(False))
    rows = rows.join(F.broadcast(mask), how="cross")  # one row of at most 16 MB
    known = rows.where(maybe).select("_key", "_text").join(ids.withColumn("_good", F.lit(1)).hint("shuffle_hash"), "_key", "left").select("_text", "_good")
    rows = known.unionByName(rows.where(~maybe).select("_text", F.lit(None).cast("int").alias("_good")))
    each = rows.select("_good", F.explode(let(tokens(F.col("_text")), grams)).alias("h"))
    return stash(each.groupBy(F.pmod("h", F.lit(buckets)).cast("int").alias("b")).agg(F.count("*").alias("raw"), F.count("_good").alias("good")))


def ratio_table(docs: DataFrame, trusted: DataFrame, text: str, key: str, buckets: int, smoothing: float = SMOOTHING) -> DataFrame:
    """One row, one column `ratios`: log(p_trusted / p_raw) of every bucket from 0 on, 0 everywhere without n-grams of trusted documents."""
    counts = count_grams(docs, trusted, text, key, buckets)
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("all_raw"), F.coalesce(F.sum("good"), F.lit(0)).alias("all_good"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"))
    log_p = lambda n, n_all: F.log((F.coalesce(F.col(n), F.lit(0)) + smoothing) / (F.col(n_all) + smoothing * buckets))
    ratio = F.when(F.col("all_good") > 0, log_p("good", "all_good") - log_p("raw", "all_raw")).otherwise(F.lit(0.0))
    ratios = every.join(counts, "b", "left").join(F.broadcast(total), how="cross").select("b", ratio.cast("float").alias("ratio"))
    return stash(ratios.agg(F.transform(F.array_sort(F.collect_list(F.struct("b", "ratio"))), lambda x: x["ratio"]).alias("ratios")))


def fit_ratio(docs: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id", buckets: int | None = None, smoothing: float = SMOOTHING) -> list[float]:
    """The ratios in the order of their buckets."""
    return ratio_table(docs, trusted, text, key, buckets or n_buckets(docs, text), smoothing).first()["ratios"]


def llr(text: Column, ratios: Column) -> Column:
    """Mean log ratio of a text's n-grams, 0 without any."""

    def of(both: Column) -> Column:
        h, r = both["h"], both["r"]
        total = F.aggregate(grams(h), F.lit(0.0), lambda acc, x: acc + F.get(r, F.pmod(x, F.size(r)).cast("int")))
        return F.when(F.size(h) > 0, total / (2 * F.size(h))).otherwise(F.lit(0.0))

    return let(F.struct(tokens(text).alias("h"), ratios.alias("r")), of)


def verdict(base: Column, llr: Column, threshold: float = THRESHOLD) -> Column:
    """Struct of the base counts, llr, base_failed and kept."""
    n, again = base["words"]["n_words"], base["words"]["n_repeat_words"]
    failed = (n < 10) | (100 * again > 20 * n)
    plain = [base[c].alias(c) for c in ("word_chars", "n_symbols", "n_dup_lines")]
    return F.struct(n.alias("n_words"), *plain, again.alias("n_repeat_words"), llr.alias("llr"), failed.alias("base_failed"), (~failed & (llr >= threshold)).alias("kept"))


def quality_rules(docs: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, buckets: int | None = None, out: str = "quality") -> DataFrame:
    """docs with a struct column `out`: the base counts, llr, base_failed and kept (the base rules pass and llr is at least the threshold).

    buckets: how many the model has; by default as many as `n_buckets` says.
    """
    buckets = buckets or n_buckets(docs, text)
    base, score, ratios, (out,) = *(names := fresh(docs, ["_base", "_llr", "_ratios"])), fresh(docs, [out])
    # a scalar subquery is a constant of the job: no row carries the model
    rows = docs.withColumn(ratios, ratio_table(docs, trusted, text, key, buckets).scalar())
    rows = rows.withColumns({base: base_counts(text_or_empty(text)), score: llr(text_or_empty(text), F.col(ratios))})
    return rows.withColumn(out, verdict(F.col(base), F.col(score), threshold)).drop(*names)


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("quality") == 1).select("doc_id")
