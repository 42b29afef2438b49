r"""Operator 9, license scans: exact set-similarity join of text blocks with license templates. Native.

A block is a line, or it crosses line ends (\n or \r\n): a paragraph (lines up to one without words), or a run of lines, from any line on, of
which those between the first and the last are no longer than the template. It matches a template where it holds at least
`threshold` of the template's distinct words. Lines that match alone are no part of longer blocks for the same template. Words are
ordered by how many documents hold them, rarest first; a block that matches must hold one of the first |T| - need + 1 words
of the template (prefix), must be long enough (length), and the words left after the first shared one must still suffice
(position). What passes is confirmed on the whole sets. Only words of templates matter, so frequencies, prefixes and the
join's right side are bounded by the templates, not by the corpus.

Edge cases: a null text is empty: no words, no labels, score 0. Repeated rows are scanned one by one. Empty tables give none.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import ascii_lower, literal, stash, text_or_empty

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.9

# The phrases of the base rule.
PHRASES = {
    "mit": "mit license",
    "apache": "apache license",
    "gpl": "general public license",
}

# Notices of public licenses, and the whole texts of short ones.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
]


def words_of(text: str) -> list[str]:
    import re

    return re.findall(r"[a-z0-9]+", text.lower())


def places(words: Column, phrases: dict[str, str] = PHRASES) -> Column:
    """array<struct<label, pos>>: where a phrase's words stand one after the other."""

    def of(label: str, phrase: str) -> Column:
        parts = phrase.split(" ")
        hit = lambda w, i: reduce(lambda a, b: a & b, [F.get(words, i - (len(parts) - 1 - k)) == p for k, p in enumerate(parts[:-1])], w == parts[-1])
        found = F.transform(words, lambda w, i: F.when((i >= len(parts) - 1) & hit(w, i), F.struct(F.lit(label).alias("label"), (i - (len(parts) - 1)).cast("long").alias("pos"))))
        return F.filter(found, lambda x: x.isNotNull())

    return F.concat(*[of(k, v) for k, v in phrases.items()])


def crossing(rows: DataFrame, templates: list[list[str]], need: list[int]) -> DataFrame:
    """row, line, words, only: blocks over several lines and the template that each is for. rows: row, parts (n, words of each line)."""
    w = Window.partitionBy("row").orderBy("line")  # no longer than a document
    lines = rows.select("row", F.posexplode("parts").alias("line", "p")).select("row", "line", "p.n", "p.words")
    lines = lines.withColumns({"at": F.sum("n").over(w) - F.col("n"), "para": F.sum((F.col("n") == 0).cast("int")).over(w)}).where(F.size("words") > 0)
    want, length = (F.get(literal(x, "array<int>"), F.col("only")) for x in (need, [len(x) for x in templates]))
    each = lines.withColumn("only", F.explode(F.sequence(F.lit(0), F.lit(len(templates) - 1))))
    each = each.withColumn("words", F.array_intersect("words", F.get(literal(templates, "array<array<string>>"), F.col("only")))).where((F.size("words") > 0) & (F.size("words") < want))
    line = F.struct("line", "at", "n", "para", "words")
    held = lambda x: F.array_distinct(F.flatten(F.transform(x, lambda y: y["words"])))
    paras = each.groupBy("row", "only", "para").agg(F.collect_list(line).alias("x")).select("row", F.array_min(F.transform("x", lambda y: y["line"])).alias("line"), held(F.col("x")).alias("words"), "only")
    # a line holds a word at least, so a run has no more lines than the template has words
    run = lambda x, i: F.filter(F.slice("c", i + 1, length), lambda y: y["at"] <= x["at"] + x["n"] + length - 2)
    runs = each.groupBy("row", "only").agg(F.array_sort(F.collect_list(line)).alias("c"))
    runs = runs.select("row", "only", F.explode(F.filter(F.transform("c", lambda x, i: F.struct(x["line"].alias("line"), held(run(x, i)).alias("words"))), lambda x: F.size(x["words"]) >= want)).alias("b"))
    return paras.where(F.size("words") >= want).unionByName(runs.select("row", "b.line", "b.words", "only"))


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: key, n_words, n_base, first_word, last_word, base_labels, labels, score, matches.

    matches: array<struct<line, label, template, share>>, the blocks that match templates. score: the largest share of a
    template held by a block, 1 where a base phrase stands, else 0.
    """
    sets = [sorted(set(words_of(x))) for _, x in templates]
    tokens = sorted({w for x in sets for w in x})
    need = [ceil(threshold * len(x) - 1e-9) for x in sets]
    known = literal(tokens, "array<string>")

    df = docs.select(F.col(key).alias("key"), ascii_lower(text_or_empty(text)).alias("t"))
    df = df.withColumn("lines", F.transform(F.split("t", "\n"), lambda x: F.regexp_extract_all(x, F.lit(WORD), F.lit(0))))
    df = df.withColumns({
        "n_words": F.aggregate("lines", F.lit(0).cast("long"), lambda acc, x: acc + F.size(x)),
        "every_word": F.array_intersect(F.flatten("lines"), known),
        "_licensed": F.col("t").contains("license"),
    })
    df = df.withColumn("words", F.when(F.col("_licensed"), F.flatten("lines")))
    # a block can't hold what its document doesn't: most documents are done here
    whole = F.transform(literal(sets, "array<array<string>>"), lambda x: F.size(F.array_intersect(x, F.col("every_word"))))
    df = df.withColumn("_enough", F.exists(F.zip_with(whole, literal(need, "array<int>"), lambda a, b: a >= b), lambda x: x))
    df = df.withColumn("held", F.when(F.col("_enough"), F.transform("lines", lambda x: F.array_intersect(x, F.col("every_word")))))
    parts = F.when((F.size("lines") > 1) & F.col("_enough"), F.zip_with("lines", "held", lambda x, h: F.struct(F.size(x).alias("n"), h.alias("words"))))
    blocks = F.filter(F.transform("held", lambda x, i: F.struct(i.alias("line"), x.alias("words"))), lambda x: F.size(x["words"]) >= min(need))
    row = F.monotonically_increasing_id()
    df = stash(df.select(row.alias("row"), "key", "n_words", F.coalesce(places(F.col("words")), literal([], "array<struct<label:string,pos:bigint>>")).alias("places"), F.col("every_word").alias("held"), blocks.alias("blocks"), parts.alias("parts")))

    # how many documents hold each template word: at most as many rows as the templates have words
    held = dict(df.select(F.explode("held").alias("w")).groupBy("w").count().collect())
    rank = {w: i for i, w in enumerate(sorted(tokens, key=lambda w: (held.get(w, 0), w)))}
    ranked = [sorted(rank[w] for w in x) for x in sets]
    posts = [(r, p, t) for t, x in enumerate(ranked) for p, r in enumerate(x[: len(x) - need[t] + 1])]
    spark = docs.sparkSession
    post = spark.createDataFrame(posts, "r int, t_pos int, template int")

    ranks = literal(rank, "map<string,int>")
    block = df.select("row", F.explode("blocks").alias("b")).select("row", "b.line", "b.words", F.lit(-1).alias("only"))
    block = block.unionByName(crossing(df.where("parts is not null"), [words_of(x) for _, x in templates], need))
    block = block.select("row", "line", "only", F.array_sort(F.transform("words", lambda w: F.element_at(ranks, w))).alias("ranks"))
    size, want = literal([len(x) for x in sets], "array<int>"), literal(need, "array<int>")
    label, all_ranks = literal([x for x, _ in templates], "array<string>"), literal(ranked, "array<array<int>>")
    pairs = block.select("*", F.posexplode("ranks").alias("b_pos", "r")).join(F.broadcast(post), "r")  # post: fewer rows than the templates have words
    pairs = pairs.where((F.col("only") == -1) | (F.col("only") == F.col("template"))).where(F.size("ranks") >= F.get(want, F.col("template")))
    left = 1 + F.least(F.size("ranks") - F.col("b_pos") - 1, F.get(size, F.col("template")) - F.col("t_pos") - 1)
    # the first shared word of a pair is the one whose position bounds what they can share; later ones only repeat the pair
    shared = F.array_intersect("ranks", F.get(all_ranks, F.col("template")))
    pairs = pairs.where(left >= F.get(want, F.col("template"))).where(F.get(shared, F.lit(0)) == F.col("r")).where(F.size(shared) >= F.get(want, F.col("template")))
    match = F.struct(F.col("line"), F.get(label, F.col("template")).alias("label"), F.col("template"), (F.size(shared) / F.get(size, F.col("template"))).alias("share"))
    found = pairs.select("row", match.alias("m")).groupBy("row").agg(F.array_sort(F.collect_set("m")).alias("matches"))

    none = literal([], "array<struct<line:int,label:string,template:int,share:double>>")
    out = df.drop("held", "blocks", "parts").join(found, "row", "left").withColumn("matches", F.coalesce("matches", none))
    where = F.transform("places", lambda x: x["pos"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda x: x["label"])))
    every = F.array_sort(F.array_distinct(F.concat(F.transform("places", lambda x: x["label"]), F.transform("matches", lambda x: x["label"]))))
    best = F.coalesce(F.array_max(F.transform("matches", lambda x: x["share"])), F.lit(0.0))
    return out.select(
        F.col("key").alias(key), "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(where).alias("first_word"), F.array_max(where).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"), "matches",
    )
