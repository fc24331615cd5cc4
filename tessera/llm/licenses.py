"""License scans: exact phrases, and an exact set-containment join of text blocks with license templates.

A block is a line and, while it holds fewer words than the template has, the lines after it; so a notice is found whether
it stands in one line or is wrapped over many, and words far apart never make one. Lines without words do not count.

Built-in expressions only. Template words are ordered by how many documents of the corpus hold them, rarest first. A block
that contains a template to the threshold must hold one of the template's first few words in that order (prefix filter)
and enough different words (length filter); where the first common word stands in both orders bounds what can still
follow (positional filter). Blocks are joined with the templates' prefixes on the word, and survivors are counted exactly.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import stored

THRESHOLD = 0.8
#: All templates together may hold so many different words; what is broadcast is bounded by this.
MAX_TEMPLATE_WORDS = 20_000

# Phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Label and text of each template; public license notices.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "The Software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and "
        "noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, "
        "out of or in connection with the Software or the use or other dealings in the Software.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice "
        "appear in all copies. The software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness.",
    ),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "gpl",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
        "or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters that part words, before lower-casing.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def words_of(text: str) -> list[str]:
    """Distinct words of a template, in order."""
    return list(dict.fromkeys(w.translate(str.maketrans(_UPPER, _LOWER)) for w in re.findall(_WORD + "+", text)))


def length_of(text: str) -> int:
    """Words of a template, repeats included: a block takes lines until it holds so many."""
    return len(re.findall(_WORD + "+", text))


def needed(size: int, threshold: float = THRESHOLD) -> int:
    """Common words from which a template of `size` different words is contained; in thousandths, to stay exact."""
    return math.ceil(round(threshold * 1000) * size / 1000)


def _spaced(text: Column) -> Column:
    """The words parted, led and followed by single spaces."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, _GAP, " ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _base(spaced: Column, phrases) -> dict[str, Column]:
    plain = {p: re.escape(p).replace("\\ ", " ") for p, _ in phrases}
    any_of = "|".join(plain.values())
    found = spaced.rlike(f"(?i) (?:{any_of}) ") if phrases else F.lit(False)
    count = {p: F.regexp_count(spaced, F.lit(f"(?i) (?={x} )")) for p, x in plain.items()}
    before = lambda lead: _spaces(F.regexp_extract(spaced, f"(?is)^({lead}) (?:{any_of}) ", 1)).cast("long")
    labels = F.array_sort(F.array_distinct(F.filter(F.array(*(F.when(count[p] > 0, F.lit(label)) for p, label in phrases)), lambda x: x.isNotNull()))) if phrases else F.array().cast("array<string>")
    return {
        "n_words": F.when(spaced == "  ", F.lit(0)).otherwise(_spaces(spaced) - 1).cast("long"),
        "n_base": F.when(found, reduce(lambda a, b: a + b, count.values(), F.lit(0))).otherwise(0).cast("long"),
        "first_word": F.when(found, before(".*?")),
        "last_word": F.when(found, before(".*")),
        "base": F.when(found, labels).otherwise(F.array().cast("array<string>")),
    }


def word_order(docs: DataFrame, words: list[str], text_col: str = "text") -> list[str]:
    """Template words, rarest in the corpus first: the number of documents that hold each, over all documents."""
    known = F.array(*map(F.lit, words))
    held = F.array_intersect(F.split(F.lower(_spaced(F.coalesce(F.col(text_col), F.lit("")))), " "), known)
    count = docs.select(F.explode(held).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in count.collect()}  # at most one row for each template word
    return sorted(words, key=lambda w: (found.get(w, 0), w))


def scan(spark: SparkSession, docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row.

    The score is 1 where a base phrase stands, else the largest containment of a template that reached the threshold in
    a block, else 0. A null or empty text has no words, no places and empty labels. Repeated rows each keep their row, a
    null id stays null, an empty table gives no rows. Two passes over the texts, no shuffle of them; of texts that hold a
    prefix word, the template words of each line go further.
    """
    sets = [(label, words_of(t), length_of(t)) for label, t in templates]
    sets = [x for x in sets if x[1]]
    vocabulary = sorted({w for _, ws, _ in sets for w in ws})
    if len(vocabulary) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates hold {len(vocabulary)} words, at most {MAX_TEMPLATE_WORDS} are allowed")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rank = {w: i for i, w in enumerate(word_order(rows, vocabulary))} if vocabulary else {}
    index = []
    for t, (label, ws, length) in enumerate(sets):
        ranks, need = sorted(rank[w] for w in ws), needed(len(ws), threshold)
        index += [(length, r, t, label, i, need, ranks) for i, r in enumerate(ranks[: len(ranks) - max(1, need) + 1])]
    named = {v: k for k, v in rank.items()}
    prefixes = sorted({named[r[1]] for r in index})

    lines = F.array().cast("array<struct<n:int,held:array<int>>>")
    if prefixes:
        order = F.create_map(*(x for w, i in rank.items() for x in (F.lit(w), F.lit(i))))
        split = lambda spaced: F.split(F.translate(spaced, _UPPER, _LOWER), " ")
        line = lambda spaced: F.struct((_spaces(spaced) - 1).cast("int").alias("n"), F.transform(F.array_intersect(split(spaced), F.array(*map(F.lit, vocabulary))), lambda w: order[w]).alias("held"))
        worded = F.filter(F.transform(F.split("text", "\n"), _spaced), lambda x: x != "  ")
        lines = F.when(F.arrays_overlap(split(F.col("spaced")), F.array(*map(F.lit, prefixes))), F.transform(worded, line)).otherwise(lines)
    spaced = rows.select("doc_id", "text", _spaced(F.col("text")).alias("spaced"))
    base = spaced.select(F.monotonically_increasing_id().alias("row"), "doc_id", *(c.alias(n) for n, c in _base(F.col("spaced"), phrases).items()), lines.alias("lines"))
    base = stored(spark, base, "licenses")

    found = base.select("row", F.lit(None).cast("array<string>").alias("own"), F.lit(None).cast("double").alias("part")).limit(0)
    if index:
        prefix = F.broadcast(spark.createDataFrame(index, "length int, rank int, template int, label string, i int, need int, ranks array<int>"))
        placed = base.select("row", F.posexplode("lines").alias("q", "line")).select("row", "q", "line.n", "line.held")
        placed = placed.withColumn("before", F.sum("n").over(W.partitionBy("row").orderBy("q")) - F.col("n"))
        # The words before a line grow with every line, so a block of a length is a range of them.
        lines = W.partitionBy("row").orderBy("before")
        lengths = sorted({length for _, _, length in sets})
        blocks = placed.select("row", *(F.collect_list("held").over(lines.rangeBetween(0, k - 1)).alias(f"block{k}") for k in lengths))
        blocks = blocks.select("row", F.explode(F.array(*(F.struct(F.lit(k).alias("length"), F.col(f"block{k}").alias("held")) for k in lengths))).alias("b"))
        blocks = blocks.select("row", "b.length", F.array_sort(F.array_distinct(F.flatten("b.held"))).alias("held"))
        placed = blocks.select("row", "length", "held", F.size("held").alias("n"), F.posexplode("held").alias("j", "rank"))
        could = (F.col("n") >= F.col("need")) & (F.least(F.size("ranks") - F.col("i"), F.col("n") - F.col("j")) >= F.col("need"))
        met = placed.join(prefix, ["length", "rank"]).where(could).select("row", "label", "need", F.size("ranks").alias("size"), F.size(F.array_intersect("held", "ranks")).alias("common")).where("common >= need")
        found = met.groupBy("row").agg(F.collect_set("label").alias("own"), F.max(F.col("common") / F.col("size")).alias("part"))
    joined = base.drop("lines").join(found, "row", "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("own", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("part", F.lit(0.0)))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))


def oracle(templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> str:
    """The same result as one DuckDB query that compares every block with every template."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    listed = lambda ws: "[" + ", ".join(map(quoted, ws)) + "]"
    t = ", ".join(f"({quoted(label)}, {listed(words_of(x))}, {needed(len(words_of(x)), threshold)}, {length_of(x)})" for label, x in templates)
    every = listed(sorted({w for _, x in templates for w in words_of(x)}))
    p = ", ".join(f"({listed(x.split())}, {quoted(label)})" for x, label in phrases)
    cut = f"regexp_extract_all(translate(x, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
with t(label, ws, need, k) as (values {t}), p(ws, label) as (values {p}),
     d as (select doc_id, x, {cut} as ws from (select doc_id, coalesce(text, '') as x from documents)),
     place as (select doc_id, label, i - 1 as i from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from d) w, p where w.ws[i:i + len(p.ws) - 1] = p.ws),
     base as (select doc_id, count(*) as n_base, min(i) as first_word, max(i) as last_word, list(distinct label) as labels from place group by doc_id),
     line as (select doc_id, i, {cut} as ws from (select doc_id, unnest(string_split(x, chr(10))) as x, generate_subscripts(string_split(x, chr(10)), 1) as i from d)),
     placed as (select doc_id, list_intersect(list_distinct(ws), {every}) as held, sum(len(ws)) over (partition by doc_id order by i) - len(ws) as before from line where len(ws) > 0),
     block as (select doc_id, k, list_distinct(flatten(list(held) over (partition by doc_id, k order by before range between current row and k - 1 following))) as ws from placed, (select distinct k from t)),
     near as (select doc_id, list(distinct label) as labels, max(len(list_intersect(block.ws, t.ws)) / len(t.ws)) as part from block join t using (k) where len(list_intersect(block.ws, t.ws)) >= need group by doc_id)
select d.doc_id, cast(len(d.ws) as bigint) as n_words, coalesce(n_base, 0) as n_base, cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(near.labels, [])))), ','), '') as labels,
       case when n_base > 0 then 1.0::double else coalesce(part, 0)::double end as score
from d left join base on base.doc_id = d.doc_id left join near on near.doc_id = d.doc_id
"""
