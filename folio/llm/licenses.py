"""License scan: an exact set-similarity join of text blocks with license templates, in
DataFrame functions only.

A template of k words has blocks of 2L words at every L-th word, L the least power of two
that is at least k: any stretch of L words lies whole in a block. A block meets a template
if it holds at least ceil(threshold * distinct) of the template's distinct words.

Filters, none of which can lose a block: words are ordered by how often they stand in all
documents, rarest first; of a template's d words in that order, ``need`` to be met, one of
the first d - need + 1 (its prefix) must be in the block. A pair of block and template
comes up once, by the first of those words. Length: a block of fewer distinct words than
``need`` can't meet it. Position: after the word at place i at most d - i more of the
template's and one less than all of the block's words can follow. What is left is
compared word by word.

Phrases (the base labels) are templates whose words have to stand consecutively: their
blocks are all windows of as many words, their prefix is the phrase's rarest word.

The join's right side is the templates, whose distinct words are bounded (``MOST_TOKENS``,
an error beyond); documents move nowhere, only matches and the count of each template
word do.

Defined results: null and empty texts have no words, no label and score 0; each row of
documents gives one row, repeated rows the same one; null ids stay null; a text without
words after lower-casing has null places; an empty table stays empty; other columns are
not read, so none can clash. Ties in frequency go by the word.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import prepare, written

MOST_TOKENS = 10_000

# Fixed values: (label, words that stand consecutively).
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)

# Fixed values: (label, threshold, wording) of public licenses and notices.
TEMPLATES = (
    ("mit", 0.8, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                 "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", 0.8, "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("as-is", 0.8, "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the "
                   "warranties of merchantability, fitness for a particular purpose and noninfringement"),
    ("apache", 0.9, "Licensed under the Apache License, Version 2.0"),
    ("apache", 0.8, "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("gpl", 0.9, "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", 0.8, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                 "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("lgpl", 1.0, "GNU Lesser General Public License"),
    ("agpl", 1.0, "GNU Affero General Public License"),
    ("bsd", 0.8, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                 "following conditions are met"),
    ("isc", 0.8, "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                 "provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", 0.8, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", 1.0, "Licensed under CC BY 4.0"),
    ("cc-by-nc", 1.0, "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", 1.0, "Licensed under CC BY-SA 4.0"),
    ("cc-by", 0.8, "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", 0.8, "This is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", 1.0, "All rights reserved"),
)

SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case. The Kelvin sign and the dotted I are the only other letters that a
    full lower-casing turns into ASCII ones, and no template holds a letter beyond ASCII."""
    risky = text.contains("\u212a") | text.contains("\u0130")
    return F.when(risky, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words_col(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SPLIT, -1), "")


def plain_words(text: str) -> list[str]:
    """Words of a template."""
    out = "".join(c.lower() if c.isascii() and c.isalnum() else " " if c.isascii() else c for c in text)
    return out.split()


def block_size(n_words: int) -> int:
    return 1 << max(0, (n_words - 1).bit_length())


def _ready(phrases, templates) -> tuple[list, list, list]:
    p = [(label, plain_words(x)) for label, x in phrases]
    t = [(label, threshold, plain_words(x)) for label, threshold, x in templates]
    if any(not w for *_, w in p + t) or any(not 0 < x <= 1 for _, x, _ in t) or any(len(set(w)) < len(w) for _, w in p):
        raise ValueError("phrases need distinct words, templates words and a threshold of more than 0, at most 1")
    tokens = sorted({w for *_, ws in p + t for w in ws})
    if len(tokens) > MOST_TOKENS:
        raise ValueError(f"templates of more than {MOST_TOKENS} distinct words")
    return p, t, tokens


def staged(df: DataFrame, **new: Column) -> DataFrame:
    """df with further columns behind a one-row generator, so that lambdas read values and not expressions."""
    return df.select(*df.columns, F.explode_outer(F.array(F.struct(*[e.alias(n) for n, e in new.items()]))).alias("_s")).select(*df.columns, "_s.*")


def token_counts(docs: DataFrame, text_col: str, tokens: list[str]) -> dict[str, int]:
    """How often each template word stands in all documents (at most MOST_TOKENS rows)."""
    held = F.filter(words_col(F.col(text_col)), lambda w: w.isin(tokens))
    rows = docs.select(F.explode_outer(held).alias("token")).filter("token IS NOT NULL").groupBy("token").agg(F.count("*").alias("n"))
    return {x.token: x.n for x in rows.collect()}


def small_table(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver's as a table, without a Python worker."""
    names = [x.strip().split(" ")[0] for x in schema.split(", ")]
    text = json.dumps([dict(zip(names, r)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{', '.join(x.replace(' ', ':', 1) for x in schema.split(', '))}>>")))


def block_places(size: int, prefix: list[str]) -> Column:
    """(size, block) of the blocks of ``w`` that hold a prefix word; block b has the words from b * size on, 2 * size of them."""
    at = F.array_compact(F.transform("w", lambda x, i: F.when(x.isin(prefix), F.floor(i / size).cast("int"))))
    held = F.filter(F.array_distinct(F.flatten(F.transform(at, lambda b: F.array(b, b - 1)))), lambda b: b >= 0)
    return F.transform(held, lambda b: F.struct(F.lit(size).alias("size"), b.alias("block")))


def find_licenses(docs: DataFrame, id_col="doc_id", text_col="text", phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """A row for each match: doc_id, _key (of the text), label, phrase (boolean), start and stop
    (words from 0, stop not included), containment (0 to 1)."""
    spark = docs.sparkSession
    prepare(spark)
    phrases, templates, tokens = _ready(phrases, templates)
    seen = token_counts(docs, text_col, tokens)
    order = lambda w: (seen.get(w, 0), w)
    phrase_rows, rows = [], []
    for label, words in phrases:
        rare = min(words, key=order)
        phrase_rows.append((rare, label, words.index(rare), words))
    for no, (label, threshold, words) in enumerate(templates):
        ranked = sorted(set(words), key=order)
        need = math.ceil(threshold * len(ranked) - 1e-9)
        for i, w in enumerate(ranked[: len(ranked) - need + 1]):
            rows.append((w, block_size(len(words)), no, label, need, i + 1, ranked))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit("\0"))).alias("_key"), F.col(text_col).alias("text"))
    texts = staged(ids, w=words_col(F.col("text"))).drop("text")
    found = []
    if rows:
        index = F.broadcast(small_table(spark, rows, "token string, size int, template int, label string, need int, place int, ranked array<string>"))
        parts = [block_places(size, sorted({r[0] for r in rows if r[1] == size})) for size in sorted({r[1] for r in rows})]
        hit = staged(texts, at=F.concat(*parts)).filter(F.size("at") > 0)
        blocks = hit.select("doc_id", "_key", F.explode_outer(F.transform("at", lambda a: F.struct(
            a["size"].alias("size"), (a["block"] * a["size"]).alias("start"), F.array_distinct(F.slice("w", a["block"] * a["size"] + 1, 2 * a["size"])).alias("words")))).alias("b"))
        blocks = blocks.select("doc_id", "_key", "b.*")
        every = sorted({r[0] for r in rows})
        pairs = blocks.select("*", F.explode_outer(F.filter("words", lambda x: x.isin(every))).alias("token")).join(index, ["token", "size"])
        pairs = pairs.filter(F.size("words") >= F.col("need"))                                                       # length
        pairs = pairs.filter(1 + F.least(F.size("ranked") - F.col("place"), F.size("words") - 1) >= F.col("need"))   # position
        common = F.array_intersect("ranked", "words")      # in the order of ranked
        pairs = pairs.withColumn("common", common).filter((F.element_at("common", 1) == F.col("token")) & (F.size("common") >= F.col("need")))
        found.append(pairs.select("doc_id", "_key", "label", F.lit(False).alias("phrase"), F.col("start").cast("long").alias("start"),
                                  (F.col("start") + 2 * F.col("size")).cast("long").alias("stop"), (F.size("common") / F.size("ranked")).alias("containment")))
    if phrase_rows:
        index = F.broadcast(small_table(spark, phrase_rows, "token string, label string, off int, phrase array<string>"))
        rare, reach = sorted({r[0] for r in phrase_rows}), max(len(r[3]) for r in phrase_rows) - 1
        at = F.array_compact(F.transform("w", lambda x, i: F.when(x.isin(rare), i)))
        hit = staged(texts, at=at).filter(F.size("at") > 0)
        near = F.transform("at", lambda p: F.struct(p.alias("p"), F.element_at("w", p + 1).alias("token"), F.greatest(p - reach, F.lit(0)).alias("low"),
                                                    F.slice("w", F.greatest(p - reach, F.lit(0)) + 1, F.least(p, F.lit(reach)) + reach + 1).alias("words")))
        pairs = hit.select("doc_id", "_key", F.explode_outer(near).alias("b")).select("doc_id", "_key", "b.*").join(index, "token")
        start = F.col("p") - F.col("off")
        pairs = pairs.withColumn("start", start).filter("start >= low")
        pairs = pairs.filter(F.slice("words", F.col("start") - F.col("low") + 1, F.size("phrase")) == F.col("phrase"))
        found.append(pairs.select("doc_id", "_key", "label", F.lit(True).alias("phrase"), F.col("start").cast("long").alias("start"),
                                  (F.col("start") + F.size("phrase")).cast("long").alias("stop"), F.lit(1.0).alias("containment")))
    if not found:
        raise ValueError("no phrase and no template")
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def scan(docs: DataFrame, id_col="doc_id", text_col="text", phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """One row a document: doc_id, n_words, n_base (phrase places), first_word, last_word, base_labels,
    labels, score (greatest containment of a match, 0 without one). A repeated row gives equal rows."""
    matches = find_licenses(docs, id_col, text_col, phrases, templates).distinct()
    place = F.when(F.col("phrase"), F.col("start"))
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    per_doc = written(matches.groupBy("doc_id", "_key").agg(
        F.count(place).alias("n_base"), F.min(place).alias("first_word"), F.max(place).alias("last_word"),
        names(F.when(F.col("phrase"), F.col("label"))).alias("base_labels"), names(F.col("label")).alias("labels"), F.max("containment").alias("score")), "licenses")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit("\0"))).alias("_key"),
                       F.size(words_col(F.col(text_col))).cast("long").alias("n_words")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d._key") == F.col("m._key"))
    return rows.join(per_doc.alias("m"), same, "left").select(
        "d.doc_id", "d.n_words", F.coalesce("m.n_base", F.lit(0)).cast("long").alias("n_base"), "m.first_word", "m.last_word",
        F.coalesce("m.base_labels", F.lit("")).alias("base_labels"), F.coalesce("m.labels", F.lit("")).alias("labels"),
        F.coalesce("m.score", F.lit(0.0)).alias("score"))


def oracle_sql(phrases=PHRASES, templates=TEMPLATES) -> str:
    """DuckDB twin over documents: every block against every template, without filters."""
    p, t, _ = _ready(phrases, templates)
    phrase_rows = ", ".join(f"('{label}', '{' '.join(words)}', {len(words)})" for label, words in p)
    word_rows = ", ".join(f"({no}, '{w}')" for no, (_, _, words) in enumerate(t) for w in sorted(set(words)))
    template_rows = ", ".join(f"({no}, '{label}', {block_size(len(words))}, {len(set(words))}, {math.ceil(x * len(set(words)) - 1e-9)})"
                              for no, (label, x, words) in enumerate(t))
    most = max(len(words) for _, words in p)
    leads = " ".join(f"|| coalesce(' ' || lead(word, {k}) OVER w, '')" for k in range(1, most))
    return f"""WITH texts AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents),
words AS (SELECT doc_id, unnest(range(len(ws))) AS i, unnest(ws) AS word FROM texts),
phrases(label, phrase, k) AS (VALUES {phrase_rows}),
ahead AS (SELECT doc_id, i, word {leads} AS here FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
places AS (SELECT doc_id, label, i, 1.0::DOUBLE AS c FROM ahead JOIN phrases ON here = phrase OR starts_with(here, phrase || ' ')),
template_words(template, word) AS (VALUES {word_rows}),
templates(template, label, size, d, need) AS (VALUES {template_rows}),
held AS (SELECT doc_id, template, i // size - s AS block, word FROM words JOIN template_words USING (word) JOIN templates USING (template), (VALUES (0), (1)) AS shift(s)
         WHERE i // size - s >= 0),
met AS (SELECT doc_id, template, block, count(DISTINCT word) AS common FROM held GROUP BY ALL),
matches AS (SELECT doc_id, label, NULL::BIGINT AS i, common / d AS c FROM met JOIN templates USING (template) WHERE common >= need
            UNION ALL SELECT doc_id, label, i, c FROM places),
found AS (SELECT doc_id, count(i) AS n_base, min(i) AS first_word, max(i) AS last_word, max(c) AS score,
                 string_agg(DISTINCT label, ',' ORDER BY label) FILTER (i IS NOT NULL) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM matches GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM texts LEFT JOIN found USING (doc_id)"""
