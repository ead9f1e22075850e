"""Line dedup with content-defined chunks, in DataFrame functions only. The query op3 and the pipeline use
``dedup_passages(chunks=True)``: what either rule removes goes, each judged on the input.

A rolling hash over the hashes of the last ``window`` lines ends a chunk where it
is divisible by ``divisor``; the boundaries move with the text, so a passage keeps
its inner chunks wherever it stands. A chunk of two or more lines that holds a word
and equals an earlier chunk byte for byte (smaller doc_id, or the same document,
further up) is removed; the lines around it stay as they are.

Chunk hashes only route the comparison: texts are grouped by (hash, bytes), and a
hash that turns out to hold different texts is resolved by its bytes.

Defined results: null text stays null; a text whose chunks all go becomes empty;
null ids come last and count as one document, as do rows of equal doc_id (each of
them keeps its own first copy); an empty table stays empty; further columns pass
(n_chars is brought up to date, n_removed is added or replaced).

``dedup_passages`` takes what such chunks can't hold: passages of ``words`` or more
words, of one line or many. Its candidates are carried by the passage itself: from
every line on (and up to every line) the fewest whole lines that hold so many words;
lines without a word don't count and go with the lines around them. A line goes if it
lies in a candidate whose bytes stand earlier (smaller doc_id, or the same document,
further up and not overlapping). So of a repeated run of whole lines with ``words`` or more
words every line goes, and a removed line always has an earlier copy that stays. n_removed
counts lines there. Copies that start or end inside of a line are no candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import digest_key, pack, prepare, unpack, written

LAST = (1 << 63) - 1


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("long")


def with_chunks(docs: DataFrame, text_col="text", window: int = 2, divisor: int = 3) -> DataFrame:
    """docs with ``_chunks``: array of (no, last, n_lines, chunk) over the whole text."""
    at = F.col("_hash")

    def ends_here(i):
        roll = sum((F.when(i > k, F.element_at(at, (F.greatest(i - k, F.lit(1))).cast("int"))).otherwise(F.lit(0)) * (31 ** k) for k in range(window)), F.lit(0))
        return (F.pmod(roll, F.lit(divisor)) == 0) | (i == F.size("_lines"))

    return (docs.withColumn("_lines", F.split(F.col(text_col), "\n", -1))
            .withColumn("_hash", F.transform("_lines", _line_hash))
            .withColumn("_ends", F.filter(F.sequence(F.lit(1), F.size("_lines")), ends_here))
            .withColumn("_chunks", F.transform("_ends", lambda e, j: F.struct(
                j.alias("no"), e.alias("last"),
                (e - F.when(j > 0, F.element_at("_ends", F.greatest(j, F.lit(1)))).otherwise(0)).alias("n_lines"),
                F.array_join(F.slice("_lines", F.when(j > 0, F.element_at("_ends", F.greatest(j, F.lit(1)))).otherwise(0) + 1,
                                     e - F.when(j > 0, F.element_at("_ends", F.greatest(j, F.lit(1)))).otherwise(0)), "\n").alias("chunk"))))
            .drop("_lines", "_hash", "_ends"))


def repeated_chunks(rows: DataFrame, window: int, divisor: int, min_lines: int, hash_bits: int, spans: bool = False) -> DataFrame:
    """_id, _key, nos: the later copies of multi-line chunks, by number or as lines (a, b)."""
    rows = with_chunks(rows, "text", window, divisor)
    each = rows.select("_id", "_key", F.explode_outer("_chunks").alias("c")).select("_id", "_key", "c.*")
    # explode_outer: a plain explode would push size(_chunks) > 0, with all of its expression, into the scan
    each = each.filter((F.col("n_lines") >= min_lines) & F.col("chunk").rlike(r"[^\x20\x09-\x0D]"))
    if spans:
        each = each.withColumn("no", F.struct((F.col("last") - F.col("n_lines") + 1).alias("a"), F.col("last").alias("b")))
    each = each.drop("last")
    code = F.xxhash64("chunk")
    each = each.withColumn("h", code if hash_bits == 64 else F.pmod(code, F.lit(1 << hash_bits)))
    texts = each.groupBy("h", "chunk").agg(F.count("*").alias("n"), F.min("_id").alias("first_id"))
    classes = written(texts.groupBy("h").agg(F.count("*").alias("n_texts"), F.sum("n").alias("n"), F.min("first_id").alias("first_id"))
                      .filter("n > 1"), "chunks")
    occurs = each.groupBy("_id", "_key", "h").agg(F.min("no").alias("no0"), F.collect_list("no").alias("nos"))
    repeated = classes.filter("n_texts = 1").select("h", "first_id")
    mine = F.when(F.col("_id") == F.col("first_id"), F.filter("nos", lambda x: x != F.col("no0"))).otherwise(F.col("nos"))
    gone = occurs.join(repeated, "h").select("_id", "_key", mine.alias("nos"))
    mixed = classes.filter("n_texts > 1").select("h")
    if not mixed.isEmpty():          # hashes shared by different texts: decide by the bytes
        by_text = texts.join(mixed, "h").filter("n > 1").select("h", "chunk", "first_id")
        occurs = each.join(mixed, "h", "left_semi").groupBy("_id", "_key", "h", "chunk").agg(F.min("no").alias("no0"), F.collect_list("no").alias("nos"))
        gone = gone.unionByName(occurs.join(by_text, ["h", "chunk"]).select("_id", "_key", mine.alias("nos")))
    return gone.filter(F.size("nos") > 0)


def dedup_lines(docs: DataFrame, id_col="doc_id", text_col="text", window: int = 2, divisor: int = 3,
                min_lines: int = 2, hash_bits: int = 64) -> DataFrame:
    """docs with globally repeated multi-line chunks removed from the text, and n_removed (chunks)."""
    prepare(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("_id"), digest_key(text_col).alias("_key"), F.col(text_col).alias("text"))
    drop = repeated_chunks(rows, window, divisor, min_lines, hash_bits).groupBy("_id", "_key").agg(F.flatten(F.collect_set("nos")).alias("_drop"))
    keyed = pack(docs, _id=F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)), _key=digest_key(text_col))
    text = F.col("row").getField(text_col)       # the text moves once, inside of its row
    cut = with_chunks(keyed.join(drop, ["_id", "_key"], "left").withColumn("_cut", F.when(F.col("_drop").isNotNull(), text)), "_cut", window, divisor)
    kept = F.array_join(F.transform(F.filter("_chunks", lambda c: ~F.array_contains("_drop", c["no"])), lambda c: c["chunk"]), "\n")
    out = cut.withColumn("_text", F.when(F.col("_drop").isNull(), text).otherwise(kept))
    new = {text_col: F.col("_text"), "n_removed": F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("_text").cast("long")
    return unpack(out, docs.columns, **new)


def with_passages(rows: DataFrame, words: int) -> DataFrame:
    """_id, _key, and a row for each candidate: first line a, last line b (from 1), hash h."""
    def staged(df, **new):       # behind a generator, so that lambdas read values and not expressions
        return df.select(*[c for c in df.columns if c != "s"], F.explode_outer(F.array(F.struct(*([F.col("s.*")] if "s" in df.columns else []), *[e.alias(n) for n, e in new.items()]))).alias("s"))

    def fewest(weights):         # how many of the weights, from the first on, reach ``words``; null if all don't
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("k"))
        more = lambda a, x: F.when(a["n"] >= words, a).otherwise(F.struct((a["n"] + x).alias("n"), (a["k"] + 1).alias("k")))
        return F.aggregate(weights, start, more, lambda a: F.when(a["n"] >= words, a["k"]))

    s = lambda name: F.col("s").getField(name)
    df = staged(rows.filter("text IS NOT NULL").select("_id", "_key", "text"), lines=F.split("text", "\n", -1)).drop("text")
    df = staged(df, words=F.transform(s("lines"), lambda x: F.size(F.filter(F.split(x, r"[\x20\x09-\x0D]+"), lambda w: w != ""))))
    df = staged(df, at=F.filter(F.sequence(F.lit(1), F.size(s("lines"))), lambda i: F.element_at(s("words"), i) > 0))
    df = staged(df, w=F.transform(s("at"), lambda i: F.element_at(s("words"), i)), h=F.transform(s("at"), lambda i: F.xxhash64(F.element_at(s("lines"), i))))
    df = df.filter(F.size(s("at")) > 0)
    # every line here holds a word, so ``words`` lines always suffice
    each = F.sequence(F.lit(1), F.size(s("at")))
    down = F.transform(each, lambda i: F.struct(i.alias("i"), (i + fewest(F.slice(s("w"), i, F.lit(words))) - 1).alias("j")))
    up = F.transform(each, lambda j: F.struct((j - fewest(F.reverse(F.slice(s("w"), F.greatest(j - words + 1, F.lit(1)), F.least(j, F.lit(words))))) + 1).alias("i"), j.alias("j")))
    both = F.array_distinct(F.filter(F.concat(down, up), lambda x: x["i"].isNotNull() & x["j"].isNotNull()))
    df = staged(df, both=both)
    spots = F.transform(s("both"), lambda x: F.struct(F.element_at(s("at"), x["i"]).alias("a"), F.element_at(s("at"), x["j"]).alias("b"),
                                                      F.xxhash64(F.slice(s("h"), x["i"], x["j"] - x["i"] + 1)).alias("h")))
    return df.select("_id", "_key", F.explode_outer(spots).alias("c")).select("_id", "_key", "c.*").filter("a IS NOT NULL")


def repeated_passages(rows: DataFrame, words: int, hash_bits: int) -> DataFrame:
    """_id, _key, spans: lines (a, b) of the candidates that stand earlier."""
    each = with_passages(rows, words)
    if hash_bits < 64:
        each = each.withColumn("h", F.pmod("h", F.lit(1 << hash_bits)))
    each = written(each, "candidates")
    again = each.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    hits = each.join(again, "h").groupBy("_id", "_key").agg(F.collect_set(F.struct("a", "b", "h")).alias("_hits"))
    # only documents with a hash seen twice give bytes, and only those of such candidates
    mine = rows.join(hits, ["_id", "_key"]).select("_id", "_key", F.explode_outer(F.array(F.struct(F.split("text", "\n", -1).alias("lines"), F.col("_hits").alias("hits")))).alias("s"))
    held = lambda x: F.array_join(F.filter(F.slice(F.col("s.lines"), x["a"], x["b"] - x["a"] + 1), lambda y: y.rlike(r"[^\x20\x09-\x0D]")), "\n")
    mine = mine.select("_id", "_key", F.explode_outer(F.transform("s.hits", lambda x: F.struct(x["h"].alias("h"), x["a"].alias("a"), x["b"].alias("b"), held(x).alias("chunk")))).alias("c"))
    mine = written(mine.select("_id", "_key", "c.*"), "passages")
    texts = mine.groupBy("h", "chunk").agg(F.min("_id").alias("first_id"))
    classes = written(texts.groupBy("h").agg(F.count("*").alias("n_texts"), F.min("first_id").alias("first_id")), "classes")
    spans = F.collect_set(F.struct("a", "b")).alias("spans")
    later = F.when(F.col("_id") == F.col("first_id"), F.filter("spans", lambda x: x["a"] > F.array_min("spans")["b"])).otherwise(F.col("spans"))
    gone = mine.groupBy("_id", "_key", "h").agg(spans).join(classes.filter("n_texts = 1"), "h").select("_id", "_key", later.alias("spans"))
    mixed = classes.filter("n_texts > 1").select("h")
    if not mixed.isEmpty():          # hashes shared by different texts: decide by the bytes
        occurs = mine.join(mixed, "h", "left_semi").groupBy("_id", "_key", "h", "chunk").agg(spans)
        gone = gone.unionByName(occurs.join(texts.join(mixed, "h", "left_semi"), ["h", "chunk"]).select("_id", "_key", later.alias("spans")))
    return gone.filter(F.size("spans") > 0)


def dedup_passages(docs: DataFrame, id_col="doc_id", text_col="text", words: int = 50, hash_bits: int = 64,
                   chunks: bool = False, window: int = 2, divisor: int = 3, min_lines: int = 2) -> DataFrame:
    """docs without the lines of passages of ``words`` or more words that stand earlier (``chunks``: and without
    what dedup_lines removes), and n_removed (lines)."""
    prepare(docs.sparkSession)
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    rows = docs.select(ident.alias("_id"), digest_key(text_col).alias("_key"), F.col(text_col).alias("text"))
    gone = repeated_passages(rows, words, hash_bits)
    if chunks:
        gone = gone.unionByName(repeated_chunks(rows, window, divisor, min_lines, hash_bits, spans=True).withColumnRenamed("nos", "spans"))
    gone = gone.groupBy("_id", "_key").agg(F.flatten(F.collect_list("spans")).alias("_spans"))
    keyed = pack(docs, _id=ident, _key=digest_key(text_col)).join(gone, ["_id", "_key"], "left")
    text = F.col("row").getField(text_col)
    cut = keyed.withColumn("_s", F.explode_outer(F.array(F.struct(F.when(F.col("_spans").isNotNull(), F.split(text, "\n", -1)).alias("lines")))))
    stay = F.array_except(F.sequence(F.lit(1), F.size("_s.lines")), F.flatten(F.transform("_spans", lambda x: F.sequence(x["a"], x["b"]))))
    cut = cut.withColumn("_p", F.explode_outer(F.array(F.struct(F.when(F.col("_spans").isNotNull(), stay).alias("stay")))))
    kept = F.array_join(F.transform("_p.stay", lambda i: F.element_at("_s.lines", i)), "\n")
    out = cut.withColumn("_text", F.when(F.col("_spans").isNull(), text).otherwise(kept))
    new = {text_col: F.col("_text"), "n_removed": F.when(F.col("_spans").isNull(), 0).otherwise(F.size("_s.lines") - F.size("_p.stay")).cast("long")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("_text").cast("long")
    return unpack(out, docs.columns, **new)


def oracle_sql(words: int = 50, window: int = 2, divisor: int = 3) -> str:
    """DuckDB twin of ``dedup_passages(chunks=True)`` over documents."""
    roll = " + ".join(f"coalesce(lag(h, {k}) OVER w, 0) * {31 ** k}" for k in range(window))
    ink = "[\\x20\\x09-\\x0D]+"
    return f"""WITH lines AS (
  SELECT doc_id, i, lines[i] AS line, ('0x' || substr(md5(lines[i]), 1, 7))::BIGINT AS h
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL))),
ends AS (SELECT *, (({roll}) % {divisor} = 0)::INT AS cut FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no FROM ends),
chunks AS (SELECT doc_id, no, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n, min(i) AS a, max(i) AS b FROM numbered GROUP BY doc_id, no),
ranked AS (SELECT *, n >= 2 AND regexp_matches(chunk, '[^\\x20\\x09-\\x0D]')
             AND row_number() OVER (PARTITION BY chunk, n >= 2 ORDER BY doc_id, no) > 1 AS gone FROM chunks),
inked AS (SELECT doc_id, i, line, len(list_filter(string_split_regex(line, '{ink}'), lambda y: y <> '')) AS n FROM lines),
worded AS (SELECT *, row_number() OVER w AS r, sum(n) OVER w AS upto FROM inked WHERE n > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
pairs AS (SELECT a.doc_id, a.r AS ra, b.r AS rb, a.i AS a, b.i AS b FROM worded a JOIN worded b ON b.doc_id = a.doc_id AND b.r >= a.r AND b.upto - a.upto + a.n >= {words}),
runs AS (SELECT doc_id, ra, min(rb) AS rb, a, min(b) AS b FROM pairs GROUP BY doc_id, ra, a UNION SELECT doc_id, max(ra), rb, max(a), b FROM pairs GROUP BY doc_id, rb, b),
passages AS (SELECT u.doc_id, u.a, u.b, string_agg(w.line, chr(10) ORDER BY w.r) AS passage FROM runs u JOIN worded w ON w.doc_id = u.doc_id AND w.r BETWEEN u.ra AND u.rb GROUP BY u.doc_id, u.a, u.b),
placed AS (SELECT *, min(doc_id) OVER (PARTITION BY passage) AS first_doc, first_value(b) OVER (PARTITION BY passage ORDER BY doc_id, a, b) AS first_b FROM passages),
spans AS (SELECT doc_id, a, b FROM ranked WHERE gone UNION ALL SELECT doc_id, a, b FROM placed WHERE doc_id <> first_doc OR a > first_b),
marked AS (SELECT doc_id, i, line, EXISTS (SELECT 1 FROM spans s WHERE s.doc_id = l.doc_id AND l.i BETWEEN s.a AND s.b) AS gone FROM lines l),
built AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text, count(*) FILTER (gone) AS n_removed FROM marked GROUP BY doc_id)
SELECT d.doc_id, b.text, d.lang, d.source, length(b.text)::BIGINT AS n_chars, coalesce(b.n_removed, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN built b ON d.doc_id = b.doc_id"""
