"""Training-data operators against brute force and hand-made cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from folio.llm import (chat_format, decontaminate, fertility, html_extract, line_dedup, maxent_lm, mixing,
                       quality, queries, simhash, suffix_dedup)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def prose(seed, n):
    r = random.Random(seed)
    syl = ["the", "of", "ra", "ti", "on", "en", "la", "mo", "ki", "su", "é"]
    return " ".join("".join(r.choices(syl, k=r.randint(1, 3))) for _ in range(n))


def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    long = prose(7, 30_000)
    rows = [(1, prose(1, 60), "en", "a", 5), (2, None, None, None, None), (None, prose(1, 60), "en", "a", 5), (3, "", "en", "b", 0),
            (4, prose(1, 60), "en", "b", 5), (4, prose(1, 60), "en", "b", 5), (4, prose(2, 60), "en", "b", 5), (5, " \n\t ", "de", "a", 1),
            (6, long, "en", None, 9), (7, long + " x", "en", "c", 9), (None, None, None, None, None), (8, "one", "fr", "c", 3), (None, prose(9, 40), "fr", "c", 3)]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("_id", "_key", "row", "copy", "h", "core", "key", "n_removed", "_name", "fp"):
        df = df.withColumn(c, F.lit("mine"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)], DOCS)


# ------------------------------------------------------------------ 1 SimHash

def slow_print(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return 0
    g = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    ones = [0] * 64
    for x in g:
        h = xxhash.xxh64_intdigest(x, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(g))


def slow_components(prints, ids, radius):
    up = list(range(len(prints)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius and top(i) != top(j):
                up[top(i)] = top(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return [least.get(top(i)) for i in range(len(prints))]


@pytest.mark.parametrize("radius", [0, 3, 4, 7])
def test_bucket_forest_is_exact(radius):
    r = np.random.default_rng(radius)
    fp = []
    for base in r.integers(0, 2**63, 80, dtype=np.uint64):
        for _ in range(r.integers(1, 7)):
            x = int(base)
            for k in r.integers(0, 64, r.integers(0, 5)):
                x ^= 1 << int(k)
            fp.append(x)
    fp = np.array(sorted(set(fp)), np.uint64)
    r.shuffle(fp)
    group = np.sort(r.integers(0, 4, len(fp)))
    child, root = simhash.bucket_forest(fp, group, radius)
    label = np.arange(len(fp))
    label[child] = root
    for g in range(4):
        at = np.flatnonzero(group == g)
        assert label[at].tolist() == slow_components([int(x) for x in fp[at]], at.tolist(), radius)


def test_simhash_matches_brute_force(spark):
    r = random.Random(3)
    texts = []
    for k in range(40):
        w = prose(k, 120).split()
        for _ in range(r.randint(1, 4)):
            v = list(w)
            for _ in range(r.randint(0, 2)):
                v[r.randrange(len(v))] = "zz"
            texts.append(" ".join(v))
    texts += [None, "", "A b", "a B"]
    got = {x.doc_id: (x.fp % (1 << 64), x.component_id) for x in simhash.near_dedup(docs_of(spark, texts)).collect()}
    prints = [slow_print(t) for t in texts]
    want = slow_components(prints, list(range(len(texts))), 4)
    assert [got[i] for i in range(len(texts))] == list(zip(prints, want))


def test_simhash_tiles_find_the_same_links(spark):
    r = np.random.default_rng(0)
    fp = sorted({(1 << int(a)) ^ (1 << int(b)) for a, b in r.integers(0, 60, (300, 2))})
    df = spark.createDataFrame([(x,) for x in fp], "fp long")
    from folio.llm.common import components
    for tile in (16, 4096):
        comp = {x.node: x.root for x in components(simhash.similar_links(df, 4, tile)).collect()}
        want = slow_components(fp, fp, 4)
        assert [comp.get(x, x) for x in fp] == want


def test_simhash_odd_rows(spark):
    d = odd_docs(spark)
    rows = simhash.near_dedup(d).collect()
    assert len(rows) == d.count()
    assert {x.component_id for x in rows if x.doc_id in (1, 4)} >= {1} and all(x.component_id == 2 for x in rows if x.fp == 0)
    kept = simhash.drop_near_copies(d)
    assert kept.columns == d.columns and kept.count() == len({x.root for x in rows})
    assert simhash.near_dedup(empty(spark)).count() == 0 and simhash.drop_near_copies(empty(spark)).count() == 0


# ------------------------------------------------------------------ 2 suffixes

def slow_repeats(docs, length):
    seen, out = set(), {}
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            if s in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(s)
        out[d] = bytes(x for x, g in zip(b, gone) if not g)
    return out


@pytest.mark.parametrize("cover", ["content", "modular"])
def test_suffix_dedup_matches_brute_force(spark, cover):
    r = random.Random(5)
    pool = [prose(100 + i, 40) for i in range(6)]
    texts = []
    for i in range(24):
        parts = []
        for _ in range(r.randint(0, 5)):
            p = r.choice(pool) if r.random() < .6 else prose(1000 + r.randrange(10**6), r.randint(1, 30))
            a = r.randrange(max(1, len(p) // 3))
            parts.append(p[a:a + r.randint(1, len(p))])
        texts.append(r.choice(["", " "]).join(parts))
    texts += ["a" * 350, "ab" * 200, "a" * 99, "a" * 100, None, "é" * 120, texts[0] + "x" + texts[0]]
    got = {x.doc_id: bytes(x.kept) for x in suffix_dedup.dedup_suffixes(docs_of(spark, texts), cover=cover).collect()}
    assert got == slow_repeats(enumerate(texts), 100)


def test_suffix_dedup_orders_equal_and_null_ids(spark):
    r = random.Random(8)
    pool = [prose(300 + i, 40) for i in range(5)]
    rows = [(r.choice([None, None, 7, 7, i]), prose(5000 + i, r.randint(0, 9)) + "".join(x[r.randrange(20):] for x in r.choices(pool, k=r.randint(1, 4)))) for i in range(30)]
    rows += [rows[0], (7, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keys = [x.k for x in df.select(suffix_dedup.digest_key("text").alias("k")).collect()]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, keys[i]))
    want = slow_repeats([(i, rows[i][1]) for i in order if i != 30], 100)        # row 30 is row 0 again: one document
    want[30] = want[0]
    got = sorted((str(x.doc_id), bytes(x.kept)) for x in suffix_dedup.dedup_suffixes(df).collect())
    assert got == sorted((str(rows[i][0]), want[i]) for i in want)


def test_suffix_dedup_pieces_and_odd_rows(spark, monkeypatch):
    t = (prose(1, 300) + prose(2, 50) + prose(1, 200)).encode()
    whole = suffix_dedup.samples(t)
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    cut = suffix_dedup.samples(t)
    assert sorted(set(whole[0].tolist())) == sorted(set(cut[0].tolist()))
    monkeypatch.undo()
    diff = {(a - b) % 73 for a in suffix_dedup.RESIDUES for b in suffix_dedup.RESIDUES}
    assert diff == set(range(73))
    d = odd_docs(spark)
    rows = suffix_dedup.dedup_suffixes(d).collect()
    assert len(rows) == d.count()
    by = [(x.doc_id, x.n_bytes, len(x.kept)) for x in rows]
    first, twin = prose(1, 60).encode(), len(prose(7, 30_000).encode())
    assert (1, len(first), len(first)) in by and (4, len(first), 0) in by and (None, len(first), 0) in by and (6, twin, twin) in by
    assert suffix_dedup.dedup_suffixes(empty(spark)).count() == 0


# ------------------------------------------------------------------ 3 lines

def slow_lines(docs, window=2, divisor=3):
    seen, out = set(), {}
    for d, t in docs:
        if t is None:
            out[d] = None
            continue
        h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in t.split("\n")]
        chunks, now = [], []
        for i, line in enumerate(t.split("\n")):
            now.append(line)
            if sum(h[i - k] * 31**k for k in range(window) if i >= k) % divisor == 0:
                chunks.append(now)
                now = []
        if now:
            chunks.append(now)
        keep = []
        for c in chunks:
            s = "\n".join(c)
            if len(c) > 1 and s.strip(" \t\n\r\x0b\f"):
                if s in seen:
                    continue
                seen.add(s)
            keep.append(s)
        out[d] = "\n".join(keep)
    return out


@pytest.mark.parametrize("bits", [64, 3])
def test_lines_match_brute_force(spark, bits):
    r = random.Random(1)
    pool = [[prose(50 * k + i, r.randint(0, 5)) for i in range(9)] for k in range(4)]
    texts = ["\n".join([prose(999 + i, 3)] + r.choice(pool)[r.randrange(3):] + [prose(5000 + i, 2)] + r.choice(pool)) for i in range(20)] + ["", "\n\n\n", None, "\n\n\n"]
    got = {x.doc_id: x.text for x in line_dedup.dedup_lines(docs_of(spark, texts), hash_bits=bits).collect()}
    assert got == slow_lines(enumerate(texts))


def test_lines_odd_rows(spark):
    d = odd_docs(spark)
    out = line_dedup.dedup_lines(d)
    assert out.columns == d.columns and out.count() == d.count()
    assert out.filter("_id <> 'mine' or row <> 'mine'").count() == 0 and out.filter("doc_id = 2 and text is null").count() == 1
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def slow_chunk_lines(docs, window=2, divisor=3):
    """The lines (from 0) of each document that lie in a repeated chunk."""
    seen, out = set(), {}
    for d, t in docs:
        lines = t.split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
        out[d], begin = set(), 0
        for i in range(len(lines)):
            if i == len(lines) - 1 or sum(h[i - k] * 31**k for k in range(window) if i >= k) % divisor == 0:
                chunk = "\n".join(lines[begin:i + 1])
                if i > begin and chunk.strip(" \t\n\r\x0b\f"):
                    out[d] |= set(range(begin, i + 1)) if chunk in seen else set()
                    seen.add(chunk)
                begin = i + 1
    return out


def slow_passages(docs, words=50, chunks=False):
    """docs: (id, text), by id. A line goes if it lies in a run that starts or ends at a line, is as short
    as its words allow, and stands in an earlier document or above (``chunks``: or in a repeated chunk)."""
    docs = list(docs)
    seen, out, also = {}, [], slow_chunk_lines(docs) if chunks else {}
    for d, t in docs:
        lines = t.split("\n")
        n = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines]
        at = [i for i, k in enumerate(n) if k]
        runs = set()
        for x in range(len(at)):
            runs |= set([(x, y) for y in range(x, len(at)) if sum(n[i] for i in at[x:y + 1]) >= words][:1])
            runs |= set([(y, x) for y in range(x, -1, -1) if sum(n[i] for i in at[y:x + 1]) >= words][:1])
        gone = set()
        for x, y in sorted(runs):
            e, b = seen.setdefault("\n".join(lines[i] for i in at[x:y + 1]), (d, at[y]))
            if e < d or at[x] > b:
                gone |= set(range(at[x], at[y] + 1))
        gone |= also.get(d, set())
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def test_op3_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    order = sorted((x.doc_id, x.text) for x in docs.collect())
    got = {x.doc_id: (x.text, x.n_removed) for x in queries.op3(spark, SF).collect()}
    want = slow_passages(order, chunks=True)
    assert [got[d][0] for d, _ in order] == want and sum(got[d][1] for d in got) > 0
    assert all(got[d][1] == t.count("\n") - w.count("\n") + (w == "" and got[d][1] > 0) for (d, t), w in zip(order, want))


@pytest.mark.parametrize("bits", [64, 3])
def test_passages_match_brute_force(spark, bits):
    r = random.Random(2)
    pool = [[prose(70 * k + i, r.choice([0, 4, 12, 30, 60])) for i in range(9)] for k in range(4)]
    texts = ["\n".join([prose(999 + i, 3)] + r.choice(pool)[r.randrange(6):] + [prose(5000 + i, 2)] + r.choice(pool)[:r.randrange(1, 9)]) for i in range(20)]
    texts += ["", "\n\n", "\n".join(["five words in this line"] * 40), "\n".join([prose(1, 5), prose(2, 6)] * 15), texts[0]]
    got = {x.doc_id: x.text for x in line_dedup.dedup_passages(docs_of(spark, texts), hash_bits=bits).collect()}
    assert [got[i] for i in range(len(texts))] == slow_passages(enumerate(texts))


def test_planted_passages_go(spark):
    plant = {n: "\n".join(prose(100 * n + i, 55 // n + 1) for i in range(n)) for n in range(1, 11)}
    texts = list(plant.values()) + ["\n".join([prose(7000 + 10 * n + k, 9), p, prose(8000 + 10 * n + k, 9)]) for n, p in plant.items() for k in range(3)]
    got = {x.doc_id: x.text for x in line_dedup.dedup_passages(docs_of(spark, texts), chunks=True).collect()}
    assert [got[i] for i in range(10)] == texts[:10]
    assert [got[10 + i] for i in range(30)] == ["\n".join([prose(7000 + 10 * n + k, 9), prose(8000 + 10 * n + k, 9)]) for n in plant for k in range(3)]


def test_passages_odd_rows(spark):
    d = odd_docs(spark)
    out = line_dedup.dedup_passages(d)
    assert out.columns == d.columns and out.count() == d.count()
    assert out.filter("_id <> 'mine' or row <> 'mine'").count() == 0 and out.filter("doc_id = 2 and text is null").count() == 1
    # rows of equal id keep their copies, but for those seen in a smaller id
    assert out.filter(F.col("text") == prose(1, 60)).count() == 1 and out.filter(F.col("text") == prose(2, 60)).count() == 1
    assert line_dedup.dedup_passages(empty(spark)).count() == 0


# ------------------------------------------------------------------ 4 language model

def test_language_model(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    got = {x.doc_id: x for x in maxent_lm.score(d, frequent=200, rounds=6).collect()}
    docs = [(x.doc_id, (x.text or "").encode().lower().split() + [None]) for x in d.collect()]
    c = Counter()
    for i, w in docs:
        if zlib.crc32(str(i).encode()) % 10:
            c.update(w)
    n, v = sum(c.values()), len(c)
    for i, w in docs:
        x = got[i]
        assert (x.n_tokens, x.n_known, x.train_tokens, x.held_out) == (len(w), sum(c[t] > 0 for t in w), n, zlib.crc32(str(i).encode()) % 10 == 0)
        assert math.isclose(x.base_score, sum(math.log10((c[t] + .1) / (n + .1 * (v + 1))) for t in w), rel_tol=1e-9)
    held = [x for x in got.values() if x.held_out]
    assert sum(x.score for x in held) > sum(x.base_score for x in held)


def test_language_model_is_a_distribution():
    z = maxent_lm.log_softmax(np.random.default_rng(0).normal(size=(5, maxent_lm.CLASSES)))
    assert np.allclose(np.exp(z).sum(1), 1)
    vocab = maxent_lm.Vocabulary([(b"the", 9), (b"of", 5)])
    h, c, of, _ = maxent_lm.histories([b"The of xyz", b"", b"of"], vocab)
    assert of.tolist() == [0, 0, 0, 0, 1, 2, 2] and c[[0, 1, 3, 4, 5, 6]].tolist() == [1, 2, 0, 0, 2, 0]
    assert h[[0, 1, 2, 4, 5]].tolist() == [0, maxent_lm.CONTEXTS, 2 * maxent_lm.CONTEXTS + 1, 0, 0]


def test_language_model_odd_rows(spark):
    d = odd_docs(spark)
    rows = maxent_lm.score(d, rounds=2).collect()
    assert len(rows) == d.count()
    assert {x.n_tokens for x in rows if x.doc_id in (2, 3, 5)} == {1}
    assert len({(x.score, x.n_known) for x in rows if x.doc_id == 4}) == 2
    assert maxent_lm.score(empty(spark), rounds=1).count() == 0


# ------------------------------------------------------------------ 5 quality

def test_quality_labels(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    x = quality.classify(d).join(lab, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in x}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.99
    assert n[0, False] / (n[0, False] + n.get((0, True), 0)) > 0.85


def test_quality_estimates_accuracies():
    r = np.random.default_rng(2)
    y = r.random(20000) < 0.8
    acc = [0.95, 0.9, 0.8, 0.7, 0.9, 0.85, 0.75, 0.9]
    v = np.stack([np.where(r.random(len(y)) < a, y, ~y) * 2 - 1 for a in acc], axis=1).astype(np.int8)
    v[r.random(v.shape) < 0.2] = 0
    p, n = np.unique(v, axis=0, return_counts=True)
    _, right = quality.estimate(p, n)
    assert np.abs(right - acc).max() < 0.05


def test_quality_odd_rows(spark):
    d = odd_docs(spark)
    rows = quality.classify(d).collect()
    assert len(rows) == d.count() and all(x.kept for x in rows if x.n_words < 5)
    kept = quality.classify(d, filtered=True)
    assert kept.schema == d.schema and kept.count() == sum(x.kept for x in rows)
    assert quality.classify(empty(spark)).count() == 0
    a, b = quality.statistics([prose(1, 40).encode(), b"X"]), quality.statistics([prose(1, 40).encode()])
    assert np.array_equal(a[0][0], b[0][0])


# ------------------------------------------------------------------ 6 mixing

def test_mixing_reaches_the_weights(spark):
    d = docs_of(spark, [prose(i, 20) for i in range(1500)]).withColumn("source", F.when(F.col("doc_id") < 1200, "big").otherwise("small"))
    out = mixing.mix(d, {"big": 1, "small": 3})
    mass = {x.source: x.m for x in out.groupBy("source").agg(F.sum(F.length("text")).alias("m")).collect()}
    assert 2.6 < mass["small"] / mass["big"] < 3.4
    joined = mixing.mix(d, {"big": 1, "small": 3}, broadcast_sources=0)
    assert joined.exceptAll(out).count() == 0 and out.exceptAll(joined).count() == 0
    many = mixing.mix(d.filter("doc_id < 60"), {"big": 1}, budget=60 * 60 * 100.0)          # means above 16: several draws
    n = many.count() / 60
    want = mixing.rates(d.filter("doc_id < 60"), {"big": 1}, 60 * 60 * 100.0).first()["mean"]
    assert want > 16 and abs(n - want) < 5 * math.sqrt(want / 60)


def test_mixing_odd_rows(spark):
    d = odd_docs(spark)
    out = mixing.mix(d)
    assert set(d.columns) <= set(out.columns) and out.filter("_name <> 'mine'").count() == 0
    per = {(x.doc_id, x.copy): x["count"] for x in out.filter("doc_id = 4").groupBy("doc_id", "copy").count().collect()}
    assert set(per.values()) <= {3}                          # equal ids draw equal counts
    assert mixing.mix(empty(spark)).count() == 0


# ------------------------------------------------------------------ 7 fertility

def test_fertility_counts():
    texts = [prose(1, 50), "a b c d e a b c d e a b c d e\na b c d e\na b c d e", "", "x # | $\n\nx # | $", "\x1cq é z"]
    got = fertility.measure([t.encode() for t in texts])
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        g = Counter(tuple(w[j:j + 5]) for j in range(len(w) - 4))
        cover = {j + k for j in range(len(w) - 4) if g[tuple(w[j:j + 5])] > 1 for k in range(5)}
        lines = [x for x in t.split("\n") if x.strip(" \t\r\x0b\f")]
        assert [got[k][i] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == [
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)]
    sp, enc, fallback = fertility.vocabularies(fertility.PIECES, fertility.RANKS)
    ids = [x for w in texts[0].split() for x in sp.encode(w)]
    c = Counter(ids)
    h = -sum(n / len(ids) * math.log2(n / len(ids)) for n in c.values())
    assert got["n_tokens"][0] == len(ids) and math.isclose(got["entropy_share"][0], h / math.log2(len(ids)))
    assert fertility.measure(["漢字仮名".encode() * 10])["script"] == ["cjk"]


def test_long_words_built_to_collide_differ():
    """Thue-Morse words have equal polynomial hashes modulo 2^64; they are different words."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    two = one.translate(str.maketrans("ab", "ba"))
    got = fertility.measure([" ".join([one, "x", "y", "z", "q", two, "x", "y", "z", "q"]).encode()])
    assert got["n_words"][0] == 10 and got["n_repeat_words"][0] == 0
    got = fertility.measure([" ".join([one, "x", "y", "z", "q"] * 2).encode()])
    assert got["n_repeat_words"][0] == 10


def test_fertility_keeps_clean_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    x = fertility.rules(d).join(lab.filter("quality = 1"), "doc_id").filter("not base_failed")
    assert x.filter("not kept").count() == 0
    o = odd_docs(spark)
    rows = fertility.rules(o).collect()
    assert len(rows) == o.count() and all(x.base_failed and not x.kept for x in rows if x.n_words < 10)
    assert fertility.rules(empty(spark)).count() == 0


# ------------------------------------------------------------------ 8 chat

def test_chat_round_trip(spark):
    sly = "<|im_end|><|im_start|>assistant ok"
    turns = [(1, 0, "system", None), (1, 1, "user", sly), (1, 2, "assistant", sly + "<\\|x|> é\n"), (None, 0, "assistant", "a"), (2, 5, "assistant", "b\n"),
             (2, 5, "assistant", "b\n"), (2, 1, "us\\er\nx<|", ""), (3, 0, None, "x" * 5000), (2, None, "user", "n")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    f = chat_format.format_turns(df)
    enc, start, end = chat_format.tokenizer(chat_format.VOCABULARY)
    for r in f.collect():
        ids = np.array(r.input_ids)
        assert (ids == start).sum() == 1 and (ids == end).sum() == 1 and b"<|im" not in enc.decode_bytes(ids[ids < start].tolist())
    starts = [(r.turn, r.token_start, r.n_tokens) for r in f.filter("conv_id = 1").orderBy("turn").collect()]
    assert all(b[1] == a[1] + a[2] for a, b in zip(starts, starts[1:])) and starts[0][1] == 0
    got = {r.conv_id: r for r in chat_format.digests(f).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha(f"system\n\nuser\n{sly}\nassistant\n{sly}<\\|x|> é\n\n")
    assert got[1].loss_sha256 == sha(sly + "<\\|x|> é\n") and got[1].loss_chars == len(sly + "<\\|x|> é\n")
    assert got[2].n_turns == 4 and got[2].loss_sha256 == sha("b\nb\n") and got[2].turns_sha256 == sha("user\nn\nus\\er\nx<|\n\nassistant\nb\n\nassistant\nb\n\n")
    assert got[None].n_turns == 1 and got[3].loss_chars == 0
    assert chat_format.digests(chat_format.format_turns(df.limit(0))).count() == 0


# ------------------------------------------------------------------ 9 HTML

CASES = [
    ("<html><head><title>t</title><style>p{}</style></head><body><nav><a href=x>Menu</a></nav><div class=ad>Buy</div><article><h1>Head</h1>"
     "<p>First&nbsp;&eacute; &amp; <b>bold</b>\n text<br>more<p>Short.</article><footer>&copy; x</footer>", "Head\nFirst é & bold text more\nShort."),
    ("<body><header><h2>Site</h2></header><main><h1>T</h1><p>Body one</p><aside>side</aside><p>Two</p><div class='comments'><p>me too</p></div></main>", "T\nBody one\nTwo"),
    ("<div id=cookie-notice><p>We use cookies</p></div><article><p>a &lt; b</p><form><input><label>Mail</label></form><script>var a='</p>';</script><p>c</article>", "a < b\nc"),
    ("<ul><li><a href=1>Home</a><li><a href=2>News</a></ul><div><p>" + "Long text here. " * 8 + "</p><p>End.</p></div><div class=footer>foot</div>", ("Long text here. " * 8).strip() + "\nEnd."),
    ("", ""), (None, ""), ("<!-- x --><p", ""), ("<article><p>unclosed", "unclosed"), ("plain only", "plain only"),
    ("<article class='post has-sidebar'><p>x</p><section id=comments><article class=comment><p>hi</p></article></section></article>", "x"),
]


@pytest.mark.parametrize("page,want", CASES)
def test_html_main_text(page, want):
    assert html_extract.main_text(page) == want


BODY = "This is the body of the page and it goes on for some time. " * 8
SAID = "The patient lives alone and has worked as a baker for thirty years. " * 4
MASS = [
    (f"<main><p>{BODY}</p></main><article><p>teaser</p></article>", BODY),
    (f"<main><h1>T</h1><p>{BODY}</p><article><p>teaser</p></article></main>", f"T\n{BODY}\nteaser"),
    (f"<main><p>{BODY}</p></main><div class=related><article><p>teaser</p></article></div><div class=sidebar><article><p>t2</p></article>x</div>", BODY),
    (f"<main><p>{BODY}</p></main><nav><article><p>teaser</p></article>more</nav>", BODY),
    (f"<form><article><p>{BODY}</p></article><p>Send</p></form>", BODY),
]
NAMED = [
    *[(f"<article><p>{BODY}</p><section {a}><h2>Part</h2><p>{SAID}</p></section><p>End.</p></article>", f"{BODY}\nPart\n{SAID}\nEnd.")
      for a in ("class=social-history", "class=legal-analysis", "id=search-results", "class=patient-survey", "id=comment")],
    (f"<article><section class=social-history><p>Lives alone.</p></section><h2 id=ratings>Ratings</h2><p>{BODY}</p><h2 id=notice>Notice</h2></article>", f"Lives alone.\nRatings\n{BODY}\nNotice"),
    (f"<article class=legal-analysis><p>{BODY}</p></article>", BODY),
    (f"<p>{BODY}</p><p><a href=x>See the linked page</a></p><p>{BODY}</p>", f"{BODY}\nSee the linked page\n{BODY}"),
    (f"<article><p>{BODY}</p><div class=share-links><a href=1>One</a> <a href=2>Two</a></div><div class=comments>" + f"<div class=comment><p>{SAID}</p></div>" * 3 + "</div></article>", BODY),
    (f"<article><p>A <span class=notice>short</span> <span class=legal-term>tort</span> x. {BODY}</p></article>", f"A tort x. {BODY}"),
]


READERS = "<p>" + "I say that this is all wrong. " * 14 + "</p>"
LONG_NAMED = [
    *[(f"<article><p>{BODY}</p><section class={c}>{READERS}</section><p>End.</p></article>", f"{BODY}\nEnd.") for c in ("comments", "discussion", "cookie-notice", "advert")],
    *[(f"<main><p>{BODY}</p><div class={c}>{READERS}</div></main>", BODY) for c in ("cookie-notice", "comments", "advert")],
    (f"<div><p>{BODY}</p></div><div class=comments>{READERS * 4}</div>", BODY),               # longer than the body
    (f"<div class=comments><h2>Talk</h2>{READERS}</div><p>x</p>", f"Talk\n{'I say that this is all wrong. ' * 14}"),       # the page's only text
]


@pytest.mark.parametrize("page,want", LONG_NAMED)
def test_html_boilerplate_of_any_length(page, want):
    got = html_extract.main_text(page)
    assert got == "\n".join(x.strip() for x in want.split("\n")) or "Talk" in want and got.startswith("\n".join(x.strip() for x in want.split("\n")))


@pytest.mark.parametrize("page,want", MASS)
def test_html_main_text_by_mass(page, want):
    assert html_extract.main_text(page) == "\n".join(x.strip() for x in want.split("\n"))


@pytest.mark.parametrize("page,want", NAMED)
def test_html_names_look_at_text(page, want):
    assert html_extract.main_text(page) == "\n".join(x.strip() for x in want.split("\n"))


def test_html_pages(spark):
    p = spark.read.parquet(f"{SF}/pages.parquet")
    rows = html_extract.extract(p).collect()
    assert len(rows) == p.count() and all(r.n_chars == len(r.text) for r in rows)
    odd = spark.createDataFrame([(1, None, None, "mine", 3), (1, "u", "<p>" + "word " * 100_000, "mine", 3), (None, "u", "", "mine", 3)], "page_id long, url string, html string, _html string, n_chars long")
    out = html_extract.extract(odd)
    assert out.columns == ["page_id", "url", "_html", "text", "n_chars"] and out.count() == 3 and out.agg(F.max("n_chars")).first()[0] == 499_999
    assert html_extract.extract(odd.limit(0)).count() == 0


# ------------------------------------------------------------------ 10 decontamination

def slow_leaks(docs, items):
    def grams(w):
        k = min(5, len(w))
        return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()
    out = set()
    for d, t in docs:
        w = (t or "").encode().lower().split()
        for i, it in items:
            v = (it or "").encode().lower().split()
            if not v or not w:
                continue
            g = grams(v)
            for s in range(max(1, len(w) - len(v) + 1)):
                x = grams(w[s:s + len(v)])
                both = sum((x & g).values())
                if both / (sum(x.values()) + sum(g.values()) - both) >= 0.8:
                    out.add((d, i))
                    break
    return out


def test_leaks_match_brute_force(spark):
    r = random.Random(4)
    items = [(i, prose(300 + i, n)) for i, n in enumerate([3, 5, 8, 14, 20, 30, 45, 60])] + [(90, None), (91, ""), (92, prose(304, 20))]
    texts = []
    for k in range(30):
        w = prose(700 + k, r.randint(0, 60)).split()
        if k % 2:
            v = r.choice(items[:8])[1].split()
            for _ in range(k % 3):
                v[r.choice([0, 1, -1, len(v) // 2])] = "qq"
            at = r.randint(0, len(w))
            w[at:at] = v if k % 5 else v[: max(1, len(v) - 1)]
        texts.append(" ".join(w).upper() if k % 7 == 0 else "  ".join(w))
    texts += [None, "", prose(306, 45)]
    d, b = docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    want = slow_leaks(enumerate(texts), items)
    assert len(want) >= 8
    for n in (20_000, 4):
        assert {(x.doc_id, x.item_id) for x in decontaminate.find_leaks(d, b, slice_items=n).collect()} == want
        left = {x.doc_id for x in decontaminate.drop_leaks(d, b, slice_items=n).collect()}
        assert left == set(range(len(texts))) - {x for x, _ in want}


def test_leaks_odd_rows(spark):
    d, b = odd_docs(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.find_leaks(d, b).count() == 0
    kept = decontaminate.drop_leaks(d, b)
    assert kept.schema == d.schema and kept.count() == d.count()
    assert decontaminate.find_leaks(empty(spark), b).count() == 0
    assert decontaminate.find_leaks(d, b.limit(0)).count() == 0 and decontaminate.drop_leaks(d, b.limit(0)).count() == d.count()


# ------------------------------------------------------------------ pipeline and queries

def test_pipeline_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], "/root/testdata/sf0.01").cache())
        assert name == "mixing" or seen[-1].columns == docs.columns
    ids = [{x.doc_id for x in s.select("doc_id").collect()} for s in seen]
    kept = {x.doc_id for x in quality.classify(docs).filter("kept").collect()}
    assert ids[1] == kept and ids[2] == kept
    rows = {x.doc_id: x.text for x in seen[2].collect()}
    before = sorted((x.doc_id, x.text) for x in seen[1].collect())
    assert [rows[d] for d, _ in before] == slow_passages(before, chunks=True)
    order = sorted(rows)
    comp = slow_components([slow_print(rows[i]) for i in order], order, 4)
    assert ids[3] == set(comp)
    items = [(x.item_id, x.text) for x in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    assert ids[4] == ids[3] - {d for d, _ in slow_leaks([(i, rows[i]) for i in sorted(ids[3])], items)}
    assert ids[5] <= ids[4]
    for s in seen[1:]:
        s.unpersist()


def test_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.LLM_REGISTRY) == list(range(1, 14))
