"""Spelling variants, license scan and periodic runs against brute force and hand-made cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from folio.llm import licenses, queries, runs, spelling

DOCS = "doc_id long, text string"


def prose(seed, n):
    r = random.Random(seed)
    syl = ["the", "of", "ra", "ti", "on", "en", "la", "mo", "ki", "su", "é"]
    return " ".join("".join(r.choices(syl, k=r.randint(1, 5))) for _ in range(n))


def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing names."""
    long = prose(7, 30_000)
    rows = [(1, prose(1, 60)), (2, None), (None, prose(1, 60)), (3, ""), (4, prose(1, 60)), (4, prose(1, 60)), (4, prose(2, 60)), (5, " \n\t "),
            (6, long), (7, long + " x"), (None, None), (8, "one"), (None, "a b " * 40 + "MIT License")]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("_key", "w", "word", "n", "form", "root", "label", "size", "block", "token", "at", "runs", "start", "hit", "g", "a", "p", "_s"):
        df = df.withColumn(c, F.lit("mine"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


def at(tmp_path, df):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


# ------------------------------------------------------------------ 11 spelling variants

def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def slow_variants(n_of, ratio=10):
    cut = lambda w: {w} | {w[:i] + w[i + 1:] for i in range(len(w))}
    having = defaultdict(set)               # words one edit apart share a word of theirs with a letter cut out, or themselves
    for w in n_of:
        for c in cut(w):
            having[c].add(w)
    near = {w: [x for x in set().union(*(having[c] for c in cut(w))) if one_edit(w, x)] for w in n_of}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-n_of[x], x), default=None)
        form[w] = best if best is not None and n_of[best] >= ratio * n_of[w] else None
    out = []
    for w in n_of:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n_of[w], len(near[w]), n_of[form[w]] if form[w] else None))
    return sorted(out)


def slow_words(rows, noise):
    n = Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % noise == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def test_pivot_keys_meet_for_every_edit():
    r = random.Random(4)
    for trial in range(3000):
        letters = "abc" if trial % 3 else "abcdefghijklmnopqré"
        w = "".join(r.choices(letters, k=r.randint(4, 12)))
        k, c = r.randrange(len(w) + 1), r.choice(letters)
        x = [w[:k] + c + w[k:], w[:k] + w[k + 1:], w[:k] + c + w[k + 1:]][trial % 3]
        if x == w or len(x) < 4:
            continue
        if trial % 300 == 0:
            rank, cache = list(range(spelling.CLASSES)), {}
            r.shuffle(rank)
        (la, ia, qa), (lb, ib, qb) = (spelling.signature(y, rank, cache) for y in (w, x))
        assert (la <= lb and set(qa) & set(ib)) or (lb <= la and set(qb) & set(ia)), (w, x)


def test_pivots_are_the_cheapest_pair():
    r = random.Random(5)
    for _ in range(500):
        prefix = sorted((p, r.randint(0, 9)) for p in r.sample(range(9), r.randint(3, 6)))
        got = spelling.pivots(prefix)
        cost = dict(prefix)
        pairs = [(cost[a] + cost[b]) for a in cost for b in cost if b - a >= 2]
        assert got[1] - got[0] >= 2 and cost[got[0]] + cost[got[1]] == min(pairs)


def test_variants_match_brute_force(spark):
    r = random.Random(8)
    n_of = {}
    for k in range(150):
        w = "".join(r.choices("abcdeé" if k % 2 else "aab", k=r.randint(4, 9)))
        n_of[w] = r.choice([2, 3, 50, 700, 9000])
        for _ in range(r.randint(0, 5)):
            i, c = r.randrange(len(w) + 1), r.choice("abcz")
            v = r.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]])
            if len(v) >= 4:
                n_of[v] = r.choice([2, 3, 50, 700])
    df = spark.createDataFrame(list(n_of.items()), "word string, n long")
    got = sorted(tuple(x) for x in spelling.variants(df).collect())
    assert got == slow_variants(n_of)
    assert any(x[1] and x[2] != x[1] for x in got)          # a chain of forms


def test_op11_matches_brute_force(spark, tmp_path):
    sf = at(tmp_path, odd_docs(spark))
    rows = [tuple(x) for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op11(spark, sf)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = slow_variants(slow_words(rows, 31))
    assert sorted(tuple(x) for x in got.collect()) == want and any(x[4] for x in want)


def test_op11_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(x) for x in queries.op11(spark, sf).collect()) == slow_variants(slow_words(rows, 31))


def test_variants_of_nothing(spark):
    assert spelling.variants(spelling.word_counts(empty(spark))).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(spelling.word_counts(empty(spark)), min_letters=3)
    with pytest.raises(ValueError):
        spelling.variants(spelling.word_counts(empty(spark)), ratio=1)


# ------------------------------------------------------------------ 12 license scan

def slow_scan(text, phrases=licenses.PHRASES, templates=licenses.TEMPLATES):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    ws = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    places = sorted((i, label) for label, p in phrases for q in [p.split()] for i in range(len(ws)) if ws[i:i + len(q)] == q)
    met = [(1.0, label) for _, label in places]
    for label, x, wording in templates:
        t = licenses.plain_words(wording)
        size = 1
        while size < len(t):
            size *= 2
        for lo in range(0, max(len(ws), 1), size):
            share = len(set(t) & set(ws[lo:lo + 2 * size])) / len(set(t))
            if share >= math.ceil(x * len(set(t)) - 1e-9) / len(set(t)):
                met.append((share, label))
    names = lambda xs: ",".join(sorted(set(xs)))
    return (len(ws), len(places), places[0][0] if places else None, places[-1][0] if places else None, names(x for _, x in places),
            names(x for _, x in met), max((s for s, _ in met), default=0.0))


def near_licenses():
    """Templates with words left out, exchanged and scattered, between prose."""
    r = random.Random(2)
    out = []
    for k in range(120):
        parts = []
        for _ in range(r.randint(0, 4)):
            w = r.choice(licenses.TEMPLATES)[2].split()
            for _ in range(r.choice([0, 1, 3, 8])):
                if w:
                    w.pop(r.randrange(len(w)))
            if r.random() < 0.2:
                r.shuffle(w)
            parts += [prose(r.randint(0, 10**6), r.randint(0, 50)), " ".join(w)]
        out.append(r.choice([" ", "\n", " -- "]).join(parts))
    return out


def test_scan_matches_brute_force_and_twin(spark):
    texts = near_licenses() + [None, "", "MIT-LICENSE mit license", "general general public license", "miT licenſe", "MİT License", "KMIT License mit liceÉnse",
                               "apache license " * 300, licenses.TEMPLATES[0][2] * 40]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {x.doc_id: tuple(x)[1:] for x in licenses.scan(df).collect()}
    want = {i: slow_scan(t) for i, t in enumerate(texts)}
    assert got == want
    assert sum(x[5] != x[4] for x in want.values()) > 40 and sum(0 < x[6] < 1 for x in want.values()) > 10
    con = duckdb.connect()
    pdf = df.toPandas()
    con.register("documents", pdf)
    assert {x[0]: x[1:] for x in con.execute(licenses.oracle_sql()).fetchall()} == want


def test_scan_order_of_words_comes_from_all_documents(spark):
    """A very common template word changes the prefix, never the result."""
    texts = near_licenses()[:40]
    flood = [(1000 + i, "granted charge software license " * 200) for i in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)) + flood, DOCS)
    got = {x.doc_id: tuple(x)[1:] for x in licenses.scan(df).collect()}
    assert all(got[i] == slow_scan(t) for i, t in enumerate(texts))


def test_scan_odd_rows(spark, tmp_path):
    d = odd_docs(spark)
    got = sorted((tuple(x) for x in licenses.scan(d).collect()), key=str)
    want = sorted(((x.doc_id, *slow_scan(x.text)) for x in d.select("doc_id", "text").collect()), key=str)
    assert got == want
    assert licenses.scan(empty(spark)).count() == 0
    only = licenses.scan(d, templates=()).filter("labels <> ''").collect()
    assert [x.base_labels for x in only] == ["mit"]
    assert licenses.scan(d, phrases=()).filter("n_base > 0").count() == 0
    with pytest.raises(ValueError):
        licenses.scan(d, templates=(("x", 1.5, "one two"),))
    assert queries.op12(spark, at(tmp_path, d)).columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def test_scan_runs_no_python_worker(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = licenses.find_licenses(docs)._jdf.queryExecution().executedPlan().toString() + licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "MapInArrow", "MapInPandas", "Scan ExistingRDD"))


# ------------------------------------------------------------------ 13 periodic runs

def slow_runs(w, least=12):
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q - i), q)           # the least period comes first
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def slow_collapse(w, found):
    return [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in found)]


def runny():
    r = random.Random(1)
    out = []
    for _ in range(250):
        w = [str(r.randint(0, r.randint(1, 4))) for _ in range(r.randint(0, 60))]
        if w and r.random() < 0.5:
            s, p = r.randrange(len(w)), r.randint(1, 9)
            w = w[:s] + [w[min(s + i % p, len(w) - 1)] for i in range(r.randint(5, 60))] + w[s:]
        out.append(w)
    fib = ["a", "ab"]
    while len(fib[-1]) < 200:
        fib.append(fib[-1] + fib[-2])
    return out + [list(fib[-1]), ["a"] * 100, ["a", "b"] * 30 + ["c"] + ["a", "b"] * 30, list("abcabcabcabcab" * 9) + list("abcabcabcabcab" * 9)]


@pytest.mark.parametrize("least", [2, 6, 12])
def test_runs_match_brute_force(least):
    docs = runny()
    assert runs.runs_in([[x.encode() for x in w] for w in docs], least) == [slow_runs(w, least) for w in docs]
    assert [runs.runs_in([[x.encode() for x in w]], least)[0] for w in docs[::9]] == [slow_runs(w, least) for w in docs[::9]]


def test_runs_in_blocks_are_the_same(monkeypatch):
    seq = __import__("numpy").array([0, 1, 0, 1, 0, 1, 1, 0, 1, 1, 0, 1, 1, 2, 2, 2, 2, 2] * 3 + [9])
    ranks = runs.suffix_ranks(seq)
    sets = [set(zip(*(x.tolist() for x in runs.branching_squares(ranks, block)))) for block in (1, 7, 1 << 20)]
    assert sets[0] == sets[1] == sets[2] and sets[0]


def test_long_runs():
    r = random.Random(3)
    w = [str(r.randint(0, 400)).encode() for _ in range(900)] * 120
    assert runs.runs_in([w]) == [[(0, 108_000, 900)]]
    assert runs.runs_in([[b"x"] * 100_000]) == [[(0, 100_000, 1)]]


def slow_op13(doc, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = slow_runs(w)
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc, len(found), *top, 1000 * top[1] // top[2] if found else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(slow_collapse(w, found))))


def test_op13_matches_brute_force(spark, tmp_path):
    texts = [" ".join(w) for w in runny()] + [None, "", " a b", prose(3, 700)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, texts[3]), (None, None), (7, texts[7]), (7, texts[8])], DOCS).withColumn("runs", F.lit("mine")).withColumn("w", F.lit(1))
    sf = at(tmp_path, df)
    got = queries.op13(spark, sf)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [slow_op13(x.doc_id, x.text) for x in df.select("doc_id", "text").collect()]
    assert sorted((tuple(x) for x in got.collect()), key=str) == sorted(want, key=str)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))) > 10


def test_op13_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    short = [x for x in rows if len((x.text or "").split()) < 700]
    got = {x.doc_id: tuple(x) for x in queries.op13(spark, sf).collect()}
    assert len(got) == len(rows) and all(got[x.doc_id] == slow_op13(x.doc_id, x.text) for x in short)
    assert any(x[1] for x in got.values())


def test_runs_odd_rows(spark):
    d = odd_docs(spark)
    got = runs.find_runs(d).collect()
    assert len(got) == d.count() and runs.find_runs(empty(spark)).count() == 0
    again = [x for x in got if x.doc_id is None and x.runs]
    assert [(tuple(again[0].runs[0]), again[0].collapsed)] == [((0, 80, 2), "a b MIT License")]
    assert all(x.collapsed == "" for x in got if x.n_words == 0)
