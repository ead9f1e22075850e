"""Whole results of the classifier, the language model, the chat format and the line blocks against plain loops."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.llm import chat_format, html_extract, maxent_lm, quality

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1


def mix(h):
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & MASK
    return h ^ (h >> 31)


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", text)


# ------------------------------------------------------------------ 4 language model

def slow_scores(docs, frequent, rounds, rate):
    """{doc_id: score} of the class-factored model, cell by cell."""
    n_cls, n_ctx = maxent_lm.CLASSES, maxent_lm.CONTEXTS
    texts = {i: words((t or "").encode().lower()) for i, t in docs}
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 10]
    count = Counter(w for i in train for w in texts[i])
    n = sum(count.values()) + len(train)
    top = sorted((w for w in count if count[w] * frequent >= n), key=lambda w: (-count[w], w))
    rank = {w: k for k, w in enumerate(top)}

    def place(w, own, size):
        if rank.get(w, size) < own - 1:
            return rank[w] + 1
        return own + mix(w[-1] * 256 + w[-2:][0] + 1) % (size - own)

    def cls(w):
        return place(w, maxent_lm.TOP_CLASSES, n_cls)

    def steps(ws):
        one = two = 0
        for w in [*ws, None]:
            yield (one, two), 0 if w is None else cls(w)
            if w is not None:
                one, two = place(w, maxent_lm.TOP_CONTEXTS, n_ctx), one

    def feats(h):
        keys = (h[0], h[1] + (1 << 20), h[0] * n_ctx + h[1] + (1 << 40))
        return [mix(k * 0x9E3779B97F4A7C15 & MASK) % maxent_lm.FEATURES for k in keys]

    cells = defaultdict(lambda: np.zeros(n_cls))
    for i in train:
        for h, c in steps(texts[i]):
            cells[h][c] += 1
    size, kinds = np.zeros(n_cls), np.zeros(n_cls)
    for w, c in count.items():
        size[cls(w)] += c
        kinds[cls(w)] += 1
    size[0], kinds[0] = len(train), float(bool(train))
    bias = np.log((size + .5) / (size + .5).sum())
    weight = defaultdict(lambda: np.zeros(n_cls))

    def log_p(h):
        z = bias + sum(weight[f] for f in feats(h))
        return z - z.max() - math.log(np.exp(z - z.max()).sum())

    for _ in range(rounds):
        grad, mass = defaultdict(lambda: np.zeros(n_cls)), defaultdict(lambda: np.full(n_cls, 5.0))
        for h, seen in cells.items():
            expect = np.exp(log_p(h)) * seen.sum()
            for f in feats(h):
                grad[f] += seen - expect
                mass[f] += np.maximum(seen, expect)
        for f in grad:
            weight[f] = weight[f] + rate * grad[f] / mass[f]
    out = {}
    for i, ws in texts.items():
        total = 0.0
        for w, (h, c) in zip([*ws, None], steps(ws)):
            share = (len(train) if w is None else count[w]) + .1
            total += log_p(h)[c] / math.log(10) + math.log10(share / (size[c] + .1 * (kinds[c] + 1)))
        out[i] = total
    return out


def test_language_model_scores(spark):
    r = random.Random(5)
    vocab = ["".join(r.choices("abcdefgé", k=r.randint(1, 7))) for _ in range(300)]
    docs = [(i, " ".join(vocab[min(int(r.expovariate(.02)), 299)].upper() if r.random() < .1 else vocab[min(int(r.expovariate(.02)), 299)]
                         for _ in range(r.randint(0, 60)))) for i in range(120)] + [(500, None), (501, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = slow_scores(docs, 100, 5, 0.6)
    got = {x.doc_id: x.score for x in maxent_lm.score(df, frequent=100, rounds=5, rate=0.6).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[i], want[i], rel_tol=1e-4, abs_tol=1e-4) for i in want)


# ------------------------------------------------------------------ 5 quality

def slow_statistics(text):
    raw, low = words(text), words(text.lower())
    n = max(len(raw), 1)
    letters = len(re.findall(rb"[A-Za-z]", text))
    grams = [tuple(low[i:i + 5]) for i in range(len(low) - 4)]
    seen = Counter(grams)
    known = {w.encode() for w in quality.FUNCTION_WORDS}
    edge = re.compile(rb"[0-9A-Za-z\x80-\xff]")
    return [sum(a == b for a, b in zip(low, low[1:])) / n, len(re.findall(rb"[A-Z]", text)) / max(letters, 1),
            len(re.findall(rb"[#*$%&|<>]", text)) / n, text.count(b"!") / n,
            sum(len(w) > 2 and not edge.match(w[-1:]) and not edge.match(w[-2:-1]) for w in raw) / n, low.count(b"|") / n,
            sum(w not in known for w in low) / n, sum(seen[g] > 1 for g in grams) / max(len(grams), 1)], len(raw)


def slow_votes(stats, n):
    out = []
    for name, good, bad in quality.LABELLERS.values():
        x = stats[quality.STATS.index(name)]
        out.append(0 if n < 5 else -1 if x > bad else 1 if x <= good else 0)
    return tuple(out)


def slow_posteriors(rows, rounds=100):
    """EM document by document."""
    p = [0.9 if not any(v) else 0.95 if v.count(1) > 3 * v.count(-1) else 0.05 for v in rows]
    for _ in range(rounds):
        prior = min(max(sum(p) / len(p), .01), .99)
        good, bad = [], []
        for j in range(len(rows[0])):
            cast = [(q, v[j]) for q, v in zip(p, rows) if v[j]]
            good.append((9 + sum(q for q, x in cast if x > 0)) / (10 + sum(q for q, _ in cast)))
            bad.append((1 + sum(1 - q for q, x in cast if x < 0)) / (2 + sum(1 - q for q, _ in cast)))
        new = []
        for v in rows:
            a, b = prior, 1 - prior
            for j, x in enumerate(v):
                a *= good[j] if x > 0 else 1 - good[j] if x < 0 else 1
                b *= bad[j] if x < 0 else 1 - bad[j] if x > 0 else 1
            new.append(a / (a + b))
        done = max(abs(x - y) for x, y in zip(new, p)) < 1e-9
        p = new
        if done:
            break
    return p


def slow_features(text, stats):
    tri = [0.0] * quality.TRIGRAMS
    for a, b, c in zip(text, text[1:], text[2:]):
        h = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) & 0xFFFFFFFF
        tri[((h ^ (h >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF) >> 22] += 1
    tri = np.sqrt(tri)
    bins = np.zeros((len(stats), quality.BINS))
    for j, x in enumerate(stats):
        bins[j, min(int(math.sqrt(min(max(x, 0), 1)) * quality.BINS), quality.BINS - 1)] = 1
    return np.r_[tri / max(math.sqrt((tri ** 2).sum()), 1e-9), bins.ravel(), 1.0]


def slow_train(x, y, rounds=300):
    w, v = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    w[-1] = math.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    good = y > 0.5
    share = np.where(good, .5 / max(good.sum(), 1), .5 / max((~good).sum(), 1))
    for _ in range(rounds):
        v = 0.9 * v - (((1 / (1 + np.exp(-(x @ w))) - y) * share) @ x + 1e-5 * w)
        w = w + v
    return w


def test_quality_scores(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    df = df.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "a | b | c | d | e!!!"), (-4, "x x x x x x x"), (-5, "one two")], "doc_id long, text string"))
    texts = {r.doc_id: (r.text or "").encode() for r in df.collect()}
    stats = {i: slow_statistics(t) for i, t in texts.items()}
    fast, n = quality.statistics(list(texts.values()))
    assert n.tolist() == [stats[i][1] for i in texts] and np.allclose(fast, [stats[i][0] for i in texts], atol=1e-12)
    ids = list(texts)
    post = dict(zip(ids, slow_posteriors([slow_votes(*stats[i]) for i in ids])))
    learn = [i for i in ids if stats[i][1] >= 5]                     # the sample holds all of so few documents
    x = {i: slow_features(texts[i], stats[i][0]) for i in ids}
    w = slow_train(np.array([x[i] for i in learn]), np.array([post[i] for i in learn]))
    got = {r.doc_id: r for r in quality.classify(df).collect()}
    for i in ids:
        p = 1 / (1 + math.exp(-float(x[i] @ w)))
        assert abs(got[i].quality_score - p) < 1e-3, i
        assert got[i].kept == (p >= 0.5 or stats[i][1] < 5) or abs(p - 0.5) < 1e-3


# ------------------------------------------------------------------ 8 chat

def test_random_conversations_come_back(spark):
    r = random.Random(11)
    bits = ["<|im_end|>", "<|im_start|>", "<|", "<\\|", "<\\\\|", "|>", "\\", "\n", "é", "漢", "😀", " ", "assistant", "ok", "a" * 40, "<", "\x00", "\t"]
    rows = [(c, t, r.choice(["user", "assistant", "system", "tool\n", "a\\nb", None]), "".join(r.choices(bits, k=r.randint(0, 25))) or r.choice([None, ""]))
            for c in range(40) for t in range(r.randint(1, 9))]
    rows += [(99, t, "assistant" if t % 2 else "user", r.choice(bits) * 3) for t in range(3000)]             # a hot conversation
    rows += [(100, 0, "user", ""), (100, 1, "user", None), (101, 0, "assistant", None)]                     # empty texts only
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("input_ids", "loss_mask", "n_tokens", "token_start", "tie"):
        df = df.withColumn(c, F.lit("mine"))
    formatted = chat_format.format_turns(df.repartition(7))
    got = {x.conv_id: x for x in chat_format.digests(formatted).collect()}
    talks = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda x: x[:2]):
        talks[c].append((role or "", text or ""))
    assert got.keys() == talks.keys()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in talks.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (
            len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(loss), sha(loss))
    place = 0
    for x in formatted.filter("conv_id = 99").orderBy("turn").select("token_start", "n_tokens").collect():
        assert x.token_start == place
        place += x.n_tokens


# ------------------------------------------------------------------ 9 HTML

def slow_runs(n, window, surge):
    """Surge: a window of at least ``surge`` characters (or the fullest); dive: the first window without any."""
    sums = [sum(n[i:i + window]) for i in range(len(n))]
    need = max(1, min(surge, max(sums, default=0)))
    out, i = [], 0
    while i < len(n):
        if sums[i] < need:
            i += 1
            continue
        j = i
        while j < len(n) and sums[j]:
            j += 1
        inside = [k for k in range(i, min(j + 1, len(n))) if n[k]]
        out.append((inside[0], inside[-1] + 1))
        i = j + 1
    return out


@pytest.mark.parametrize("window", [1, 2, 3, 5])
def test_line_block_runs(window):
    r = random.Random(window)
    for _ in range(400):
        n = [r.choice([0, 0, 0, 0, r.randint(1, 90)]) for _ in range(r.randint(0, 40))]
        assert html_extract.runs_of(np.array(n, np.int64), window, None, 60) == slow_runs(n, window, 60)


def test_main_text_of_plain_blocks():
    """Pages of paragraphs without containers: the kept lines are those of the brute-force runs."""
    r = random.Random(4)
    for _ in range(200):
        lines = ["" if r.random() < .6 else " ".join(r.choices(["lorem", "ipsum", "dolor", "x"], k=r.randint(1, 14))) for _ in range(r.randint(1, 30))]
        page = "<html><body>" + "".join(f"<p>{x}</p>" for x in lines) + "</body></html>"
        read, _ = html_extract.lines_of(page)
        texts = [x.text for x in read]
        assert [x for x in texts if x] == [x for x in lines if x]
        want = [t for a, b in slow_runs([len(t) for t in texts], 3, 60) for t in texts[a:b] if t]
        assert html_extract.main_text(page) == "\n".join(want)
