"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document. The
documents are counted by pattern of votes (at most 3^labellers rows, whatever the
input); expectation-maximisation on these counts estimates how often each labeller
is right, and gives each pattern a posterior. A linear scorer over hashed features
(byte trigrams and binned text statistics) learns the posteriors and decides.

The scorer is fitted on a bounded sample, about ``sample_rows`` documents with the
smallest hashes of id and text (documented parameter; never more than twice as many,
should rows of equal id and text crowd there); votes, counts and decisions cover all documents.

Defined results: words are [^\\x20\\x09-\\x0D]+; null and empty texts have no words,
all labellers abstain and they are kept; equal rows get equal scores; an empty table
gives an empty table; further columns pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import textvec as V
from folio.llm.common import digest_key, prepare, text_bytes

# Common function words of the four languages.
FUNCTION_WORDS = ("the of and to in is that for it was on with as by at are be this from or an not have "
                  "de la le les et des en un du une que qui dans par pour sur au est "
                  "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als "
                  "el los las del se por con para y es al lo como").split()
SYMBOLS = b"#*$%&|<>"

#: name -> (statistic, good below, bad above); a value between abstains.
LABELLERS = {
    "repeat": ("repeat", 0.05, 0.12),
    "shout": ("upper", 0.10, 0.25),
    "symbols": ("symbols", 0.04, 0.15),
    "exclaim": ("exclaim", 0.03, 0.12),
    "tails": ("tails", 0.04, 0.12),
    "bars": ("bars", 0.02, 0.10),
    "function": ("content", 0.88, 0.96),
    "grams": ("again", 0.15, 0.45),
}
STATS = ("repeat", "upper", "symbols", "exclaim", "tails", "bars", "content", "again")
TRIGRAMS, BINS = 1 << 10, 8
DIMS = TRIGRAMS + len(STATS) * BINS + 1


def _function_hashes() -> np.ndarray:
    buf, off = V.flat([w.encode() for w in FUNCTION_WORDS])
    return np.unique(V.span_hashes(buf, off[:-1], off[1:]))


def _class_table() -> np.ndarray:
    t = np.zeros((256, 4), np.int32)                     # upper, letter, symbol, '!'
    t[65:91, 0] = t[65:91, 1] = t[97:123, 1] = 1
    t[list(SYMBOLS), 2] = 1
    t[ord("!"), 3] = 1
    return t


def statistics(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Shares of each text in the order of STATS, and its number of words."""
    n = len(texts)
    buf, off = V.flat(texts)
    low = V.lower(buf)
    s, e, doc = V.word_spans(low, off)
    n_words = np.bincount(doc, minlength=n)
    per_word = lambda mask: np.bincount(doc[mask], minlength=n) / np.maximum(n_words, 1)
    table = _class_table()
    totals = []
    for c in range(4):
        run = np.r_[0, np.cumsum(table[:, c][buf], dtype=np.int64)]
        totals.append(run[off[1:]] - run[off[:-1]])
    h = V.span_hashes(low, s, e)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    tails = np.zeros(len(h), bool)
    long = e - s > 2
    word_char = np.zeros(256, bool)
    word_char[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    tails[long] = ~word_char[buf[e[long] - 1]] & ~word_char[buf[e[long] - 2]]
    bars = (e - s == 1) & (low[s] == ord("|")) if len(s) else same
    known = _function_hashes()
    content = ~(known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h)
    again = np.zeros(n)
    k = 5
    if len(h) >= k:
        g = V.gram_hashes(h, k)
        whole = doc[: len(g)] == doc[k - 1 :]
        g, d = g[whole], doc[: len(whole)][whole]
        key = g ^ V.mix64(d.astype(np.uint64))
        _, inv, count = np.unique(key, return_inverse=True, return_counts=True)
        again = np.bincount(d[count[inv] > 1], minlength=n) / np.maximum(np.bincount(d, minlength=n), 1)
    out = {"repeat": per_word(same), "upper": totals[0] / np.maximum(totals[1], 1), "symbols": totals[2] / np.maximum(n_words, 1),
           "exclaim": totals[3] / np.maximum(n_words, 1), "tails": per_word(tails), "bars": per_word(bars),
           "content": per_word(content), "again": again}
    return np.stack([out[x] for x in STATS], axis=1).astype(np.float64), n_words


def votes(stats: np.ndarray, n_words: np.ndarray, min_words: int) -> np.ndarray:
    """1 good, -1 bad, 0 abstain; one column a labeller. Texts below min_words: all abstain."""
    out = np.zeros((len(stats), len(LABELLERS)), np.int8)
    for j, (name, good, bad) in enumerate(LABELLERS.values()):
        x = stats[:, STATS.index(name)]
        out[:, j] = np.where(x > bad, -1, np.where(x <= good, 1, 0))
    out[n_words < min_words] = 0
    return out


def _features(texts: list[bytes], stats: np.ndarray) -> np.ndarray:
    n = len(texts)
    buf, off = V.flat(texts)
    out = np.zeros((n, DIMS), np.float32)
    if len(buf) >= 3:
        doc = np.repeat(np.arange(n), np.diff(off))
        for lo in range(0, len(buf) - 2, V.PIECE):
            b = buf[lo : lo + V.PIECE + 2].astype(np.uint32)
            h = (b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D))
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(22)
            d = doc[lo : lo + len(h)]
            inside = d == doc[lo + 2 : lo + 2 + len(h)]
            out[:, :TRIGRAMS] += np.bincount(d[inside] * TRIGRAMS + h[inside], minlength=n * TRIGRAMS).reshape(n, TRIGRAMS).astype(np.float32)
    tri = out[:, :TRIGRAMS]
    np.sqrt(tri, out=tri)
    tri /= np.maximum(np.sqrt((tri**2).sum(1, keepdims=True)), 1e-9)
    at = np.minimum((np.sqrt(np.clip(stats, 0, 1)) * BINS).astype(np.int64), BINS - 1)
    for j in range(len(STATS)):
        out[np.arange(n), TRIGRAMS + j * BINS + at[:, j]] = 1
    out[:, -1] = 1
    return out


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns: posterior of good for each, and P(right | voted) of each labeller."""
    if not len(patterns):
        return np.zeros(0), np.zeros(patterns.shape[1])
    w = counts.astype(np.float64)
    good, bad = (patterns == 1), (patterns == -1)
    score = good.sum(1) - 3.0 * bad.sum(1)
    p = np.where(score > 0, 0.95, 0.05)
    p[(patterns == 0).all(1)] = 0.9
    cast = good | bad
    for _ in range(rounds):
        prior = np.clip((p * w).sum() / max(w.sum(), 1e-9), 0.01, 0.99)
        right_g = ((p * w)[:, None] * good).sum(0) + 9
        right_g /= ((p * w)[:, None] * cast).sum(0) + 10
        right_b = (((1 - p) * w)[:, None] * bad).sum(0) + 1
        right_b /= (((1 - p) * w)[:, None] * cast).sum(0) + 2
        lg = good @ np.log(right_g) + bad @ np.log(1 - right_g) + np.log(prior)
        lb = good @ np.log(1 - right_b) + bad @ np.log(right_b) + np.log(1 - prior)
        new = 1 / (1 + np.exp(np.clip(lb - lg, -50, 50)))
        if np.abs(new - p).max() < 1e-9:
            p = new
            break
        p = new
    right = ((p * w)[:, None] * good + ((1 - p) * w)[:, None] * bad).sum(0) / np.maximum((w[:, None] * cast).sum(0), 1e-9)
    return p, right


def train(x: np.ndarray, y: np.ndarray, rounds: int = 300, l2: float = 1e-5) -> np.ndarray:
    """Logistic regression on soft labels by full-batch gradient steps with momentum."""
    x = x.astype(np.float64)
    w, v = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    w[-1] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)) if len(y) else 3.0
    if not len(y):
        return w
    share = np.where(y > 0.5, 0.5 / max((y > 0.5).sum(), 1), 0.5 / max((y <= 0.5).sum(), 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        v = 0.9 * v - 1.0 * (x.T @ ((p - y) * share) + l2 * w)
        w = w + v
    return w


def fit(docs: DataFrame, id_col="doc_id", text_col="text", min_words: int = 5, sample_rows: int = 4096):
    """Weights of the scorer, and the labellers' estimated accuracies."""
    rows = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("text"))

    def tally(batches):
        for b in batches:
            v = votes(*statistics(text_bytes(b.column(0))), min_words)
            p, c = np.unique(v, axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([",".join(map(str, x)) for x in p.tolist()], pa.string()), pa.array(c.astype(np.int64))], ["pattern", "n"])

    got = rows.select("text").mapInArrow(tally, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    patterns = np.array([[int(x) for x in r.pattern.split(",")] for r in got], np.int8).reshape(-1, len(LABELLERS))
    posterior, right = estimate(patterns, np.array([r.n for r in got], np.int64))
    known = {r.pattern: float(p) for r, p in zip(got, posterior)}

    def examples(batches):
        for b in batches:
            t = text_bytes(b.column(0))
            s, n = statistics(t)
            y = [known[",".join(map(str, x))] for x in votes(s, n, min_words).tolist()]
            f = _features(t, s)[n >= min_words].astype("<f4")
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in f], pa.binary()), pa.array(np.array(y)[n >= min_words], pa.float64())], ["x", "y"])

    # the documents whose hash lies in the lowest sample_rows / n of all hashes: chosen in the scan, without a sort
    share = min(1.0, sample_rows / max(1, sum(r.n for r in got)))
    pick = rows.filter(F.pmod(F.xxhash64(F.coalesce("i", F.lit("")), digest_key("text")), F.lit(1 << 30)) < int(share * (1 << 30)))
    fitted = pick.select("text").mapInArrow(examples, "x binary, y double").limit(2 * sample_rows).collect()
    x = np.array([np.frombuffer(r.x, "<f4") for r in fitted], np.float32).reshape(-1, DIMS)
    return train(x, np.array([r.y for r in fitted])), dict(zip(LABELLERS, right.tolist()))


def _score(texts: list[bytes], weights: np.ndarray, min_words: int):
    s, n = statistics(texts)
    p = 1 / (1 + np.exp(-np.clip(_features(texts, s).astype(np.float64) @ weights, -50, 50)))
    return p, n, (p >= 0.5) | (n < min_words)


def classify(docs: DataFrame, id_col="doc_id", text_col="text", min_words: int = 5, sample_rows: int = 4096, filtered: bool = False) -> DataFrame:
    """docs with quality_score (double) and kept (boolean); with ``filtered`` the kept rows in the columns of docs."""
    spark = docs.sparkSession
    prepare(spark)
    weights = spark.sparkContext.broadcast(fit(docs, id_col, text_col, min_words, sample_rows)[0])
    at = docs.columns.index(text_col)
    if filtered:
        def run(batches):
            for b in batches:
                yield V.pass_rows(b, _score(text_bytes(b.column(at)), weights.value, min_words)[2])

        return docs.mapInArrow(run, docs.schema)

    def run(batches):
        for b in batches:
            p, n, kept = _score(text_bytes(b.column(0)), weights.value, min_words)
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(n.astype(np.int64)), pa.array(p), pa.array(kept)], ["doc_id", "n_words", "quality_score", "kept"])

    return docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id")).mapInArrow(
        run, "doc_id long, n_words long, quality_score double, kept boolean")
