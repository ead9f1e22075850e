"""Periodic runs of words: maximal repetitions of a text by an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q (words q apart are the
same) and at least max(min_length, 2q) words that no neighbouring word extends keeping q.

A piece of documents becomes one sequence of word numbers, each document closed by a number of its
own, so no suffix of one document shares a word with one of another. Prefix doubling
sorts the suffixes; the ranks of every round stay, since they answer 'are these 2^h words
the same' and so give LCPs forward and backward. For each place k of the LCP array, its
interval of depth d = lcp[k] is split there in two children; every suffix i of the smaller
one asks whether the suffix i + d or i - d lies in the other child (its inverse
suffix array tells). Then both have exactly d words in common at distance d: a square that the
word behind it doesn't continue, the branching tandem. Each suffix is in a smaller child at
most log2(n) times, so there are O(n log n) questions, asked in blocks of arrays; no tree
is built. A square turns left while the word before it equals the one before its second
half; all its rotations merge into one run, whose right end is the square's. Squares of
a multiple of the period give the same stretch; the least period stays.

Words are numbered by their bytes, never by hashes. Documents whose 4-word windows all
differ hold no run of 12 words or more (a period q of 8 or less repeats a 4-word window q later, a longer
one its first q words) and are left out before sorting.

A task holds a piece of ``PIECE`` bytes of texts, or one longer text, at a time.

Defined results: null and empty texts have no run and empty collapsed text; null ids pass;
repeated rows each give their row; an empty table stays empty; other columns are not read,
so none can clash. Equal starts are ordered by period. Every word keeps its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import prepare, text_bytes

PIECE = 1 << 21
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def suffix_ranks(seq: np.ndarray) -> list[np.ndarray]:
    """ranks[h]: order of the suffixes by their first 2^h values, equal where those are; the last one is
    the inverse suffix array. ``seq`` must end with a value that stands once."""
    n = len(seq)
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    first = np.searchsorted(rank[order], np.arange(rank.max() + 1))
    rank = first[rank]                       # a group's rank is the place of its first suffix
    ranks = [rank]
    open_ = order[np.bincount(rank, minlength=n)[rank[order]] > 1]
    step = 1
    while len(open_):
        key = rank[open_] * np.int64(n) + rank[np.minimum(open_ + step, n - 1)]
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        head = np.r_[True, key[1:] != key[:-1]]
        group = np.r_[True, key[1:] // n != key[:-1] // n]
        at = np.arange(len(open_))
        begin = np.maximum.accumulate(np.where(group, at, 0))
        mine = np.maximum.accumulate(np.where(head, at, 0))
        new = rank.copy()
        new[open_] = rank[open_] + mine - begin
        rank = new
        ranks.append(rank)
        size = np.diff(np.r_[np.flatnonzero(head), len(head)])
        open_ = open_[np.repeat(size, size) > 1]
        step *= 2
    return ranks


def common_prefix(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many values the suffixes a[k] and b[k] share (a[k] <> b[k])."""
    n = len(ranks[0])
    a, b, total = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for h in range(len(ranks) - 1, -1, -1):
        same = (ranks[h][np.minimum(a, n - 1)] == ranks[h][np.minimum(b, n - 1)]) & (a < n) & (b < n)
        a += same << h
        b += same << h
        total += same.astype(np.int64) << h
    return total


def common_suffix(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many values before places a[k] < b[k] are the same."""
    a, b, total = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for h in range(len(ranks) - 1, -1, -1):
        w = 1 << h
        same = (ranks[h][np.maximum(a - w, 0)] == ranks[h][np.maximum(b - w, 0)]) & (a >= w)
        a -= same * w
        b -= same * w
        total += same * w
    return total


def smaller_places(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each k the nearest place before it with lcp < lcp[k] and the nearest behind it with lcp <= lcp[k]
    (len(lcp) if none; lcp[0] is below all), by halving steps over minima of 2^h places."""
    n = len(lcp)
    minima = [lcp]
    while 2 << (len(minima) - 1) <= n:
        last, w = minima[-1], 1 << (len(minima) - 1)
        minima.append(np.minimum(last[: n - 2 * w + 1], last[w : n - w + 1]))
    left, right = np.arange(n), np.arange(n) + 1      # all of [left, k] are >= lcp[k]; all of (k, right) are > lcp[k]
    for h in range(len(minima) - 1, -1, -1):
        w = 1 << h
        low = left - w
        go = (low >= 0) & (minima[h][np.maximum(low, 0)] >= lcp)
        left = np.where(go, low, left)
        go = (right + w <= n) & (minima[h][np.minimum(right, n - w)] > lcp)
        right = np.where(go, right + w, right)
    return left - 1, right


def branching_squares(ranks: list[np.ndarray], block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of every square that the value behind it doesn't continue."""
    isa = ranks[-1]
    n = len(isa)
    sa = np.empty(n, np.int64)
    sa[isa] = np.arange(n)
    lcp = np.r_[-1, common_prefix(ranks, sa[:-1], sa[1:])] if n > 1 else np.full(n, -1)
    before, behind = smaller_places(lcp)
    k = np.flatnonzero(lcp > 0)
    depth, lo, hi = lcp[k], np.maximum(before[k], 0), behind[k]      # suffixes lo..k-1 and k..hi-1 share depth values
    left = k - lo <= hi - k
    small, size = np.where(left, lo, k), np.where(left, k - lo, hi - k)
    other, end = np.where(left, k, lo), np.where(left, hi, k)
    starts, periods = [], []
    done, upto = 0, np.cumsum(size)
    while done < len(k):
        to = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + block, side="right")))
        many = size[done:to]
        node = np.repeat(np.arange(done, to), many)
        i = sa[small[node] + np.arange(len(node)) - np.repeat(np.cumsum(many) - many, many)]
        for sign in (1, -1):
            j = i + sign * depth[node]
            ok = (j >= 0) & (j < n)
            where = isa[np.where(ok, j, 0)]
            ok &= (where >= other[node]) & (where < end[node])
            starts.append(np.minimum(i, j)[ok])
            periods.append(depth[node][ok])
        done = to
    return (np.concatenate(starts), np.concatenate(periods)) if starts else (np.zeros(0, np.int64),) * 2


def runs_of(seq: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of the sequence, by start, then period."""
    ranks = suffix_ranks(seq)
    at, period = branching_squares(ranks)
    start = at - common_suffix(ranks, at, at + period)
    length = at + 2 * period - start
    long = length >= np.maximum(min_length, 2 * period)
    start, length, period = start[long], length[long], period[long]
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    first = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])][: len(start)]
    start, length, period = start[first], length[first], period[first]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def may_repeat(seq: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Which documents hold a window of 4 values twice."""
    out = np.zeros(n_docs, bool)
    if len(seq) < 5:
        return out
    h = doc[:-3].astype(np.uint64)
    for i in range(4):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) + seq[i : len(seq) - 3 + i].astype(np.uint64)
    at = np.flatnonzero(doc[:-3] == doc[3:])
    by = at[np.argsort(h[at], kind="stable")]
    again = h[by[1:]] == h[by[:-1]]          # equal hashes of different windows only keep a document in
    out[doc[by[1:][again]]] = True
    return out


def runs_in(words: list[list[bytes]], min_length: int = 12) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each document's words."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in words]
    number = {w: i for i, w in enumerate(dict.fromkeys(w for ws in words for w in ws))}
    size = np.fromiter(map(len, words), np.int64, len(words))
    seq = np.fromiter((number[w] for ws in words for w in ws), np.int64, int(size.sum()))
    doc = np.repeat(np.arange(len(words)), size)
    keep = may_repeat(seq, doc, len(words)) if min_length >= 12 else size > 0
    if not keep.any():
        return found
    some = np.flatnonzero(keep)
    parts, off, begin = [], np.r_[0, np.cumsum(size)], []
    at = 0
    for k, d in enumerate(some.tolist()):
        # equal words of different documents get different values, and each end a value of its own
        parts += [seq[off[d] : off[d + 1]] + (k * (len(number) + 1)), np.array([k * (len(number) + 1) + len(number)])]
        begin.append(at)
        at += int(size[d]) + 1
    start, length, period = runs_of(np.concatenate(parts), min_length)
    of = np.searchsorted(begin, start, side="right") - 1
    for k, s, n, q in zip(of.tolist(), start.tolist(), length.tolist(), period.tolist()):
        found[some[k]].append((s - begin[k], n, q))
    return found


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        edge[s + q] += 1
        edge[s + n] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def find_runs(docs: DataFrame, id_col="doc_id", text_col="text", min_length: int = 12) -> DataFrame:
    """One row a document: doc_id, n_words, runs by start, then period (start from 0, length, period), and the
    collapsed text, whose runs keep their first period only."""
    prepare(docs.sparkSession)

    def pieces(texts):
        lo, held = 0, 0
        for k, t in enumerate(texts):
            if held and held + len(t) > PIECE:
                yield lo, k
                lo, held = k, 0
            held += len(t)
        yield lo, len(texts)

    def run(batches):
        for b in batches:
            texts = text_bytes(b.column(1))
            for lo, hi in pieces(texts):
                words = [t.split() for t in texts[lo:hi]]
                found = runs_in(words, min_length)
                flat = [r for rs in found for r in rs]
                inner = pa.StructArray.from_arrays([pa.array([r[i] for r in flat], pa.int64()) for i in range(3)], ["start", "length", "period"])
                offsets = pa.array(np.r_[0, np.cumsum([len(rs) for rs in found])].astype(np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo), pa.array([len(w) for w in words], pa.int64()), pa.ListArray.from_arrays(offsets, inner),
                    pa.array([collapse(w, r) for w, r in zip(words, found)], pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)
