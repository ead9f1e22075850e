"""Benchmark decontamination by SimHash of item-sized windows.

Every window of a document that is as long as a benchmark item (in words) and
shares a shingle with an item of that length is fingerprinted: weighted SimHash of
its 5-word shingles. (A window that shares no shingle has similarity zero.) A
multi-index over the 8 bytes of the items' fingerprints gives the candidates: two
fingerprints within ``radius`` bits differ by at most radius // 8 bits in one of
the bytes, and every byte value within that distance is listed. Candidates within
the radius are verified on the words themselves: weighted Jaccard similarity of the
shingles (weight: how often a shingle occurs), ``threshold`` or more.

For windows at similarity 0.8 the expected distance is 10 of 64 bits with a
deviation of 3, so the default radius of 26 loses none in practice.

The benchmark goes to every task in slices of at most ``slice_items`` items; a larger benchmark
takes several passes over the documents.

Defined results: words are [^\\x20\\x09-\\x0D]+, A-Z lower-cased; null texts and
items are empty and match nothing; items of fewer than five words count as one
shingle; a document shorter than an item is one window; equal rows are all
reported; empty tables give an empty result; further columns are ignored or passed.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import textvec as V
from folio.llm.common import prepare, text_bytes, words_of

SHINGLE = 5
FIELDS = "doc_id long, item_id long, start long, n_words long, distance int, similarity double"


def _shingles(words: list[bytes]) -> Counter:
    if not words:
        return Counter()
    k = min(SHINGLE, len(words))
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def _similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def _windows(grams: np.ndarray, width: int) -> np.ndarray:
    """SimHash of every run of ``width`` shingle hashes."""
    bits = np.unpackbits(grams.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32)
    total = np.vstack([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
    ones = total[width:] - total[:-width]
    return np.packbits(2 * ones > width, axis=1, bitorder="little").view("<u8").ravel()


class Items:
    """Bounded index over benchmark items: shingles by width, and the multi-index."""

    def __init__(self, items: list[tuple[int, str]], radius: int, threshold: float):
        self.radius, self.threshold = radius, threshold
        known = [(i, words_of(t)) for i, t in items]
        known = [(i, w) for i, w in known if w]
        self.ids = [i for i, _ in known]
        self.grams = [_shingles(w) for _, w in known]
        self.size = np.array([len(w) for _, w in known], np.int64)
        prints, owners = [], {}
        for n, (_, w) in enumerate(known):
            h = self.hashes(w)
            k = min(SHINGLE, len(w))
            g = V.gram_hashes(h, k)
            prints.append(_windows(g, len(g))[0])
            for x in set(g.tolist()):
                owners.setdefault(k, {}).setdefault(x, set()).add(len(w))
        self.prints = np.array(prints, np.uint64)
        self.lookup = {}
        for k, of in owners.items():
            keys = np.array(sorted(of), np.uint64)
            quick = np.zeros(1 << 18, bool)
            quick[(keys & np.uint64((1 << 18) - 1)).astype(np.int64)] = True
            self.lookup[k] = (keys, quick, [sorted(of[x]) for x in keys.tolist()])
        near = [[y for y in range(256) if (x ^ y).bit_count() <= radius // 8] for x in range(256)]
        self.by_byte = [[[] for _ in range(256)] for _ in range(8)]
        for n, fp in enumerate(prints):
            for b in range(8):
                for y in near[int(fp) >> 8 * b & 255]:
                    self.by_byte[b][y].append(n)
        self.by_byte = [[np.array(x, np.int64) for x in row] for row in self.by_byte]

    @staticmethod
    def hashes(words: list[bytes]) -> np.ndarray:
        buf, off = V.flat(words)
        return V.span_hashes(buf, off[:-1], off[1:])

    def anchors(self, hashes: np.ndarray, doc: np.ndarray):
        """Texts that share a shingle with an item: {text: {shingle width: [(word position, lengths)]}}."""
        out: dict[int, dict[int, list]] = {}
        if not len(hashes):
            return out
        first = np.searchsorted(doc, np.arange(int(doc[-1]) + 1))
        for k, (keys, quick, sizes) in self.lookup.items():
            g = V.gram_hashes(hashes, k)
            at = np.flatnonzero(quick[(g & np.uint64((1 << 18) - 1)).astype(np.int64)])
            at = at[doc[at] == doc[at + k - 1]]
            pos = np.minimum(np.searchsorted(keys, g[at]), len(keys) - 1)
            hit = keys[pos] == g[at]
            for a, p in zip(at[hit].tolist(), pos[hit].tolist()):
                d = int(doc[a])
                out.setdefault(d, {}).setdefault(k, []).append((a - int(first[d]), sizes[p]))
        return out

    def matches(self, words: list[bytes], hashes: np.ndarray, anchors: dict) -> list[tuple]:
        """Best window for every item found in the text: (item, start, n_words, distance, similarity)."""
        n, best = len(words), {}
        starts: dict[int, set[int]] = {}
        for k, found in anchors.items():
            for p, lengths in found:
                for size in lengths:
                    if n < size:
                        starts.setdefault(size, set()).add(0)
                    else:
                        starts.setdefault(size, set()).update(range(max(0, p + k - size), min(p, n - size) + 1))
        for size, at in starts.items():
            span = min(size, n)
            k = min(SHINGLE, span)
            at = np.array(sorted(at), np.int64)
            for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
                lo, hi = int(run[0]), int(run[-1]) + span
                grams = V.gram_hashes(hashes[lo:hi], k)
                for start, fp in zip(run.tolist(), _windows(grams, span - k + 1).tolist()):
                    near = np.concatenate([self.by_byte[b][fp >> 8 * b & 255] for b in range(8)])
                    near = near[self.size[near] == size]
                    if not len(near):
                        continue
                    own = None
                    for item in np.unique(near).tolist():
                        away = (int(self.prints[item]) ^ fp).bit_count()
                        if away > self.radius:
                            continue
                        own = own or _shingles(words[start : start + span])
                        sim = _similarity(own, self.grams[item])
                        if sim >= self.threshold and (item not in best or sim > best[item][4]):
                            best[item] = (self.ids[item], start, span, away, sim)
        return [best[x] for x in sorted(best)]

    def search(self, texts: list[bytes]) -> list[list[tuple]]:
        out: list[list[tuple]] = [[] for _ in texts]
        if not self.ids:
            return out
        buf, off = V.flat(texts)
        buf = V.lower(buf)
        s, e, doc = V.word_spans(buf, off)
        hashes = V.span_hashes(buf, s, e)
        first = np.searchsorted(doc, np.arange(len(texts) + 1))
        for d, found in self.anchors(hashes, doc).items():
            out[d] = self.matches(words_of(texts[d]), hashes[first[d] : first[d + 1]], found)
        return out


def _slices(items: DataFrame, id_col: str, text_col: str, slice_items: int) -> list[list[tuple[int, str]]]:
    n = items.count()
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    parts = max(1, -(-2 * n // slice_items)) if n > slice_items else 1
    if parts == 1:
        yield [(r.i, r.t) for r in rows.collect()]
        return
    for p in range(parts):
        yield [(r.i, r.t) for r in rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == p).collect()]


def find_leaks(docs: DataFrame, items: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text",
               threshold: float = 0.8, radius: int = 26, slice_items: int = 20_000) -> DataFrame:
    """One row for every document and benchmark item that it holds: the best window."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for part in _slices(items, item_col, item_text_col, slice_items):
        index = spark.sparkContext.broadcast(Items(part, radius, threshold))

        def run(batches, index=index):
            for b in batches:
                got = index.value.search(text_bytes(b.column(1)))
                ids = b.column(0).to_pylist()
                flat = [(ids[d], *m) for d, ms in enumerate(got) for m in ms]
                cols = list(zip(*flat)) if flat else [[]] * 6
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [x.split()[0] for x in FIELDS.split(", ")])

        out = rows.mapInArrow(run, FIELDS)
        found = out if found is None else found.unionByName(out)
    return found


def drop_leaks(docs: DataFrame, items: DataFrame, text_col="text", item_col="item_id", item_text_col="text",
               threshold: float = 0.8, radius: int = 26, slice_items: int = 20_000) -> DataFrame:
    """docs without the rows that hold a benchmark item; rows pass in place, nothing is shuffled."""
    spark = docs.sparkSession
    prepare(spark)
    at = docs.columns.index(text_col)
    for part in _slices(items, item_col, item_text_col, slice_items):
        index = spark.sparkContext.broadcast(Items(part, radius, threshold))

        def run(batches, index=index):
            for b in batches:
                yield V.pass_rows(b, np.array([not m for m in index.value.search(text_bytes(b.column(at)))], bool))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
