"""Removal of repeated byte strings by a distributed difference-cover algorithm.

A byte goes if a string of ``length`` bytes covers it that also starts earlier
(smaller doc_id, or further up in the same document). As in difference-cover suffix
sorting only a sample of the suffixes is sorted, by names, and the others follow
from the next sample:

1. Cover. Positions are sampled so that two equal strings hold a sample at the same
   distance. Each sample answers for a run of window starts before it.
2. Names. A sample is named by the bytes that all its windows share (its core), and
   by all bytes its windows touch (its full context). A core that occurs once can't
   be part of a repeat; its windows are done.
3. Recursion. Where equal cores have different contexts, the run of windows is cut into
   four and named again, with longer cores and shorter contexts, down to the single
   string.
4. Merge and comparison. In every class of equal names the first member (doc_id, digest of
   the text, position) stays; the windows of all others are repeats, and their bytes go.

``cover="content"`` (default) samples the least hash of every window, 2.9 % of all
positions. ``cover="modular"`` is the textbook difference cover modulo 73 (9 residues,
12.3 %); it gives the same result with over four times the rows. Names are 64-bit
hashes of the bytes, always compared in pairs (core and context).

The first shuffle carries one row of three longs a sample, pre-aggregated by core;
a bitmap of fixed size then tells the second reading which cores occur again. A core
that half of the documents share is one row after pre-aggregation, and joins back as
a skewed key of plain rows; no group is ever gathered.

Defined results: null text is empty; texts below ``length`` lose nothing; null ids come
last; rows equal in id and text are one document (each keeps what the first keeps);
rows of equal (or null) id and different text are ordered by a 64-bit digest of the text; an empty table stays empty; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import textvec as V
from folio.llm.common import digest_key, prepare, text_bytes, written

LAST = (1 << 63) - 1
PIECE = 1 << 18
BITS = 27                                     # bitmap of 16 MB, whatever the input
# A perfect difference set modulo 73.
MODULUS, RESIDUES = 73, (0, 1, 3, 7, 15, 31, 36, 54, 63)


def reach(length: int, cover: str) -> int:
    """Window starts that a sample can answer for."""
    return MODULUS if cover == "modular" else length - 31


def samples(text: bytes, length: int = 100, cover: str = "content"):
    """Samples of a text: position p, first and last window start lo and hi, core and context names."""
    n = len(text)
    parts = []
    for at in range(0, n - length + 1, PIECE):
        parts.append(_piece(np.frombuffer(text[at : at + PIECE + length - 1], np.uint8), length, cover, at))
    if not parts:
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(np.uint64), z.view(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _piece(b: np.ndarray, length: int, cover: str, base: int):
    n, r = len(b), reach(length, cover)
    k = length - r + 1                        # bytes of a core
    up, down = V.powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    name = lambda s, e: (total[e] - total[s]) * down[s]
    windows = n - length + 1
    if cover == "modular":
        s = np.arange(n - k + 1)
        p = s[np.isin((s + base) % MODULUS, RESIDUES)]
        lo, hi = np.maximum(p - (r - 1), 0), np.minimum(p, windows - 1)
        p, lo, hi = p[lo <= hi], lo[lo <= hi], hi[lo <= hi]
    else:
        g = V.mix64((total[k:] - total[:-k]) * down[: n - k + 1])
        bits = np.uint64(20)
        m = (g >> bits << bits) | np.arange(len(g), dtype=np.uint64)          # ties: the leftmost
        width = 1
        while 2 * width <= r:
            m = np.minimum(m[:-width], m[width:])
            width *= 2
        m = np.minimum(m[: windows], m[r - width : r - width + windows])
        a = (m & np.uint64((1 << 20) - 1)).astype(np.int64)                  # sample of every window
        edge = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        p, lo, hi = a[edge], edge, np.r_[edge[1:], windows] - 1
    core = V.mix64(name(p, p + k))
    shape = ((p - lo) * 1024 + (p - hi)).astype(np.uint64)
    full = V.mix64(V.mix64(name(lo, hi + length) ^ np.uint64(0xA0761D6478BD642F)) + shape)
    return p + base, lo + base, hi + base, core, full


def _fresh(core: np.ndarray, full: np.ndarray) -> np.ndarray:
    """True at the first of equal (core, full) of one text."""
    first = np.zeros(len(core), bool)
    if len(core):
        order = np.lexsort((np.arange(len(core)), full, core))
        c, f = core[order], full[order]
        first[order[np.r_[True, (c[1:] != c[:-1]) | (f[1:] != f[:-1])]]] = True
    return first


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """Bits (hash modulo 2^BITS) of all values of a long column; at most 2^(BITS-15) rows reach the driver."""
    slot = F.pmod(F.col(column), F.lit(1 << BITS)) + 1
    rows = keys.select(F.bitmap_bucket_number(slot).alias("b"), F.bitmap_bit_position(slot).alias("p")).groupBy("b").agg(F.bitmap_construct_agg("p").alias("m"))
    out = np.zeros(1 << BITS - 3, np.uint8)
    for r in rows.toLocalIterator():
        out[(r.b - 1) * 4096 : r.b * 4096] = np.frombuffer(bytes(r.m), np.uint8)
    return out


def _held(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    slot = (names & np.uint64((1 << BITS) - 1)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def _first_names(length: int, cover: str, shared):
    def run(batches):
        for b in batches:
            ids, cores, fulls = b.column(0).to_numpy(), [], []
            size = np.zeros(len(ids), np.int64)
            for i, t in enumerate(text_bytes(b.column(1))):
                _, _, _, core, full = samples(t, length, cover)
                new = _fresh(core, full)
                cores.append(core[new])
                fulls.append(full[new])
                size[i] = new.sum()
            c, f = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (cores, fulls))
            yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)), pa.array(f.view(np.int64)), pa.array(np.repeat(ids, size)),
                                             pa.array(np.repeat(_held(shared.value, ids.astype(np.int64).view(np.uint64)), size))], ["core", "full", "doc_id", "tie"])
    return run


def _members(length: int, cover: str, again, mixed):
    """Samples whose core may occur again; with their bytes if contexts may differ."""
    names = ["core", "full", "doc_id", "key", "p", "lo", "hi", "bytes"]

    def run(batches):
        for b in batches:
            ids, keys, out, raw = b.column(0).to_numpy(), b.column(1).to_numpy(), [], []
            for i, t in enumerate(text_bytes(b.column(2))):
                p, lo, hi, core, full = samples(t, length, cover)
                take = _fresh(core, full) & _held(again.value, core)
                if not take.any():
                    continue
                p, lo, hi, core, full = p[take], lo[take], hi[take], core[take], full[take]
                n = len(p)
                out.append((core.view(np.int64), full.view(np.int64), np.full(n, ids[i]), np.full(n, keys[i]), p, lo, hi))
                raw += [t[x : y + length] if m else None for x, y, m in zip(lo.tolist(), hi.tolist(), _held(mixed.value, core).tolist())]
            cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 7
            yield pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int64)) for c in cols], pa.array(raw, pa.binary())], names)
    return run


MEMBER = "core long, full long, doc_id long, key long, p long, lo long, hi long, bytes binary"


def _split(length: int, first: int, parts: int = 4):
    """Cut the runs of windows (distances a..b from the sample) into parts and name these again."""
    names = ["core", "full", "doc_id", "key", "p", "lo", "hi", "a", "b", "bytes"]
    digest = xxhash.xxh3_64_intdigest

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                a, b, p, raw = r["a"], r["b"], r["p"], r["bytes"]
                step = -(-(b - a + 1) // parts)
                for x in range(a, b + 1, step):
                    y = min(x + step - 1, b)
                    lo, hi = max(r["lo"], p - y), min(r["hi"], p - x)
                    if lo > hi:
                        continue
                    off = r["lo"]                                      # raw begins at the row's lo
                    core = raw[p - x - off : p - y + length - off]
                    part = raw[lo - off : hi + length - off]
                    seed = x * 256 + y
                    out.append((digest(core, seed), digest(part, (p - lo) * 1024 + (p - hi) + 7), r["doc_id"], r["key"], p, lo, hi, x, y, part))
            cols = list(zip(*out)) if out else [[]] * 10
            signed = [np.array(c, np.uint64).view(np.int64) for c in cols[:2]]
            yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in signed], *[pa.array(list(c), pa.int64()) for c in cols[2:9]], pa.array(list(cols[9]), pa.binary())], names)
    return run


def repeated_windows(docs: DataFrame, length: int = 100, cover: str = "content") -> DataFrame:
    """Rows (doc_id, key, lo, hi): windows starting at lo..hi repeat an earlier one.
    docs: doc_id long (not null), key long, text. Repeats inside of one text whose sample
    has the same context are left to the reader of the text."""
    spark, r = docs.sparkSession, reach(length, cover)
    # ids of several texts: there the order within the id decides, so their cores are compared member by member
    ids = docs.groupBy("doc_id").agg(F.min("key").alias("k0"), F.max("key").alias("k1")).filter("k0 <> k1")
    shared = spark.sparkContext.broadcast(bitmap(ids, "doc_id"))
    names = docs.select("doc_id", "text").mapInArrow(_first_names(length, cover, shared), "core long, full long, doc_id long, tie boolean")
    cores = names.groupBy("core").agg(F.count("*").alias("n"), F.min("full").alias("f0"), F.max("full").alias("f1"), F.min("doc_id").alias("d0"), F.max("tie").alias("tie"))
    cores = written(cores.filter("n > 1").select("core", ((F.col("f0") != F.col("f1")) | F.col("tie")).alias("mixed"), "d0"), "cores")
    again = spark.sparkContext.broadcast(bitmap(cores, "core"))
    mixed = spark.sparkContext.broadcast(bitmap(cores.filter("mixed"), "core"))
    rows = docs.select("doc_id", "key", "text").mapInArrow(_members(length, cover, again, mixed), MEMBER).join(cores, "core")
    rows = written(rows.filter("mixed or doc_id <> d0"), "members")
    found = [rows.filter("not mixed").select("doc_id", "key", "lo", "hi")]
    level = rows.filter("mixed").select(*MEMBER.replace(" long", "").replace(" binary", "").split(", ")).withColumns({"a": F.lit(0).cast("long"), "b": F.lit(r - 1).cast("long")})
    size = r
    while True:
        place = F.struct("doc_id", "key", "p")
        classes = level.groupBy("core", "full").agg(F.count("*").alias("n"), F.min(place).alias("first"))
        several = classes.groupBy("core").agg(F.sum("n").alias("core_n"), F.count("*").alias("contexts")).filter("core_n > 1")
        classes = classes.join(several, "core").select("core", "full", "first", "contexts")
        # the rows with their bytes move once; those that are decided leave their bytes behind
        ruled = level.join(classes, ["core", "full"]).withColumn("later", place > F.col("first")).filter("later or contexts > 1")
        ruled = written(ruled.withColumn("bytes", F.when(~F.col("later"), F.col("bytes"))).drop("core", "full", "first", "contexts"), f"level{size}")
        found.append(ruled.filter("later").select("doc_id", "key", "lo", "hi"))
        if size == 1:
            break
        rest = ruled.filter("not later").select("doc_id", "key", "p", "lo", "hi", "a", "b", "bytes")
        level = rest.mapInArrow(_split(length, r), "core long, full long, doc_id long, key long, p long, lo long, hi long, a long, b long, bytes binary")
        level = written(level, f"split{size}")
        size = -(-size // 4)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def dedup_suffixes(docs: DataFrame, id_col="doc_id", text_col="text", length: int = 100, cover: str = "content") -> DataFrame:
    """One row a document: doc_id, n_bytes, spans (array of removed [start, stop)) and kept (binary)."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc_id"),
                       digest_key(text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    ranges = repeated_windows(rows, length, cover).groupBy("doc_id", "key").agg(F.collect_set(F.struct("lo", "hi")).alias("r"))
    ranges = ranges.select("doc_id", "key", F.col("r.lo").alias("los"), F.col("r.hi").alias("his"))

    def run(batches):
        for b in batches:
            spans, kept, sizes = [], [], []
            for i, t in enumerate(text_bytes(b.column(1))):
                p, lo, hi, core, full = samples(t, length, cover)
                twice = ~_fresh(core, full)
                los, his = b.column(2)[i].values, b.column(3)[i].values
                los = np.r_[lo[twice], los.to_numpy()] if los is not None else lo[twice]
                his = np.r_[hi[twice], his.to_numpy()] if his is not None else hi[twice]
                step = np.zeros(len(t) + 1, np.int32)
                np.add.at(step, los, 1)
                np.add.at(step, his + length, -1)
                gone = np.cumsum(step[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                spans.append([{"start": x, "stop": y} for x, y in zip(edge[::2].tolist(), edge[1::2].tolist())])
                kept.append(np.frombuffer(t, np.uint8)[~gone].tobytes() if len(edge) else t)
                sizes.append(len(t))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.binary())],
                                             ["doc_id", "n_bytes", "spans", "kept"])

    return rows.join(ranges, ["doc_id", "key"], "left").select("id", "text", "los", "his").mapInArrow(
        run, "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")
