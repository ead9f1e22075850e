"""SimHash near-dedup by bit-sliced comparison.

Fingerprints are made per text in Arrow batches. Distinct fingerprints are dealt
out by the value of one of radius+1 blocks of bits (two that differ in at most
``radius`` bits agree on a whole block); buckets above ``tile`` members are cut
into pairs of parts. In a bucket the bits stand vertically: one word of a bit
plane holds the same bit of 64 fingerprints, carry-save adders count the
differing bits of 64 pairs at once, and a word is abandoned once all of its
pairs exceed the radius. A bucket returns a spanning forest of its links, never
all pairs; components join the forests.

Defined results: a null text counts as empty; a text without words has
fingerprint zero and is linked like any other; equal rows share a component; rows
with a null doc_id are linked too but give no component_id (null when a component has no other);
an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import components, digest_key, pack, prepare, text_bytes, union_min, unpack, words_of, written

PART = 1 << 16   # shingles or words of bit planes handled at once


def fingerprint(text: str | bytes | None, shingle: int = 4) -> int:
    """64-bit SimHash over the XXH64 (seed 42) of all word shingles, repeats included."""
    words = words_of(text)
    n = len(words)
    if n == 0:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if n < shingle:
        return digest(joined, 42)
    size = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(size + 1) - 1
    starts, ends = (ends - size)[: n - shingle + 1], ends[shingle - 1 :]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), PART):
        h = [digest(joined[s:e], 42) for s, e in zip(starts[i : i + PART].tolist(), ends[i : i + PART].tolist())]
        ones += np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = 4) -> DataFrame:
    """Rows (doc_id, text_key, fp): fp as a signed long with the fingerprint's bits."""
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in text_bytes(b.column(2))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), digest_key(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def _beyond(counter: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose vertical counter is greater than radius."""
    gt, eq = over.copy(), ~over
    for k in range(len(counter) - 1, -1, -1):
        if radius >> k & 1:
            eq &= counter[k]
        else:
            gt |= eq & counter[k]
            eq &= ~counter[k]
    return gt


def bucket_forest(fp: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (member, root) of a forest that links all fp of equal group (sorted)
    that differ in at most radius bits. Work is in words of 64 lanes."""
    n = len(fp)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, n])
    n_words = (size + 63) // 64
    word0 = np.r_[0, np.cumsum(n_words)[:-1]]
    of = np.repeat(np.arange(len(first)), size)
    inside = np.arange(n) - first[of]
    slot = (word0[of] * 64 + inside)
    total = int(n_words.sum())
    row_of = np.full(total * 64, -1, np.int64)
    row_of[slot] = np.arange(n)
    planes = np.zeros((64, total), np.uint64)
    spread = np.zeros(total * 64, np.uint64)
    spread[slot] = fp
    for b in range(64):
        planes[b] = np.packbits((spread >> np.uint64(b) & np.uint64(1)).astype(np.uint8), bitorder="little").view("<u8")
    valid = np.packbits(row_of >= 0, bitorder="little").view("<u8")

    # every row meets the words of its bucket from its own word on
    my_word = word0[of] + inside // 64
    reach = word0[of] + n_words[of] - my_word
    stop = np.cumsum(reach)
    label, width = np.arange(n), max(1, radius.bit_length())
    lone = size[of] < 2
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(stop, (stop[at - 1] if at else 0) + PART)))
        rows = np.flatnonzero(~lone[at:to]) + at
        at = to
        if not len(rows):
            continue
        q = np.repeat(rows, reach[rows])
        w = np.arange(len(q)) - np.repeat(np.cumsum(reach[rows]) - reach[rows], reach[rows]) + my_word[q]
        counter, over = [np.zeros(len(q), np.uint64) for _ in range(width)], np.zeros(len(q), np.uint64)
        mine, dead = fp[q], None
        for b in range(0, 64, 2):
            flip = [(np.uint64(0) - (mine >> np.uint64(k) & np.uint64(1))) for k in (b, b + 1)]
            x, y = planes[b][w] ^ flip[0], planes[b + 1][w] ^ flip[1]
            half = x ^ y                                     # carry-save adder: two planes and the lowest counter bit
            carry = (x & y) | (half & counter[0])
            counter[0] ^= half
            for k in range(1, width):
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
            over |= carry
            if b % 8 == 6 and b > 8:
                dead = _beyond(counter, over, radius)
                live = (~dead & valid[w]) != 0
                if not live.all():                           # abandon words in which every pair is too far
                    q, w, mine, over, dead = q[live], w[live], mine[live], over[live], dead[live]
                    counter = [c[live] for c in counter]
        if not len(q):
            continue
        hit = ~_beyond(counter, over, radius) & valid[w]
        i, lane = np.nonzero(np.unpackbits(hit.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        a, b = q[i], row_of[w[i] * 64 + lane]
        far = a != b
        union_min(label, a[far], b[far])
    child = np.flatnonzero(label != np.arange(n))
    return child, label[child]


def _links(radius: int):
    def run(batches):
        import pandas as pd

        rest = None
        def forest(t):
            if not len(t):
                return None
            key = t.groupby(["block", "value", "a", "c"], sort=False).ngroup().to_numpy()
            fp = t["fp"].to_numpy()
            child, root = bucket_forest(fp.view(np.uint64), key, radius)
            return pd.DataFrame({"u": fp[child], "v": fp[root]})

        for t in batches:
            t = t if rest is None else pd.concat([rest, t], ignore_index=True)
            last = t.iloc[-1] if len(t) else None
            if last is None:
                continue
            tail = ((t["block"] == last["block"]) & (t["value"] == last["value"]) & (t["a"] == last["a"]) & (t["c"] == last["c"])).to_numpy()
            rest, done = t[tail], t[~tail]
            if (out := forest(done)) is not None:
                yield out
        if rest is not None and (out := forest(rest)) is not None:
            yield out
    return run


def similar_links(fps: DataFrame, radius: int = 4, tile: int = 4096) -> DataFrame:
    """Links (u, v) that join all distinct fingerprints (column fp) within radius.

    The key is made of the bits of ``m`` of ``radius + m`` blocks: two fingerprints
    within the radius agree on at least m blocks. m rises with the number of
    fingerprints so that a bucket of evenly spread ones stays below the tile size;
    every m finds every link."""
    from itertools import combinations

    n = fps.count()
    m = 1
    while n > tile << (64 * m // (radius + m)) and m < 4:
        m += 1
    blocks = radius + m
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in c) for c in combinations(range(blocks), m)]
    masks = [x - (1 << 64) if x >= 1 << 63 else x for x in masks]
    keyed = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(x).cast("long")).alias("value")) for i, x in enumerate(masks)])).alias("k")).select("fp", "k.*")
    load = keyed.groupBy("block", "value").agg(F.count("*").alias("load")).filter("load > 1")
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    dealt = keyed.join(load, ["block", "value"]).withColumn("parts", F.ceil(F.col("load") / F.lit(tile))).withColumn("part", part)
    others = F.when(F.col("parts") == 1, F.array(F.col("part"))).otherwise(
        F.filter(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda x: x != F.col("part")))
    tiles = dealt.select("fp", "block", "value", "part", F.explode(others).alias("other")).select(
        "fp", "block", "value", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("c"))
    key = ["block", "value", "a", "c"]
    return tiles.repartition(*key).sortWithinPartitions(*key).mapInPandas(_links(radius), "u long, v long")


def near_dedup(docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """Rows (doc_id, text_key, fp, root, component_id), one for each row of docs."""
    spark = docs.sparkSession
    prepare(spark)
    prints = written(fingerprints(docs, id_col, text_col, shingle), "fp")
    each = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fps")
    comp = components(similar_links(each.select("fp"), radius))
    rooted = each.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    member = rooted.select("fp", "root").join(ids, "root")
    return prints.join(member, "fp")


def drop_near_copies(docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id (nulls last);
    of rows equal in doc_id and text one stays."""
    found = near_dedup(docs, id_col, text_col, shingle, radius)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("text_key"))
    least = F.lit(-(1 << 63)).cast("long")          # stands for a null id; such rows still differ by their text
    keep = found.groupBy("root").agg(F.min(order).alias("o")).select(
        F.coalesce("o.doc_id", least).alias("_id"), F.col("o.text_key").alias("_key"))
    rows = pack(docs, _id=F.coalesce(F.col(id_col).cast("long"), least), _key=digest_key(text_col))
    nth = F.row_number().over(Window.partitionBy("_id", "_key").orderBy(F.lit(0)))
    return unpack(rows.join(keep, ["_id", "_key"]).withColumn("_nth", nth).filter("_nth = 1"), docs.columns)
