"""Language-model scoring with a hashed maximum-entropy model.

P(word | history) = P(class | history) * P(word | class). The class softmax is a
maximum-entropy model over hashed features of the history: the previous word,
the one before it (a skip feature), and both (an n-gram feature). Each broadcast word
(see below) is a context of its own, the most frequent ones are classes of their own, all others fall into hashed
ones by their ending; the end of a text is a word. Inside a class words have their
smoothed share of the class (one unseen word per class).

Training covers all training texts. They are counted into (history, class) cells, a table
that grows with the pairs of words seen, and every update is a Spark job over the
cells: tasks add up the gradient rows of the features that they touch, the rows of a feature meet in one task, and the
weights move by it (scaled by feature mass); the driver holds the weights alone. Word counts are a table that grows with
the corpus; it is never collected: rare words of a text meet it in a join, and only
words with a share of 1 / ``frequent`` or more (so at most that many) are broadcast.

Scoring works in numpy batches on sparse rows: class terms are worked out once for every
history of a batch, word terms come from the counts.

Defined results: null text is empty (one token, the end); the training rows are
those whose crc32(doc_id as text) mod 10 is not 0 (null id: empty text, held out);
rows of equal id and text get equal scores; an empty table stays empty; with no training rows all counts are 0;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import textvec as V
from folio.llm.common import digest_key, prepare, text_bytes, written
from folio.session import shuffles_dropped

CLASSES, CONTEXTS, FEATURES = 256, 1 << 17, 1 << 14
TOP_CLASSES, TOP_CONTEXTS = 128, 1 << 16     # ids of their own; 0 is the end (before a text: the start)
ALPHA = 0.1
BLOCK = 256                                  # histories whose class rows are held at once, within a core's cache
GATHER, TASK_CELLS = 8, 1 << 19              # tasks that add up the gradient rows; histories a task of a round has at most


def tokens(texts: list[bytes]):
    """Lower-cased bytes, and start, end, text and hash of every word."""
    buf, off = V.flat(texts)
    low = V.lower(buf)
    s, e, doc = V.word_spans(low, off)
    return low, s, e, doc, V.span_hashes(low, s, e)


class Vocabulary:
    """Bounded part of the word table: frequent words, their counts, classes and context ids."""

    def __init__(self, words: list[tuple[bytes, int]]):
        words = sorted(words, key=lambda x: (-x[1], x[0]))
        buf, off = V.flat([w for w, _ in words])
        h = V.span_hashes(buf, off[:-1], off[1:])
        order = np.argsort(h)
        self.hash, rank = h[order], order
        self.count = np.array([c for _, c in words], np.int64)[order]
        self.rank = rank

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash in the table, and whether it is there."""
        if not len(self.hash):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return at, self.hash[at] == h

    def ids(self, low, s, e, h) -> tuple[np.ndarray, np.ndarray]:
        """Class and context id of every word."""
        at, known = self.find(h)
        rank = np.where(known, self.rank[at] if len(self.rank) else 0, 1 << 40)
        if len(s):
            end = low[e - 1].astype(np.uint64) * np.uint64(256) + low[np.maximum(e - 2, s)]
        else:
            end = np.zeros(0, np.uint64)
        tail = V.mix64(end + np.uint64(1)).astype(np.uint64)
        rest = lambda top, n: (top + tail % np.uint64(n - top)).astype(np.int64)
        cls = np.where(rank < TOP_CLASSES - 1, rank + 1, rest(TOP_CLASSES, CLASSES))
        ctx = np.where(rank < TOP_CONTEXTS - 1, rank + 1, rest(TOP_CONTEXTS, CONTEXTS))
        return cls, ctx


def histories(texts: list[bytes], vocab: Vocabulary):
    """For every token (words, and the end of each text): history id and class; plus the words."""
    n = len(texts)
    low, s, e, doc, h = tokens(texts)
    cls, ctx = vocab.ids(low, s, e, h)
    place = np.arange(len(s)) + doc                     # every text has one more token: its end
    total = len(s) + n
    c, x, of = np.zeros(total, np.int64), np.zeros(total, np.int64), np.zeros(total, np.int64)
    c[place], x[place] = cls, ctx
    first = np.searchsorted(doc, np.arange(n + 1)) + np.arange(n + 1)
    of = np.repeat(np.arange(n), np.diff(first))
    one, two = np.zeros(total, np.int64), np.zeros(total, np.int64)
    nth = np.arange(total) - first[of]
    one[1:], two[2:] = x[:-1], x[:-2]
    one[nth < 1] = 0
    two[nth < 2] = 0
    return one * CONTEXTS + two, c, of, (low, s, e, doc, h)


def features(history: np.ndarray) -> np.ndarray:
    """Hashed features of history ids: previous id, the one before (skip), both (n-gram)."""
    one, two = history // CONTEXTS, history % CONTEXTS
    keys = np.stack([one, two + (1 << 20), history + (1 << 40)]).astype(np.uint64)
    return (V.mix64(keys * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(FEATURES)).astype(np.int64)


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def class_rows(f: np.ndarray, weights: np.ndarray, bias: np.ndarray, out: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Unnormalised class rows less their greatest member, for features (3, m) of at most BLOCK histories."""
    z, x = out[: f.shape[1]], room[: f.shape[1]]
    np.take(weights, f[0], axis=0, out=z, mode="clip")
    for ids in f[1:]:
        z += np.take(weights, ids, axis=0, out=x, mode="clip")
    z += bias
    z -= z.max(axis=1, keepdims=True)
    return z


def class_terms(h: np.ndarray, c: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """log10 P(class | history) of every token; a history of the batch is worked out once."""
    out = np.zeros(len(h))
    order = np.argsort(h, kind="stable")
    hs, first, at = np.unique(h[order], return_index=True, return_inverse=True)
    first, f = np.r_[first, len(h)], features(hs)
    room = np.empty((2, BLOCK, CLASSES), np.float32)
    for lo in range(0, len(hs), BLOCK):
        z = class_rows(f[:, lo : lo + BLOCK], weights, bias, *room)
        mine = slice(first[lo], first[lo + len(z)])
        got = z[at[mine] - lo, c[order[mine]]]
        norm = np.log(np.exp(z, out=z).sum(axis=1, dtype=np.float64))
        out[order[mine]] = got - norm[at[mine] - lo]
    return out / np.log(10)


def _rows(rows: DataFrame, fn, schema: str, names: list[str]):
    """mapInArrow where fn gives the arrays of the output columns."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(fn(b), names)

    return rows.mapInArrow(run, schema)


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c) over the texts, pre-counted in every batch."""
    def count(b):
        low, s, e, _, h = tokens(text_bytes(b.column(0)))
        _, first, c = np.unique(h, return_index=True, return_counts=True)
        raw = low.tobytes()
        return [pa.array([raw[x:y] for x, y in zip(s[first].tolist(), e[first].tolist())], pa.binary()), pa.array(c.astype(np.int64))]

    return _rows(train.select("text"), count, "word binary, c long", ["word", "c"]).groupBy("word").agg(F.sum("c").alias("c"))


def add_rows(acc: np.ndarray, ids: np.ndarray, rows: np.ndarray, few: int = 4) -> None:
    """acc[ids[i]] += rows[i], where ids may repeat."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    size = np.diff(np.r_[first, len(ids)])
    for k in range(few):
        at = first[(size > k) & (size <= few)]
        acc[ids[at]] += rows[order[at + k]]
    for x, n in zip(first[size > few].tolist(), size[size > few].tolist()):
        acc[ids[x]] += rows[order[x : x + n]].sum(axis=0)


def add_gradient(acc, h, row, cls, n, weights, bias) -> None:
    """Add a batch of histories to the sums of their features: the expected counts (dense), and for what was seen, n[i] tokens of
    class cls[i] after the history h[row[i]] (rows in order), the counts and how far they are above the expected ones."""
    expected, seen, above = acc[0], acc[1].reshape(-1), acc[2].reshape(-1)
    f = features(h)
    total = np.bincount(row, weights=n, minlength=len(h))
    ends = np.searchsorted(row, np.arange(0, len(h) + BLOCK, BLOCK))
    room = np.empty((2, BLOCK, CLASSES), np.float32)
    for k, lo in enumerate(range(0, len(h), BLOCK)):
        z = class_rows(f[:, lo : lo + BLOCK], weights, bias, *room)
        np.exp(z, out=z)
        z *= (total[lo : lo + len(z)] / z.sum(axis=1, dtype=np.float64)).astype(np.float32)[:, None]
        at = slice(ends[k], ends[k + 1])
        more = np.maximum(n[at] - z[row[at] - lo, cls[at]], 0).astype(np.float32)
        for ids in f[:, row[at]]:
            np.add.at(above, ids * CLASSES + cls[at], more)
            np.add.at(seen, ids * CLASSES + cls[at], n[at].astype(np.float32))
        for ids in f[:, lo : lo + BLOCK]:
            add_rows(expected, ids, z)


def train_classes(cells: DataFrame, prior: np.ndarray, rounds: int, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features, classes) and bias. One job a round over the cells (h, cs, ns): tasks add up the gradient rows of
    the features that they touch, the rows of a feature meet in one task, and the driver gets one step a feature."""
    bias = np.log(prior).astype(np.float32)
    w = np.zeros((FEATURES, CLASSES), np.float32)
    spark = cells.sparkSession
    cells = cells.coalesce(max(spark.sparkContext.defaultParallelism, cells.count() // TASK_CELLS))    # a task's rows are as many as features

    def gradient(weights):
        def run(batches):
            acc = np.zeros((3, FEATURES, CLASSES), np.float32)
            held, size = [], 0
            for b in batches:
                held, size = [*held, b], size + b.num_rows
                if size >= 16 * BLOCK:
                    add(acc, held)
                    held, size = [], 0
            add(acc, held)
            ids = np.flatnonzero(acc[0].any(axis=1))
            for lo in range(0, len(ids), 1024):
                part = ids[lo : lo + 1024]
                sums = np.concatenate([acc[1][part] - acc[0][part], acc[0][part] + acc[2][part]], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([x.tobytes() for x in sums], pa.binary())], ["f", "g"])

        def add(acc, held):
            if sum(b.num_rows for b in held):
                t = pa.Table.from_batches(held).combine_chunks()
                h, cs, ns = (t.column(i).chunk(0) for i in range(3))
                row = np.repeat(np.arange(len(h)), np.diff(cs.offsets.to_numpy()))
                add_gradient(acc, h.to_numpy(), row, cs.flatten().to_numpy().astype(np.int64), ns.flatten().to_numpy(), weights.value, bias)

        return run

    def steps(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for f, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                g = np.frombuffer(g, np.float32)
                if f in total:
                    total[f] += g
                else:
                    total[f] = g.astype(np.float64)
        if total:
            step = [(rate * x[:CLASSES] / (x[CLASSES:] + 5.0)).astype(np.float32).tobytes() for x in total.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(step, pa.binary())], ["f", "g"])

    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(w)
        with shuffles_dropped(spark):
            got = cells.mapInArrow(gradient(sent), "f int, g binary").repartition(GATHER, "f").mapInArrow(steps, "f int, g binary").toArrow()
        for b in got.to_batches():
            for f, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w[f] += np.frombuffer(g, np.float32)
        del got
        sent.destroy()                       # the job is done; the driver would keep each round's weights
    return w, bias


def score(docs: DataFrame, id_col="doc_id", text_col="text", frequent: int = 1 << 16, rounds: int = 12, rate: float = 0.6) -> DataFrame:
    """One row a document: held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    prepare(spark, batch_rows=256)
    ident = F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(ident, digest_key(text_col)).alias("key"),
                       (F.crc32(ident.cast("binary")) % 10 == 0).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    train = rows.filter(~F.col("held_out"))
    counts = written(word_counts(train), "words")
    totals = counts.agg(F.count("*").alias("v"), F.sum("c").alias("n")).first()
    ends = train.count()
    n, v = (totals.n or 0) + ends, totals.v + (ends > 0)
    top = counts.filter(F.col("c") * frequent >= F.lit(n)).select("word", "c").collect()
    vocab = spark.sparkContext.broadcast(Vocabulary([(bytes(r.word), r.c) for r in top]))
    del top

    def class_sums(b):
        words, c = text_bytes(b.column(0)), b.column(1).to_numpy()
        low, off = V.flat(words)
        cls, _ = vocab.value.ids(low, off[:-1], off[1:], V.span_hashes(low, off[:-1], off[1:]))
        return [pa.array(np.arange(CLASSES, dtype=np.int64)), pa.array(np.bincount(cls, minlength=CLASSES).astype(np.int64)),
                pa.array(np.bincount(cls, weights=c, minlength=CLASSES).astype(np.int64))]

    sums = _rows(counts, class_sums, "k long, v long, n long", ["k", "v", "n"]).groupBy("k").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).collect()
    size, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in sums:
        size[r.k], kinds[r.k] = r.n, r.v
    size[0], kinds[0] = ends, float(ends > 0)

    def cell_counts(b):
        h, c, _, _ = histories(text_bytes(b.column(0)), vocab.value)
        key, k = np.unique(h * CLASSES + c, return_counts=True)
        return [pa.array(key), pa.array(k.astype(np.int64))]

    cells = _rows(train.select("text"), cell_counts, "cell long, n long", ["cell", "n"]).groupBy("cell").agg(F.sum("n").alias("n"))
    cells = cells.groupBy((F.col("cell") / CLASSES).cast("long").alias("h")).agg(
        F.collect_list((F.col("cell") % CLASSES).cast("int")).alias("cs"), F.collect_list("n").alias("ns"))
    # histories that share their previous word stand together
    previous = (F.col("h") / CONTEXTS).cast("long")
    cells = written(cells.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), previous).sortWithinPartitions("h"), "cells")
    prior = (size + 0.5) / (size + 0.5).sum()
    weights, bias = train_classes(cells, prior, rounds, rate)
    within = np.log10(size + ALPHA * (kinds + 1))
    weights = spark.sparkContext.broadcast(weights)
    end_term = float(np.log10(ends + ALPHA))

    def local(b):
        texts = text_bytes(b.column(3))
        h, c, of, (_, _, _, doc, wh) = histories(texts, vocab.value)
        m = len(texts)
        at, known = vocab.value.find(wh)
        seen = np.log10(vocab.value.count[at[known]] + ALPHA) if known.any() else np.zeros(0)
        return [b.column(0), b.column(1), b.column(2), pa.array(np.bincount(of, minlength=m).astype(np.int64)),
                pa.array((np.bincount(doc[known], minlength=m) + (1 if ends else 0)).astype(np.int64)),
                pa.array(np.bincount(doc[known], weights=seen, minlength=m) + end_term),
                pa.array(np.bincount(of, weights=class_terms(h, c, weights.value, bias) - within[c], minlength=m))]

    mine = written(_rows(rows, local, "doc_id long, key long, held_out boolean, n_tokens long, n_top long, top_sum double, class_sum double",
                         ["doc_id", "key", "held_out", "n_tokens", "n_top", "top_sum", "class_sum"]), "texts")

    def rare(b):
        texts = text_bytes(b.column(1))
        low, s, e, doc, h = tokens(texts)
        _, known = vocab.value.find(h)
        s, e, doc, h = s[~known], e[~known], doc[~known], h[~known]
        order = np.lexsort((h, doc))
        new = np.r_[True, (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])] if len(h) else np.zeros(0, bool)
        pick, tf = order[new], np.diff(np.r_[np.flatnonzero(new), len(h)])
        raw = low.tobytes()
        return [pa.array(b.column(0).to_numpy()[doc[pick]]), pa.array([raw[x:y] for x, y in zip(s[pick].tolist(), e[pick].tolist())], pa.binary()), pa.array(tf.astype(np.int32))]

    # rows of equal key count once
    copies = mine.groupBy("key").agg(F.count("*").alias("copies"))
    pairs = _rows(rows.select("key", "text"), rare, "key long, word binary, tf int", ["key", "word", "tf"])
    found = pairs.join(counts.filter(F.col("c") * frequent < F.lit(n)), "word", "left")
    found = found.groupBy("key").agg(F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(ALPHA))).alias("rare_sum"),
                                     F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("n_rare"))
    found = found.join(copies, "key").select("key", (F.col("rare_sum") / F.col("copies")).alias("rare_sum"), (F.col("n_rare") / F.col("copies")).cast("long").alias("n_rare"))
    words = F.col("top_sum") + F.coalesce("rare_sum", F.lit(0.0))
    return mine.join(found, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_top") + F.coalesce("n_rare", F.lit(0))).alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"),
        (words - F.col("n_tokens") * F.lit(float(np.log10(n + ALPHA * (v + 1))))).alias("base_score"), (words + F.col("class_sum")).alias("score"))
