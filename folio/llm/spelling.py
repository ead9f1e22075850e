"""Spelling variants: words one edit apart, found by pivotal grams.

Bigrams are put in one order for all words, rarest first. A word's prefix is its first
three bigrams in that order (and all equal in order to the third); two of them that don't
overlap, with the least sum of frequencies, are its pivots. An edit spoils at most one
of two bigrams without a common letter, so if two words are one edit apart, a pivot of the word
whose prefix ends earlier stands in the other one, moved by one place at most, and is in that
one's prefix (its prefix reaches at least as far). So pivots are looked up among prefixes.

The position limit is kept by content: beside the pivot that survived, the text on the edit's far side is
untouched, and on the edit's side so is one half of it. The index holds each prefix bigram
with that side and either half (12 keys a word), the lookup each pivot with the halves that an
other word of the same, one less or one more letters would have. Pairs that meet in
a key are then verified by their edit distance. Keys this long keep the pairs near the number of real
neighbours: 32 million instead of 1,500 million over bigram, place and length in 0.1 GB of documents.

The order of bigrams is that of 65,536 hashed classes of them, for any alphabet: the table of counts
that goes to the tasks never exceeds that.

Defined results: null and empty texts have no words; a null id counts as the empty string in the noise rule;
repeated rows count as often as they stand; ties of n go to the smaller word in code-point order; an
empty table gives an empty one; only id and text are read, so no column can clash. Words of fewer than 4 letters
have no two pivots and are refused (``min_letters``).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import prepare, text_bytes, written

CLASSES = 1 << 16
# Fixed value: letters of a word.
LETTERS = "A-Za-zÀ-ÿ"


def noised(word: str, doc: str, one_in: int) -> str:
    """The word, without one letter in the documents that its hash picks."""
    h = zlib.crc32(f"{doc}:{word}".encode())
    if h % one_in:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def word_counts(docs: DataFrame, id_col="doc_id", text_col="text", min_letters: int = 7, min_count: int = 2, noise: int | None = None) -> DataFrame:
    """word, n: runs of letters, A-Z in lower case, with at least ``min_letters`` code points and ``min_count`` occurrences.
    ``noise`` drops a letter of about one in so many (document, word) pairs before that."""
    prepare(docs.sparkSession)
    find = re.compile(f"[{LETTERS}]{{{min_letters},}}").findall

    def run(batches):
        for b in batches:
            seen: Counter = Counter()
            for doc, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                if noise is None:
                    seen.update(find(text.lower().decode()))
                    continue
                for w, n in Counter(find(text.lower().decode())).items():
                    w = noised(w, doc, noise)
                    if len(w) >= min_letters:
                        seen[w] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def grams(word: str) -> list[str]:
    return [word[i : i + 2] for i in range(len(word) - 1)]


def gram_class(gram: str) -> int:
    return zlib.crc32(gram.encode()) % CLASSES


def gram_ranks(words: DataFrame) -> np.ndarray:
    """Counts of the bigram classes over the words; at most 65,536 rows come to the driver."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    rows = words.select(F.explode_outer(F.transform(places, lambda i: F.pmod(F.crc32(F.substr("word", i, F.lit(2)).cast("binary")), F.lit(CLASSES)))).alias("c"))
    count = np.zeros(CLASSES, np.int64)
    for c, n in rows.groupBy("c").agg(F.count("*").alias("n")).collect():
        count[c] = n
    return count


def pivots(prefix: list[tuple[int, int]], n: int = 2) -> list[int]:
    """Places of ``n`` bigrams without a common letter and with the least sum of costs; prefix: (place, cost) by place.
    best[j] is the cheapest choice of j bigrams among those that end before the one looked at."""
    best: list[tuple[int, tuple[int, ...]] | None] = [(0, ())] + [None] * n
    waiting: list[tuple[int, list]] = []
    for place, cost in prefix:
        while waiting and waiting[0][0] <= place - 2:
            for j, c in waiting.pop(0)[1]:
                if best[j] is None or c < best[j]:
                    best[j] = c
        waiting.append((place, [(j + 1, (b[0] + cost, b[1] + (place,))) for j, b in enumerate(best[:n]) if b is not None]))
    for _, rest in waiting:
        for j, c in rest:
            if best[j] is None or c < best[j]:
                best[j] = c
    return list(best[n][1])


def index_keys(word: str, places) -> list[str]:
    """Keys of a word's prefix bigrams: the bigram with the whole side beside it and one half of the other side."""
    m, out = len(word), set()
    for p in places:
        t, q = m - p - 2, p + 2                     # the edit is behind the bigram: word[:q] stays
        out |= {f"a{p} {word[: q + t // 2]}", f"b{p} {word[:q]} {word[q + t // 2 :]}"}
        e = m - p                                   # the edit is before it: word[p:] stays
        out |= {f"c{e} {word[: p // 2]} {word[p:]}", f"d{e} {word[p // 2 :]}"}
    return sorted(out)


def lookup_keys(word: str, places) -> list[str]:
    """The keys under which a word one edit away holds one of these bigrams."""
    m, out = len(word), set()
    for p in places:
        t, q, e = m - p - 2, p + 2, m - p
        for other in (t - 1, t, t + 1):             # letters that the other word has there
            if other >= 0:
                head, tail = other // 2, other - other // 2
                if head <= t:
                    out.add(f"a{p} {word[: q + head]}")
                if tail <= t:
                    out.add(f"b{p} {word[:q]} {word[m - tail :]}")
        for other in (p - 1, p, p + 1):
            if other >= 0:
                head, tail = other // 2, other - other // 2
                if head <= p:
                    out.add(f"c{e} {word[:head]} {word[p:]}")
                if tail <= p:
                    out.add(f"d{e} {word[p - tail :]}")
    return sorted(out)


def signature(word: str, rank: np.ndarray, cache: dict) -> tuple[int, list[str], list[str]]:
    """Where the word's prefix ends in the order, its index keys and its lookup keys."""
    order = []
    for i, g in enumerate(grams(word)):
        r = cache.get(g)
        if r is None:
            r = cache[g] = int(rank[gram_class(g)])
        order.append((r, i))
    order.sort()
    last = order[2][0]
    prefix = sorted((i, r) for r, i in order if r <= last)
    return last, index_keys(word, [i for i, _ in prefix]), lookup_keys(word, pivots(prefix))


def near_pairs(words: DataFrame) -> DataFrame:
    """word, other, other_n: both directions of each two words (word, n) one edit apart."""
    spark = words.sparkSession
    prepare(spark)
    count = gram_ranks(words)
    rank = np.empty(CLASSES, np.int64)
    rank[np.lexsort((np.arange(CLASSES), count))] = np.arange(CLASSES)
    shared = spark.sparkContext.broadcast(rank)          # 512 KB whatever the words are

    def run(batches):
        cache: dict = {}
        for b in batches:
            rows = defaultdict(list)
            for w in b.column(0).to_pylist():
                if len(cache) > CLASSES:
                    cache.clear()
                for name, x in zip(("last", "held", "asked"), signature(w, shared.value, cache)):
                    rows[name].append(x)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows["last"], pa.int32()), pa.array(rows["held"], pa.list_(pa.string())),
                                              pa.array(rows["asked"], pa.list_(pa.string()))], ["word", "n", "last", "held", "asked"])

    # signing is bound by CPU, not bytes: spread beyond what adaptive execution would deal by size
    spread = words.select("word", "n").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word")
    signed = written(spread.mapInArrow(run, "word string, n long, last int, held array<string>, asked array<string>"), "signatures")
    keyed = lambda col: signed.select(F.explode_outer(F.transform(col, lambda k: F.xxhash64(k))).alias("key"), "word", "n", "last")
    a, b = keyed("asked").alias("a"), keyed("held").alias("b")
    close = (F.abs(F.length("a.word") - F.length("b.word")) <= 1) & (F.col("a.word") != F.col("b.word")) & (F.col("a.last") <= F.col("b.last"))
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & close).filter(F.levenshtein("a.word", "b.word", 1) == 1)
    ways = F.array(F.struct(F.col("a.word").alias("word"), F.col("b.word").alias("other"), F.col("b.n").alias("other_n")),
                   F.struct(F.col("b.word").alias("word"), F.col("a.word").alias("other"), F.col("a.n").alias("other_n")))
    return met.select(F.explode_outer(ways).alias("p")).select("p.*").distinct()


def roots(links: DataFrame) -> DataFrame:
    """word, root: where following word -> form ends. Forms grow tenfold in n, so a chain is short; each round
    doubles the steps behind it."""
    links = written(links.select("word", F.col("form").alias("root")), "links")
    while True:
        far = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = links.join(far, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = written(step, "links")
        if step.filter("moved").isEmpty():
            return step.select("word", "root")
        links = step.select("word", "root")


def variants(words: DataFrame, ratio: int = 10, min_letters: int = 4) -> DataFrame:
    """word, form (the near word of largest n, ties: the smallest, if its n is at least ratio * n), root (where the forms lead),
    n, n_near, form_n; one row a word of ``words`` (word, n; words are distinct)."""
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, else forms could lead in a circle")
    if min_letters < 4:
        raise ValueError("words need 4 letters for two pivots")
    prepare(words.sparkSession)
    words = written(words.filter(F.length("word") >= min_letters).select("word", "n"), "words")
    best = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("neg"), F.col("other").alias("other"))).alias("best"))
    rows = words.join(best, "word", "left")
    strong = -F.col("best.neg") >= ratio * F.col("n")
    rows = written(rows.select("word", F.when(strong, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                               F.when(strong, -F.col("best.neg")).alias("form_n")), "forms")
    ends = roots(rows.filter("form IS NOT NULL"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
