"""What the pairs of a batch share: bands of one machine word, n-grams counted by sorting, words cut into tokens once."""

import random
import time

from folio.functions import bleu as B
from folio.functions import distance as D
from folio.functions.bleu import clipped_matches, tokenize_13a


def _plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diag, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diag, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diag + (x != y))
    return row[-1]


def _edited(rng, a, letters, edits):
    b = list(a)
    for _ in range(edits):
        at, what = rng.randrange(len(b) + 1), rng.random()
        if what < 0.3:
            b.insert(at, rng.choice(letters))
        elif b:
            b[min(at, len(b) - 1)] = rng.choice(letters) if what < 0.7 else ""
    return "".join(b)


def test_a_band_of_one_word_is_exact_or_gives_up():
    for seed, letters in enumerate(("ab", "añ\u00ff\u00fe", "xy\uffff\U0001f600", "abcdefgh")):
        rng, sure = random.Random(seed), 0
        pairs = []
        for _ in range(50):
            a = "".join(rng.choice(letters) for _ in range(rng.choice((1, 2, 40, 63, 64, 65, 128, 200))))
            b = _edited(rng, a, letters, rng.choice((0, 1, 4, 15, 60)))
            a, b = (a, b) if len(a) >= len(b) else (b, a)
            if b and len(a) - len(b) <= D.WORD_EXTRA:
                pairs.append((a, b))
        for (a, b), d in zip(pairs, D.word_distances(pairs)):
            assert d is None or d == _plain(a, b)
            sure += d is not None
        assert sure >= len(pairs) // 2
        assert D.edit_distances(list(pairs)) == [_plain(a, b) for a, b in pairs]


def test_near_pairs_share_a_step_a_column():
    rng = random.Random(2)
    texts = ["".join(rng.choice("etaoinshrdlu etaoin") for _ in range(1500)) for _ in range(300)]
    pairs = [(a, _edited(rng, a, "aeiou ", 10)) for a in texts]
    began = time.process_time()
    many = D.edit_distances(list(pairs))
    took = time.process_time() - began
    assert many == [D.edit_distance(a, b) for a, b in pairs]
    before = D.WORD_FEW
    try:
        D.WORD_FEW = len(pairs) + 1                       # without the band of one word
        began = time.process_time()
        assert D.edit_distances(list(pairs)) == many
        assert took < 0.7 * (time.process_time() - began)
    finally:
        D.WORD_FEW = before


def test_counts_of_a_batch_are_those_of_each_pair():
    rng, pairs = random.Random(1), []
    for _ in range(600):
        words = [str(x) for x in range(rng.choice((1, 2, 5, 50, 5000)))]
        pairs.append(tuple([rng.choice(words) for _ in range(rng.choice((0, 1, 2, 3, 4, 5, 30, 200)))] for _ in "ab"))
    many = [str(x) for x in range(9000)]
    pairs.insert(7, (many, many[::2] + many[:50]))         # more distinct tokens than a number has room for
    pairs.insert(9, (["a", "b"] * 5000, ["b", "a"] * 4999))
    assert B.matches_of(pairs) == [B._matches(a, b) for a, b in pairs]
    assert B.matches_of([]) == []


def test_counting_a_batch_is_cheaper():
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.6)) % 5000}" for _ in range(20000)]
    pairs = [([rng.choice(words) for _ in range(320)],) * 2 for _ in range(400)]
    pairs = [(a, [x for i, x in enumerate(b) if i % 9]) for a, b in pairs]
    began = time.process_time()
    got = B.matches_of(pairs)
    took = time.process_time() - began
    began = time.process_time()
    assert got == [B._matches(a, b) for a, b in pairs] and took < 0.8 * (time.process_time() - began)


def test_words_have_the_tokens_of_the_whole_text(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("a5.,-  \n\t\x1c\x85\u3000 &;<ampé!'\u0663") for _ in range(rng.randrange(14))) for _ in range(1500)]
    texts += ["x <skipped> y", "&quot;a&amp;lt;b", "3.14, 5-6-7 ... -\nb", "(a)[b]{c}~ `q` \"w\" 'z' $5 100%", ""]
    rows = spark.createDataFrame([(a, b) for a, b in zip(texts, texts[1:] + texts[:1])], "a string, b string")
    words = B._Words()
    for r in rows.select("a", tokenize_13a("a").alias("tokens"), clipped_matches(tokenize_13a("a"), tokenize_13a("b")).alias("x"),
                         B.text_matches("a", "b").alias("y")).collect():
        assert r.tokens == B.tokens_of(r.a, words) and r.x == r.y
