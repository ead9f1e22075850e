"""Distances of pairs of unequal length: bands of as many machine words as each pair needs, in one step a column."""

import random
import time

from folio.functions import distance as D
from test_scoring_batches import _edited, _plain


def _unequal(rng, letters, sizes, cuts, edits):
    a = "".join(rng.choice(letters) for _ in range(rng.choice(sizes)))
    b = _edited(rng, a, letters, rng.choice(edits))
    for _ in range(3):
        at = rng.randrange(len(b) + 1)
        b = b[:at] + b[at + rng.choice(cuts):]
    return (a, b) if len(a) >= len(b) else (b, a)


def test_bands_of_several_words_are_exact_or_give_up():
    for seed, letters in enumerate(("a", "ab", "xy￿\U0001f600é", "abcdefgh ")):
        rng, sure = random.Random(seed), 0
        pairs = [_unequal(rng, letters, (1, 63, 64, 65, 130, 300), (0, 1, 20, 70), (0, 3, 40)) for _ in range(30)]
        pairs = [p for p in pairs if p[1]]
        exact = [_plain(a, b) for a, b in pairs]
        words = [(len(a) - len(b)) // 64 + rng.choice((1, 1, 2, 5)) for a, b in pairs]
        for d, e in zip(D.band_distances(pairs, words), exact):
            assert d is None or d == e
            sure += d is not None
        assert sure >= len(pairs) // 2
        before = D.BAND_TABLE
        try:
            D.BAND_TABLE = 1                               # each pair by itself
            assert [d for d, e in zip(D.band_distances(pairs, words), exact) if d not in (None, e)] == []
        finally:
            D.BAND_TABLE = before
        assert D.edit_distances(list(pairs)) == exact


def test_unequal_pairs_share_a_step_a_column():
    rng = random.Random(6)
    pairs = [_unequal(rng, "etaoinshrdlu etaoin", range(300, 2600), range(300), (10,)) for _ in range(300)]
    began = time.process_time()
    many = D.edit_distances(list(pairs))
    took = time.process_time() - began
    began = time.process_time()
    one = [D.edit_distance(a, b) for a, b in pairs]
    alone = time.process_time() - began
    assert many == one and took < 0.4 * alone, (took, alone)


def test_patterns_without_a_lazy_loop_find_the_same(spark):
    from pyspark.sql import functions as F

    from folio.functions import markdown as MD
    from folio.functions import text as T

    rng = random.Random(8)
    texts = ["".join(rng.choice("***$$ab\n \t\r😀") for _ in range(rng.randrange(24))) for _ in range(4000)]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    lazy = {MD.RE_MATH_BLOCK: r"(?s)\$\$(.*?)\$\$", MD.RE_MATH_INLINE: r"\$([^\$\n]+?)\$", MD.RE_BOLD_ITALIC: r"(?s)\*{3}(.+?)\*{3}",
            MD.RE_BOLD: r"(?s)\*{2}(.+?)\*{2}", MD.RE_ITALIC: r"\*([^*\n]+)\*"}
    assert all("?)" not in p for p in lazy)
    for now, before in lazy.items():
        a, b = (F.struct(F.regexp_extract_all("t", F.lit(p), 1), F.regexp_replace("t", p, "<$1>")) for p in (now, before))
        assert df.filter(a != b).count() == 0
    odd = F.col("t").rlike(T.ODD_SPACE)
    assert df.filter(T.normalise_token("t") != T.normalise_token("t", odd)).count() == 0 < df.filter(odd).count() < len(texts)
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("t", "\r\n|\r", "\n"), r"[ \t]+", " "), r"\n{3,}", "\n\n")
    assert df.filter(T.normalise("t") != T.py_strip(plain)).count() == 0
    spaces = spark.createDataFrame([(c,) for c in map(chr, range(1, 0x3100)) if c not in " \n"], "c string")
    assert {r.c for r in spaces.filter(F.col("c").rlike(T.ODD_SPACE)).collect()} == set(T.PY_WHITESPACE) - set(" \n")
