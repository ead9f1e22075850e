import random

import pytest
from pyspark.sql import functions as F

import pyref
from folio.functions.distance import edit_distance
from folio.functions.markdown import with_elements
from folio.functions.text import normalise
from folio.operators.metrics import corpus_embedding_score, element_table, greedy_embedding_match, score_pairs
from folio.plans import fixtures as fx

PAIRS = [("", ""), ("a", ""), ("", "a"), ("same text", "same text"), ("abc", "abd"), ("😀x", "x"),
         ("é", "é"), ("a\r\nb", "a\nb"), ("a   b\n\n\n\nc", "a b\n\nc"), ("&amp; 3.14 5-6 a-b", "& 3.14 5 - 6 a-b"),
         ("word-\nwrap here", "wordwrap here"), ("one two three four five", "one two"), ("a b c", "d e f")]


def test_edit_distance_matches_dp():
    rnd = random.Random(7)
    for _ in range(500):
        al = rnd.choice(["ab", "aé😀 ", "abcdefgh"])
        a = "".join(rnd.choice(al) for _ in range(rnd.randint(0, 60)))
        b = "".join(rnd.choice(al) for _ in range(rnd.randint(0, 60)))
        assert edit_distance(a, b) == pyref.levenshtein(a, b)


# the pairs above as the normalisation must leave them, written by hand
NORMAL = {"a\r\nb": "a\nb", "a   b\n\n\n\nc": "a b\n\nc"}


def test_ned_bleu_literals(spark):
    df = spark.createDataFrame([(i, r, h) for i, (r, h) in enumerate(PAIRS)], "pid int, ref string, hyp string")
    got = {r.pid: r for r in score_pairs(df, ["pid"]).collect()}
    for i, (r, h) in enumerate(PAIRS):
        r, h = NORMAL.get(r, r), NORMAL.get(h, h)
        want = 0.0 if r == h else round(pyref.levenshtein(r, h) / max(len(r), len(h)), 6)
        assert got[i].ned == want
        assert got[i].bleu == pytest.approx(pyref.bleu(r, h), abs=1e-9)
        assert 0.0 <= got[i].ned <= 1.0
    assert got[0].bleu == 0.0 and got[0].ned == 0.0      # two empty texts: best NED, worst BLEU
    assert got[3].bleu == pytest.approx(100.0) and got[3].struct_f1 == 1.0


def edited(r, text, n, letters="abcdé "):
    out = list(text)
    for _ in range(n):
        k = r.randrange(len(out) + 1)
        out[k:k + r.choice([0, 1, 1])] = r.choice([[], [r.choice(letters)]])
    return "".join(out)


def test_banded_distance_is_exact(monkeypatch):
    import random

    from folio.functions import distance as D

    r = random.Random(11)
    for trial in range(1500):
        b = "".join(r.choices("ab" if trial % 2 else "abcdé ", k=r.randint(3, 60)))
        a = edited(r, b, r.randint(0, 12)) if trial % 3 else "".join(r.choices("abcd", k=r.randint(3, 70)))
        a, b = (a, b) if len(a) >= len(b) else (b, a)
        true = pyref.levenshtein(a, b)
        monkeypatch.setattr(D, "BAND_COLUMNS", r.choice([1, 5, 4096]))
        for k in (1, 2, 5, 9, 20):
            if len(a) - len(b) <= k < len(b):
                assert D.banded_distance(a, b, k) == min(true, k + 1), (a, b, k)
        monkeypatch.setattr(D, "BAND_FROM", r.choice([0, 10]))
        monkeypatch.setattr(D, "BAND_START", r.choice([1, 3]))
        assert D.edit_distance(a, b) == true


def test_long_pairs_of_few_edits():
    import random
    import time

    from folio.functions import distance as D

    r = random.Random(12)
    text = "".join(r.choices("abcdefghijklmnopqrstuvwxyz      ", k=100_000))
    other = edited(r, text, 2000, "abcxyz ")
    t0 = time.time()
    d = D.edit_distance(text, other)
    spent = time.time() - t0
    assert 1000 < d <= 2000 and spent < 5        # the whole table takes over 10 s
    short, brief = text[:6000], edited(r, text[:6000], 900)
    got = D.edit_distance(short, brief)
    whole = D.BAND_FROM
    try:
        D.BAND_FROM = 1 << 30
        assert D.edit_distance(short, brief) == got
        assert D.edit_distance(short, text[20_000:26_000]) == (setattr(D, "BAND_FROM", whole) or D.edit_distance(short, text[20_000:26_000]))
    finally:
        D.BAND_FROM = whole


def _elems(spark, text):
    r = with_elements(spark.createDataFrame([(text,)], "t string"), "t", "e").first()
    return sorted((x.type, x.token) for x in r.e)


def test_each_element_type(spark):
    cases = {
        "## Title *x*": ("headings", "2:title x"),
        "| h | k |\n|---|---|\n| 1 | 2 |": ("tables", "1"),
        "$$ y $$": ("math_block", "y"),
        "a $z$ b": ("math_inline", "z"),
        "[p. 12] x": ("page_nums", "12"),
        "x [^ab] y": ("footnotes", "ab"),
        "[^1]: def  here": ("footnote_defs", "def here"),
        "![Alt T](x.png)": ("images", "alt t"),
        "- item **b**": ("list_items", "item b"),
        "**B**": ("bold", "b"),
        "*I*": ("italic", "i"),
        "***BI***": ("bold_italic", "bi"),
        "> q1\n> q2": ("blockquotes", "q1 q2"),
    }
    for text, want in cases.items():
        assert want in _elems(spark, text), text


def test_element_contract_edges(spark):
    e = _elems(spark, "```\n# not\n- no\n```\n* * *\n> - inside quote")
    assert ("headings", "1:not") not in e and ("list_items", "no") not in e
    assert ("list_items", "inside quote") not in e
    assert ("footnotes", "1") not in _elems(spark, "[^1]: def")


def test_struct_f1_self_is_one(spark):
    d = fx.rich_sections(spark, "/root/testdata/sf0.001").select("section_pos", F.col("md").alias("ref"), F.col("md").alias("hyp"))
    s = score_pairs(d, ["section_pos"])
    assert s.filter("struct_f1 <> 1.0 OR ned <> 0.0").count() == 0


def test_normalise_literals(spark):
    cases = {"a\r\nb\rc": "a\nb\nc", "\t x \t y ": "x y", "a\n\n\n\n\nb": "a\n\nb", "a\n\nb": "a\n\nb", "\u00a0z\u2003": "z", "": "", " \n ": ""}
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "t string, want string")
    assert [r for r in rows.select("want", normalise("t").alias("got")).collect() if r.got != r.want] == []


def test_scores_compose_accents(spark):
    import unicodedata
    ref = "Größe über café\n\n## Überschrift é\n\n- Öl à la carte"
    df = spark.createDataFrame([(1, ref, unicodedata.normalize("NFD", ref)), (2, unicodedata.normalize("NFD", ref), ref), (3, None, ref), (4, None, None)],
                               "pid int, ref string, hyp string")
    got = {r.pid: r for r in score_pairs(df, ["pid"], detail=True).collect()}
    for i in (1, 2):
        assert (got[i].ned, round(got[i].bleu, 6), got[i].struct_f1, got[i].f1_headings) == (0.0, 100.0, 1.0, 1.0)
    assert got[3].ned == 1.0 and got[4].ned == 0.0
    both = element_table(df.filter("pid = 1"), ["pid"]).groupBy("type", "token").count().collect()
    assert {r["count"] for r in both} == {2}


def test_long_runs_of_lines(spark):
    n = 100_000
    texts = [("quote", "> x\n" * n), ("table", "| h | k |\n|---|---|\n" + "| 1 | 2 |\n" * n), ("item", "- first\n" + "more\n" * n),
             ("columns", "|" + "a|" * 20_000 + "\n|" + "-|" * 20_000 + "\n|" + "1|" * 20_000), ("rule", "- " * n), ("nested", "> " * n + "q"), ("list", "- a\n" * n)]
    df = spark.createDataFrame(texts, "k string, ref string").withColumn("hyp", F.col("ref"))
    got = {(r.k, r.type): (r.n, r.size) for r in with_elements(df, "ref", "es").select("k", F.explode("es").alias("e")).groupBy("k", "e.type")
           .agg(F.count("*").alias("n"), F.max(F.length("e.token")).alias("size")).collect()}
    assert got["quote", "blockquotes"] == (1, 2 * n - 1) and got["table", "tables"] == (2 * n, 1)
    assert got["item", "list_items"] == (1, 5 + 5 * n) and got["list", "list_items"] == (n, 1)
    assert got["columns", "tables"][0] == 20_000 and ("rule", "list_items") not in got and got["nested", "blockquotes"] == (1, 1)
    assert score_pairs(df.filter("k in ('quote', 'item')").withColumn("ref", F.substring("ref", 1, 20_000)).withColumn("hyp", F.col("ref")), ["k"]).filter("struct_f1 = 1.0").count() == 2


def test_item_continuation_lines(spark):
    e = _elems(spark, "- one\n  more\n- two\n\nplain\n1. three\n# head\n")
    assert [t for k, t in e if k == "list_items"] == ["one more", "three", "two"]


BLOCK_CASES = {
    "Title\n=====": [("headings", "1:title")],
    "Two\nlines\n---\nrest": [("headings", "2:two lines")],
    "a\n\n===\nb": [],                                            # no paragraph above: text
    "a\n\n---\nb": [],                                            # a rule
    "> q\nlazy\nmore\n\nout": [("blockquotes", "q lazy more")],
    "> q\n===": [("blockquotes", "q ===")],                        # an underline can't be lazy
    "> q\n---\nx": [("blockquotes", "q")],
    "> # h\nnot lazy": [("blockquotes", "# h")],
    "> a\n>\nnot lazy": [("blockquotes", "a")],
    "> a\n- b\n> c": [("blockquotes", "a"), ("blockquotes", "c"), ("list_items", "b")],
    "- a\n  - b\n  - c\n- d": [("list_items", "a b c"), ("list_items", "b"), ("list_items", "c"), ("list_items", "d")],
    "- a\n\n  more\n\nout": [("list_items", "a more")],
    "- a\n  - b\nlazy\n\n  back\n\nout": [("list_items", "a b lazy back"), ("list_items", "b lazy")],
    "1. a\n2. b\n   - c": [("list_items", "a"), ("list_items", "b c"), ("list_items", "c")],
    "text\n2. no list\n1. list": [("list_items", "list")],
    "- a\n# h\nb": [("headings", "1:h"), ("list_items", "a")],
    "- a\n  # h\n  b": [("headings", "1:h"), ("list_items", "a h b")],
    "- t\n  ---\n  x": [("headings", "2:t"), ("list_items", "t x")],
    "- a\n---\nb": [("list_items", "a")],
    "h | k\n--|--\n1 | 2\n3\n": [("tables", "1"), ("tables", "2")],
    "x\n```\n# no\n```\n===": [],
    "- a\n  > q\n  > r\n- b": [("blockquotes", "q r"), ("list_items", "a q r"), ("list_items", "b")],
    "####### seven": [], "#no": [], "# ": [("headings", "1:")], "# a #": [("headings", "1:a")],
    "": [], "\n\n": [], None: [],
}


def test_block_structure(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(BLOCK_CASES)], "i int, t string")
    got = {r.i: r.e for r in with_elements(df, "t", "e").collect()}
    for i, (text, want) in enumerate(BLOCK_CASES.items()):
        have = sorted((x.type, x.token) for x in got[i] or [] if x.type not in ("italic", "bold"))
        assert have == sorted(want), text


def test_blocks_do_not_depend_on_segments(spark, monkeypatch):
    from folio.functions import blocks as B

    text = "\n\n".join(t for t in BLOCK_CASES if t) * 3
    df = spark.createDataFrame([(text,)], "t string")
    whole = with_elements(df, "t", "e").first().e
    for size in (1, 3, 7):
        monkeypatch.setattr(B, "SEGMENT", size)
        assert with_elements(df, "t", "e").first().e == whole


def test_embedding_match_bounds(spark):
    rows = [(1, "ref", [1.0, 0.0]), (1, "hyp", [1.0, 0.0]), (1, "hyp", [0.0, 1.0]), (2, "ref", [1.0, 1.0])]
    tv = spark.createDataFrame(rows, "pair int, side string, vec array<double>")
    pairs = spark.createDataFrame([(1,), (2,), (3,)], "pair int")
    for block in (1, 512):
        got = {r.pair: r for r in greedy_embedding_match(tv, ["pair"], pairs=pairs, block=block).collect()}
        assert (got[1].precision, got[1].recall, got[1].bert_f1) == (0.5, 1.0, 0.666667)
        assert got[2].bert_f1 == 0.0 and got[3].bert_f1 == 1.0 and got[3].n_ref == 0
    assert corpus_embedding_score(greedy_embedding_match(tv, ["pair"], pairs=pairs)).first().corpus_bert_f1 == 0.5556
