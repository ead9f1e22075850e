"""The scoring core: distances of a batch, expressions that were made cheaper, bounded batches, packed stream state."""

import random
import re
import time

import pandas as pd
from pyspark.sql import functions as F

from folio.functions import distance as D
from folio.functions import text as T
from folio.functions.bleu import RULES_13A, clipped_matches, spaced_13a, spaced_matches, tokenize_13a


def _plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diag, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diag, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diag + (x != y))
    return row[-1]


def _pairs(seed, count, sizes, alphabet, edits):
    rng, out = random.Random(seed), []
    for _ in range(count):
        a = [rng.choice(alphabet) for _ in range(rng.choice(sizes))]
        b = list(a)
        for _ in range(rng.choice(edits)):
            at, what = rng.randrange(len(b) + 1), rng.random()
            if what < 0.3:
                b.insert(at, rng.choice(alphabet))
            elif b and what < 0.6:
                del b[min(at, len(b) - 1)]
            elif b:
                b[min(at, len(b) - 1)] = rng.choice(alphabet)
        out.append(("".join(a), "".join(b)) if rng.random() < 0.5 else ("".join(b), "".join(a)))
    return out


def test_distances_of_a_batch_are_exact():
    for seed, alphabet in enumerate(("ab", "abcdefé", "xy😀￿")):
        pairs = _pairs(seed, 40, (66, 70, 100, 160), alphabet, (0, 1, 5, 40, 90)) + [("", ""), ("", "abc"), ("a" * 80, ""), ("a" * 90, "b" * 70)]
        assert D.edit_distances(list(pairs)) == [_plain(a, b) for a, b in pairs]


def test_a_narrow_band_gives_up_rather_than_err():
    pairs = [(a, b) if len(a) >= len(b) else (b, a) for a, b in _pairs(7, 30, (120,), "abc", (0, 3, 60))]
    for margin in (1, 4, 15):
        for (a, b), d in zip(pairs, D.lane_distances(pairs, margin)):
            assert d is None or d == _plain(a, b)
    assert None not in D.lane_distances(pairs, 120)


def test_batch_shares_the_interpreters_cost():
    letters = "etaoinshrdlu etaoin"
    pairs = _pairs(3, 512, (1500,), letters, (10, 20, 30))
    began = time.process_time()
    many = D.edit_distances(list(pairs))
    took = time.process_time() - began
    began = time.process_time()
    one = [D.edit_distance(a, b) for a, b in pairs]
    assert many == one and took < 0.7 * (time.process_time() - began)


def test_white_space_class_and_13a_classes_hold_the_same_characters(spark):
    import unicodedata

    chars = [c for c in map(chr, range(1, 0x3100)) if unicodedata.category(c) != "Cs"]
    rows = spark.createDataFrame([(c,) for c in chars], "c string")
    assert {r.c for r in rows.filter(F.col("c").rlike(T.WS_CLASS)).collect()} == set(T.PY_WHITESPACE)
    written = re.compile(r"[\{-\~\[-\` -\&\(-\+\:-\@\/]")
    assert {c for c in chars if re.match(RULES_13A[0][0], c)} == {c for c in chars if written.match(c)} - {" "}


def test_nfc_sends_only_what_may_change(spark):
    texts = ["plain", "", None, "é ü ß", "é", "ẛ̣", "한글 한", "😀", "Å", "à̕"]
    import unicodedata

    got = [r.x for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.nfc("t").alias("x")).collect()]
    assert got == [t if t is None else unicodedata.normalize("NFC", t) for t in texts]


def test_spaced_text_has_the_tokens_of_the_array(spark):
    texts = ["", "a,b.c", "x,.y ,, . 5,.6 3.14 5-6-7", "a &amp; b&lt;c  d  e\x1cf", "tab\tin\n\nlines-\nbroken ...", "(a)[b]{c}~ `q` \"w\" 'z' $5 100%"]
    rows = spark.createDataFrame([(i, a, b) for i, a in enumerate(texts) for b in texts], "i int, a string, b string")
    both = rows.select("a", tokenize_13a("a").alias("array"), spaced_13a("a").alias("spaced"), clipped_matches(tokenize_13a("a"), tokenize_13a("b")).alias("x"),
                       spaced_matches(spaced_13a("a"), spaced_13a("b")).alias("y")).collect()
    for r in both:
        assert r.array == r.spaced.split() and r.x == r.y


def test_scores_run_in_bounded_batches(spark):
    from folio.operators.metrics import score_pairs
    from folio.session import BATCH_BYTES, BATCH_ROWS

    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], "10000")
        spark.conf.unset(keys[1])
        pairs = spark.createDataFrame(pd.DataFrame({"k": [1, 2], "ref": ["# a b", "x"], "hyp": ["# a c", "x"]}))
        assert score_pairs(pairs, ["k"]).count() == 2
        assert int(spark.conf.get(keys[0])) == BATCH_ROWS and spark.conf.get(keys[1]) in (BATCH_BYTES, str(8 << 20), f"{8 << 20}b")
        spark.conf.set(keys[0], "64")
        score_pairs(pairs, ["k"])
        assert spark.conf.get(keys[0]) == "64"                # a smaller setting stays
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)


def test_stream_keeps_one_store_a_partition(spark, tmp_path):
    from folio.streaming.incremental import PRED_SCHEMA, REF_SCHEMA, STATE, read_scores, start_scores

    ref, pred, ckpt, out = (str(tmp_path / x) for x in ("ref", "pred", "ckpt", "out"))
    spark.createDataFrame([("en", "b", f"p{i}", f"# page {i}") for i in range(4)], REF_SCHEMA).write.parquet(ref)
    settings = {k: spark.conf.get(k, None) for k in STATE}
    for half in (0, 1):                                     # the job stops between the landings
        spark.createDataFrame([("m", "en", "b", f"p{i}", f"# page {i}") for i in (2 * half, 2 * half + 1)], PRED_SCHEMA).write.mode("append").parquet(pred)
        start_scores(spark, ref, pred, out, ckpt).awaitTermination()
    assert {k: spark.conf.get(k, None) for k in STATE} == settings
    assert sorted(r.page for r in read_scores(spark, out).filter("ned = 0").collect()) == [f"p{i}" for i in range(4)]
    stores = [p for p in (tmp_path / "ckpt" / "state" / "0" / "0").iterdir() if p.is_dir() and not p.name.startswith("_")]
    assert len(stores) <= 1                                 # format 2: four folders, one for each store


def test_elements_are_made_on_all_partitions(spark):
    from folio.operators import evaluate as E

    refs = spark.createDataFrame([("it", "b", f"p{i}", f"# T {i}\n\n- a\n- a") for i in range(6)], "lang string, book string, page string, md string")
    preds = spark.createDataFrame([("m", "it", "b", f"p{i}", "- a") for i in range(6)], "model string, lang string, book string, page string, md string")
    found = E.eval_elements(refs, preds)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    assert sorted((r.page, r.side, r.type, r.token, r.cnt) for r in found.collect() if r.page == "p1") == [
        ("p1", "hyp", "list_items", "a", 1), ("p1", "ref", "headings", "1:t 1", 1), ("p1", "ref", "list_items", "a", 2)]
