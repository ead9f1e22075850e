"""Mergeable summary states and the single-pair report."""

import random

import pytest

from folio.operators import report as R
from folio.operators.evaluate import eval_summary
from folio.operators.metrics import score_pairs

SCORE = "model string, lang string, book string, page string, ned double, similarity double, bleu double, struct_f1 double"


def scores(n=600):
    r = random.Random(5)
    return [(f"m{i % 2}", r.choice(["it", "de", None]), f"b{i % 3}", f"p{i}", round(r.random(), 6), round(r.random(), 6), 100 * r.random(), round(r.random(), 6)) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_report_equals_the_whole(spark, tmp_path, seed):
    rows = scores()
    whole = spark.createDataFrame(rows, SCORE)
    mixed = list(rows)
    random.Random(seed).shuffle(mixed)
    cuts = [0, 1, 50, 51, 400, len(mixed)]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        R.write_state(spark.createDataFrame(mixed[a:b], SCORE), str(tmp_path / "s"), k)
    R.write_state(spark.createDataFrame(mixed[50:51], SCORE), str(tmp_path / "s"), 2)          # a replay
    states = R.read_states(spark, str(tmp_path / "s"))
    got = sorted(map(tuple, R.report_of(states).collect()), key=str)
    assert got == sorted(map(tuple, eval_summary(whole).collect()), key=str)
    exact = lambda s: sorted(map(str, s.select("model", "lang", "book", "n_pages", "sum_ned", "sum_bleu").collect()))
    assert exact(R.merge_states(states)) == exact(R.merge_states(R.summary_state(whole)))      # to the last digit
    by_model = R.report_of(states, ["model"]).collect()
    assert {r.model: r.n_pages for r in by_model} == {"m0": 300, "m1": 300}


def test_nulls_and_nothing(spark):
    none = spark.createDataFrame([("m", "it", "b", "p", None, None, None, None), ("m", "it", "b", "q", 0.5, 0.5, None, 1.0)], SCORE)
    (r,) = R.report_of(R.summary_state(none)).collect()
    assert (r.n_pages, r.avg_ned, r.avg_bleu, r.avg_struct_f1) == (2, 0.5, None, 1.0)
    (line,) = R.report_lines(R.report_of(R.summary_state(none))).collect()
    assert line.line == "2 pages; ned 0.5000; similarity 0.5000; bleu -; struct_f1 1.0000"
    assert R.report_of(R.summary_state(none.filter("false"))).count() == 0


def test_single_pair(spark):
    df = spark.createDataFrame([("x", "# A\n\nb c d e", "# A\n\nb c d"), ("y", None, "")], "k string, ref string, hyp string")
    got = {(r.k, r.metric): (r.value, r.higher_is_better) for r in R.pair_report(df, ["k"]).collect()}
    one = score_pairs(df, ["k"]).filter("k = 'x'").first()
    assert [got["x", m][0] for m in ("ned", "similarity", "bleu", "struct_f1")] == [one.ned, one.similarity, one.bleu, one.struct_f1]
    assert got["x", "ned"][1] is False and got["x", "bleu"][1] is True and got["y", "ned"][0] == 0.0 and len(got) == 8
