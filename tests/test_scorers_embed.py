"""Scorers of a user beside the built-in ones, and the tiled embedding match."""

import random

import pytest
from pyspark.sql import functions as F

from folio.operators import evaluate as E
from folio.operators import scorers as SC
from folio.operators.embed_match import tiled_embedding_match
from folio.operators.metrics import greedy_embedding_match

PAGES = "model string, lang string, book string, page string, md string"


def _inputs(spark):
    refs = spark.createDataFrame([("en", "b", "1", "# One\ntwo words"), ("en", "b", "2", ""), ("en", None, "3", "x")], PAGES.replace("model string, ", ""))
    preds = spark.createDataFrame([("m", "en", "b", "1", "# One\ntwo word"), ("m", "en", "b", "2", ""), ("n", "en", "b", "1", None), ("n", "en", "b", "2", "y")], PAGES)
    return refs, preds


def test_user_scorer_runs_through_the_reports(spark):
    SC.expose(spark, "length_share", "least(length(ref), length(hyp)) / nullif(greatest(length(ref), length(hyp)), 0)")
    scorers = SC.Scorers(["ned", "struct_f1"]).add(SC.sql_scorer("length_share", places=3)).add(
        SC.Scorer("wrong", False, score=lambda r, h: (r != h).cast("int")))
    refs, preds = _inputs(spark)
    scores = E.eval_scores(refs, preds, scorers=scorers)
    plain = E.eval_scores(refs, preds)
    key = ["model", "lang", "book", "page"]
    assert scores.columns == [*key, "ned", "struct_f1", "length_share", "wrong"]
    got = {(r.model, r.page): r for r in scores.collect()}
    for r in plain.collect():
        assert (got[r.model, r.page].ned, got[r.model, r.page].struct_f1) == (r.ned, r.struct_f1)
    assert got["m", "1"].length_share == 14 / 15 and got["m", "2"].length_share is None and got["n", "1"].wrong is None
    total = {r.model: r for r in E.eval_summary(scores, ["model"], scorers).collect()}
    assert (total["m"].n_pages, total["m"].n_length_share, total["m"].corpus_length_share) == (2, 1, 0.933)
    assert (total["n"].n_wrong, total["n"].corpus_wrong) == (1, 1.0)
    first = {r.metric: r.model for r in E.model_ranking(scores, scorers=scorers).filter("rank = 1").collect()}
    assert first == {"ned": "m", "struct_f1": "m", "length_share": "m", "wrong": "m"}
    assert spark.sql("SELECT length_share('abcd', 'ab')").first()[0] == 0.5
    assert E.eval_summary(scores.filter("false"), ["model"], scorers).count() == 0


def test_scorers_without_built_in_ones_and_unscored_models(spark):
    scorers = SC.Scorers([]).add(SC.Scorer("only_m", score=lambda r, h: F.when(F.length(h) > 1, F.lit(2.0))))
    scores = E.eval_scores(*_inputs(spark), scorers=scorers)
    rank = {r.model: (r["rank"], r.value) for r in E.model_ranking(scores, scorers=scorers).collect()}
    assert rank == {"m": (1, 2.0), "n": (2, None)}


def test_scorer_names_are_taken_once(spark):
    s = SC.Scorers()
    for bad in (SC.Scorer("ned", score=lambda r, h: r), SC.Scorer("f1_bold", score=lambda r, h: r), SC.Scorer("none")):
        with pytest.raises(ValueError):
            s.add(bad)
    with pytest.raises(ValueError):
        SC.score_all(spark.createDataFrame([("a", "b", 1.0)], "ref string, hyp string, ned double"), ["ned"], s)


def test_type_report_is_the_detail_in_long_form(spark):
    refs, preds = _inputs(spark)
    detail = E.eval_scores(refs, preds, detail=True)
    rows = SC.type_report(detail, ["model", "page"]).collect()
    assert len(rows) == 4 * 13
    want = {(r.model, r.page): r for r in detail.collect()}
    assert all(r.f1 == want[r.model, r.page][f"f1_{r.type}"] for r in rows)


@pytest.mark.parametrize("tile", [1, 7, 4096])
def test_tiles_give_the_match_of_whole_pairs(spark, tile):
    rng = random.Random(3)
    rows = [(p, s, [rng.gauss(0, 1) for _ in range(6)]) for p, n, m in (("a", 40, 23), ("b", 1, 1), ("c", 5, 0), ("d", 0, 4)) for s, k in (("ref", n), ("hyp", m)) for _ in range(k)]
    rows += rows[:9] * 3                                     # repeated vectors count
    rows += [("a", "hyp", [0.0] * 6)]
    tv = spark.createDataFrame(rows, "pair string, side string, vec array<float>")
    want = {r.pair: r for r in greedy_embedding_match(tv, ["pair"]).collect()}
    got = {r.pair: r for r in tiled_embedding_match(tv.repartition(5), ["pair"], tile=tile).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert (got[k].n_ref, got[k].n_hyp) == (w.n_ref, w.n_hyp)
        assert all(abs(got[k][c] - w[c]) < 1e-9 for c in ("precision", "recall"))
        assert abs(got[k].bert_f1 - w.bert_f1) <= 1e-6


def test_tiles_odd_rows(spark):
    tv = spark.createDataFrame([(None, "x", "ref", [1.0, 0.0]), (None, "x", "hyp", [1.0, 0.0]), (1, "x", "ref", None), (2, "x", "ref", [1.0, 2.0])],
                               "pair int, n_ref string, side string, vec array<float>")
    pairs = spark.createDataFrame([(None,), (1,), (2,), (3,)], "pair int")
    got = {r.pair: (r.n_ref, r.n_hyp, r.bert_f1) for r in tiled_embedding_match(tv, ["pair"], pairs=pairs).collect()}
    assert got == {None: (1, 1, 1.0), 1: (0, 0, 1.0), 2: (1, 0, 0.0), 3: (0, 0, 1.0)}
    assert tiled_embedding_match(tv.filter("false"), ["pair"]).count() == 0
