"""The pairs of a micro-batch move once: the latest of a page is picked where its rows are."""

from folio.operators.evaluate import PAGE_KEY
from folio.streaming import incremental as I


def test_pairs_of_a_batch_move_once(spark, tmp_path, monkeypatch):
    refs, preds, out = (str(tmp_path / x) for x in ("ref", "pred", "out"))
    for k in range(2):                                       # each prediction and reference lands twice, the second amended
        spark.createDataFrame([("en", "b", f"p{i}", f"# T {k}\n\n- a {i}") for i in range(30)], I.REF_SCHEMA).write.mode("append").parquet(refs)
        spark.createDataFrame([("m", "en", "b", f"p{i}", f"# T {k}\n\n- a {i}") for i in range(30)], I.PRED_SCHEMA).write.mode("append").parquet(preds)
    plans, score = [], I.score_pairs

    def seen(rows, keys):
        scored = score(rows, keys)
        plans.append(scored._jdf.queryExecution().executedPlan().toString())
        return scored

    monkeypatch.setattr(I, "score_pairs", seen)
    I.start_scores(spark, refs, preds, out, str(tmp_path / "ckpt")).awaitTermination()
    assert plans and all(p.count("Exchange hashpartitioning") == 1 for p in plans)
    got = I.read_scores(spark, out)
    assert got.count() == 30 == got.select("model", *PAGE_KEY).distinct().count() and got.filter("ned > 0 OR struct_f1 < 1").count() == 0
