"""Prediction batches and the incremental scorer."""

import pytest
from pyspark.sql import functions as F

from folio import session
from folio.operators import predict as P
from folio.operators.evaluate import eval_scores
from folio.streaming.incremental import read_scores, start_incremental_scores, start_scores

REF = "lang string, book string, page string, md string"
PRED = "model string, lang string, book string, page string, md string"


def test_batches_carry_the_model(spark):
    pages = [("it", "b", f"page_{i:04d}.jpg") for i in range(19)]
    images = spark.createDataFrame(pages, "lang string, book string, page string").withColumn("model", F.explode(F.array(F.lit("x/m1"), F.lit("x/m2"))))
    done = spark.createDataFrame([("x/m1", "it", "b", "page_0003.md")], "model string, lang string, book string, page string")
    k = ("model", "lang", "book")
    left = P.number_batches(P.pending_pages(images, done, k), book_key=k)
    assert {(r.model, r.batch): r["count"] for r in left.groupBy("model", "batch").count().collect()} == {
        ("x/m1", 0): 8, ("x/m1", 1): 8, ("x/m1", 2): 2, ("x/m2", 0): 8, ("x/m2", 1): 8, ("x/m2", 2): 3}

    def setup():
        return lambda messages: [f" {len(messages)}\n" for _ in messages]

    rows = left.withColumn("messages", P.chat_messages(F.lit("u"), F.lit("p")))
    out = P.predict_batches(rows, setup=setup).collect()
    assert len(out) == 37 and {(r.model_slug, r.batch, r.md) for r in out} == {
        ("m1", 0, "8"), ("m1", 1, "8"), ("m1", 2, "2"), ("m2", 0, "8"), ("m2", 1, "8"), ("m2", 2, "3")}
    assert all(r.page.endswith(".md") for r in out)


def test_batches_are_runs_of_sorted_rows():
    import pandas as pd

    rows = pd.DataFrame({"model": ["m", "m", "m", None, None, "n"], "book": ["a", "a", None, None, None, None], "batch": [0, 0, 0, 0, 1, 1]})
    assert P.batch_ends(rows, ["model", "book", "batch"]) == [2, 3, 4, 5, 6]
    assert P.batch_ends(rows[1:2], ["model", "book", "batch"]) == [1]


def test_batches_that_arrow_cuts_stay_whole(spark):
    from folio.operators import predict

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "5")
    try:
        schema = "model string, lang string, book string, page string, pos bigint, batch bigint"
        rows = [(m, "it", b, f"page_{i:04d}.jpg", i + 1, i // 8) for m in ("x/m1", None) for b in ("b", None) for i in range(21)]
        made = spark.createDataFrame(rows, schema).withColumn("messages", P.chat_messages(F.col("page"), F.lit("p")))
        out = predict.predict_batches(made, model_fn=lambda ms: [f"{len(ms)} {i}" if i else None for i in range(len(ms))]).collect()
    finally:
        spark.conf.set(key, before)
    assert len(out) == len(rows)
    for r in out:
        i = int(r.page[5:9])
        assert r.md == (f"{(8, 8, 5)[i // 8]} {i % 8}" if i % 8 else "") and r.batch == i // 8


def test_prediction_sink(spark, tmp_path):
    p = spark.createDataFrame([("x/m1", "it", "b", "page_0001.md", "t")], PRED).withColumn("model_slug", P.model_slug("model"))
    P.write_predictions(p, str(tmp_path / "out"))
    assert [r.asDict() for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [p.first().asDict()]


def test_stream_scores_once(spark, tmp_path):
    refs = spark.createDataFrame([("it", "b", f"p{i}", f"text {i} a b c") for i in range(4)], REF)
    pred, out, ckpt = (str(tmp_path / x) for x in ("pred", "out", "ckpt"))

    def land(i):
        spark.createDataFrame([("m", "it", "b", f"p{i}", f"text {i} a b c")], PRED).write.mode("append").parquet(pred)

    def run(at):
        start_incremental_scores(spark, refs, pred, out, at).awaitTermination()
        return sorted((r.page, r.ned) for r in spark.read.parquet(out).collect())

    land(0)
    assert run(ckpt) == [("p0", 0.0)]
    land(1)
    assert run(ckpt) == [("p0", 0.0), ("p1", 0.0)]           # a restart scores what is new
    again = str(tmp_path / "lost")                             # a batch that is replayed replaces its own rows
    spark.read.parquet(out).count()
    start_incremental_scores(spark, refs, pred, out + "2", again).awaitTermination()
    start_incremental_scores(spark, refs, pred, out + "2", str(tmp_path / "lost2")).awaitTermination()
    assert spark.read.parquet(out + "2").count() == 2


def test_checkpoint_folder(spark, monkeypatch):
    assert session.ensure_checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")

    class Context:
        master, folder = "spark://host:7077", None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, path):
            self.folder = path

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Cluster:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Cluster())
    Cluster.sparkContext.folder = "hdfs://x/ckpt"
    assert session.ensure_checkpoint_dir(Cluster()) == "hdfs://x/ckpt"


def pair_texts(n):
    refs = [("it", "b", f"p{i}", f"# Title {i}\n\ntext {i} a b c d") for i in range(n)]
    preds = [(m, "it", "b", f"p{i}", f"# Title {i}\n\ntext {i} a {m} c d") for m in ("m1", "m2") for i in range(n)]
    return refs, preds


def stands(spark, out):
    return sorted(map(tuple, read_scores(spark, out).select("model", "lang", "book", "page", "ned", "similarity", "bleu", "struct_f1").collect()), key=str)


def batch(spark, refs, preds):
    rows = eval_scores(spark.createDataFrame(refs, REF), spark.createDataFrame(preds, PRED))
    return sorted(map(tuple, rows.select("model", "lang", "book", "page", "ned", "similarity", "bleu", "struct_f1").collect()), key=str)


@pytest.mark.parametrize("order", ["rrpp", "pprr", "prpr", "both"])
def test_any_order_of_arrival_gives_the_batch_result(spark, tmp_path, order):
    """The job is stopped and started again after each landing."""
    refs, preds = pair_texts(4)
    ref_dir, pred_dir, out, ckpt = (str(tmp_path / x) for x in ("ref", "pred", "out", "ckpt"))
    spark.createDataFrame([], REF).write.parquet(ref_dir)
    spark.createDataFrame([], PRED).write.parquet(pred_dir)
    halves = {"r": [refs[:2], refs[2:]], "p": [preds[::2], preds[1::2]]}
    for step in ["rp"] if order == "both" else order:
        for side in step:
            rows = sum(halves[side], []) if order == "both" else halves[side].pop(0)
            spark.createDataFrame(rows, REF if side == "r" else PRED).write.mode("append").parquet(ref_dir if side == "r" else pred_dir)
        start_scores(spark, ref_dir, pred_dir, out, ckpt).awaitTermination()
    assert stands(spark, out) == batch(spark, refs, preds)
    assert spark.read.parquet(out).count() == len(preds)       # each pair was scored once


def test_amended_and_repeated_halves(spark, tmp_path):
    refs, preds = pair_texts(3)
    ref_dir, pred_dir, out, ckpt = (str(tmp_path / x) for x in ("ref", "pred", "out", "ckpt"))
    spark.createDataFrame(refs[:2], REF).write.parquet(ref_dir)
    wrong = [(m, lang, b, p, "nothing like it") for m, lang, b, p, _ in preds[:2]]
    spark.createDataFrame(wrong + [(None, "it", "b", "p0", "x"), ("m1", "it", None, "p0", "x"), ("m1", "it", "b", "p0b", None)], PRED).write.parquet(pred_dir)

    def run():
        start_scores(spark, ref_dir, pred_dir, out, ckpt).awaitTermination()

    run()
    spark.createDataFrame(preds, PRED).write.mode("append").parquet(pred_dir)         # amends two, and p2 has no reference yet
    run()
    spark.createDataFrame(preds[:1], PRED).write.mode("append").parquet(pred_dir)     # the same again
    spark.createDataFrame(refs[2:], REF).write.mode("append").parquet(ref_dir)
    run()
    assert [r for r in stands(spark, out) if r[0]] == batch(spark, refs, preds)
    better = [("it", "b", "p1", preds[1][4])]                                          # an amended reference
    spark.createDataFrame(better, REF).write.mode("append").parquet(ref_dir)
    run()
    run()                                                                              # nothing new
    assert [r for r in stands(spark, out) if r[0]] == batch(spark, [refs[0], better[0], refs[2]], preds)


def test_reference_table_that_grows(spark, tmp_path):
    refs, preds = pair_texts(2)
    pred_dir, out, ckpt = (str(tmp_path / x) for x in ("pred", "out", "ckpt"))
    spark.createDataFrame(preds, PRED).write.parquet(pred_dir)
    for upto in (1, 2, 2):
        start_incremental_scores(spark, spark.createDataFrame(refs[:upto], REF), pred_dir, out, ckpt).awaitTermination()
        assert stands(spark, out) == batch(spark, refs[:upto], preds)
    assert spark.read.parquet(out).count() == len(preds)


def test_state_is_given_up_after_the_wait(spark, tmp_path):
    """Landing times of the rows' own: what waited longer than ``wait`` is dropped, what came in time is scored."""
    import datetime as dt

    refs, preds = pair_texts(4)
    ref_dir, pred_dir, out, ckpt = (str(tmp_path / x) for x in ("ref", "pred", "out", "ckpt"))
    t0 = dt.datetime(2024, 1, 1)

    def land(rows, schema, path, hours):
        spark.createDataFrame([(*r, t0 + dt.timedelta(hours=hours)) for r in rows], f"{schema}, landed timestamp").write.mode("append").parquet(path)

    def run():
        q = start_scores(spark, ref_dir, pred_dir, out, ckpt, at="landed", wait="2 hours")
        q.awaitTermination()
        return q

    land(preds[:1], PRED, pred_dir, 0)
    land(refs[1:2], REF, ref_dir, 0)
    run()
    land(refs[:1], REF, ref_dir, 1)                  # in time
    land(preds[2:3], PRED, pred_dir, 10)             # the watermark moves on ...
    land(refs[3:4], REF, ref_dir, 10)
    run()
    land(preds[1:2], PRED, pred_dir, 11)             # ... so the reference of 0 o'clock is gone for it
    land(refs[2:3], REF, ref_dir, 11)
    run()
    assert stands(spark, out) == batch(spark, [refs[0], refs[2]], [preds[0], preds[2]])
