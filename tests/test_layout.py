"""References and predictions in buckets: same rows, and no exchange."""

import uuid

from folio.operators import evaluate as E
from folio.operators import layout as L

REF = "lang string, book string, page string, md string"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_join_in_place(spark, tmp_path):
    refs = spark.createDataFrame([("en", f"b{i % 7}", f"p{i}", f"# T{i}\nsome text {i}") for i in range(60)] + [("en", None, "x", "null key"), ("en", "b0", "p0", "again")], REF)
    preds = spark.createDataFrame([("a", "en", f"b{i % 7}", f"p{i}", f"# T{i}\nsome test {i}") for i in range(0, 60, 2)] + [("a", "en", None, "x", "null key")], "model string, " + REF)
    later = spark.createDataFrame([("b/it's", "en", f"b{i % 7}", f"p{i}", f"T{i}") for i in range(50)], "model string, " + REF)
    tag = uuid.uuid4().hex[:8]
    rt, pt = f"refs_{tag}", f"preds_{tag}"
    L.write_references(refs, rt, f"{tmp_path}/r", 5)
    L.write_predictions(preds, pt, f"{tmp_path}/p", 5, ["a"])
    L.write_predictions(later, pt, f"{tmp_path}/p", 5, ["b/it's"])   # a second model
    L.write_predictions(later, pt, f"{tmp_path}/p", 5, ["b/it's"])   # and its replay
    pairs = L.bucketed_pairs(spark, rt, pt)
    want = E.eval_pairs(refs, preds.unionByName(later))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, pairs.collect())) == sorted(map(key, want.collect()))
    second = L.bucketed_scores(spark, rt, pt, ["b/it's"])
    assert "Exchange" not in _plan(second) and "SortMergeJoin" in _plan(second)
    got = {(r.model, r.book, r.page, r.ned, r.struct_f1) for r in second.collect()}
    assert got == {(r.model, r.book, r.page, r.ned, r.struct_f1) for r in E.eval_scores(refs, later).collect()}
    assert L.bucketed_pairs(spark, rt, pt, ["none"]).count() == 0
    # a replaced model leaves the others
    L.write_predictions(later.limit(3), pt, f"{tmp_path}/p", 5, ["b/it's"])
    assert {r.model: r["count"] for r in spark.table(pt).groupBy("model").count().collect()} == {"a": 31, "b/it's": 3}
    for t in (rt, pt):
        spark.sql(f"DROP TABLE {t}")


def test_empty_tables(spark, tmp_path):
    tag = uuid.uuid4().hex[:8]
    L.write_references(spark.createDataFrame([], REF), f"r_{tag}", f"{tmp_path}/r", 3)
    L.write_predictions(spark.createDataFrame([], "model string, " + REF), f"p_{tag}", f"{tmp_path}/p", 3, ["a"])
    assert L.bucketed_scores(spark, f"r_{tag}", f"p_{tag}").count() == 0
