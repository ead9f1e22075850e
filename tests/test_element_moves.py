"""Elements are counted where their pair is: each text moves once, no element moves."""

import pytest

from folio.operators import evaluate as E
from folio.operators.metrics import element_table
from folio.operators.multiset import multiset_overlap
from pyspark.sql import functions as F

REF, PRED = "lang string, book string, page string, md string", "model string, lang string, book string, page string, md string"
PAIR = ["model", *E.PAGE_KEY]


@pytest.fixture
def inputs(spark):
    refs = [("en", "b", f"p{i}", f"# T{i}\n\n- é a\n- b\n- b\n\n> q{i % 3}") for i in range(40)]
    refs += [refs[3], ("en", "b", None, "# x"), (None, "b", "p1", "# y"), ("en", "c", "p1", None)]
    preds = [(m, "en", "b", f"p{i}", f"# t{i}\n\n- é a\n- b") for m in ("m1", "m2") for i in range(0, 40, 2 if m == "m1" else 1)]
    preds += [preds[5], ("m1", "en", "b", None, "# x"), (None, "en", "b", "p2", "- z"), ("m2", "en", "c", "p1", "> q")]
    return spark.createDataFrame(refs, REF), spark.createDataFrame(preds, PRED)


def test_elements_equal_those_of_the_pairs(inputs):
    refs, preds = inputs
    want = element_table(E.eval_pairs(refs, preds), PAIR)
    got = E.eval_elements(refs, preds)
    assert got.columns == want.columns and want.count() > 300
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_element_moves(spark, inputs):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        el = E.eval_elements(*inputs)
        items = el.select(*PAIR, "type", "token", F.when(F.col("side") == "ref", F.col("cnt")).otherwise(0).alias("r"),
                          F.when(F.col("side") == "hyp", F.col("cnt")).otherwise(0).alias("h"))
        for df in (el, multiset_overlap(items, PAIR + ["type"], "token")):
            plan = df._jdf.queryExecution().executedPlan().toString()
            moves = [x for x in plan.splitlines() if "Exchange" in x]
            assert len(moves) == 2 and all("(lang#" in x and "token" not in x for x in moves)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
