"""Evaluation: match reference pages to predictions, score, report.

Pages are keyed by (lang, book, page); predictions add ``model``. The
reference/prediction join is on the page key; the pairs are then spread once for
the scoring, which works row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators.metrics import METRIC_META, composed, count_elements, score_pairs
from folio.operators.scorers import ranking_of, score_all, summary_of
from folio.session import bounded_batches

PAGE_KEY = ("lang", "book", "page")


def eval_pairs(refs: DataFrame, preds: DataFrame, page_key=PAGE_KEY) -> DataFrame:
    """Reference ⋈ prediction on the page key: model, page key, ref, hyp."""
    k = list(page_key)
    return refs.select(*k, F.col("md").alias("ref")).join(
        preds.select("model", *k, F.col("md").alias("hyp")), k).select("model", *k, "ref", "hyp")


def spread(pairs: DataFrame, keys) -> DataFrame:
    """Pairs over the session's number of shuffle partitions. Scoring is bound by CPU, not bytes;
    partitions that adaptive execution has joined by size would leave cores idle."""
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(n, *keys)


def missing_predictions(refs: DataFrame, preds: DataFrame, models, page_key=PAGE_KEY) -> DataFrame:
    """Reference pages a model has no prediction for (reported as skipped).

    ``models`` is the list of model ids to check. The models present per page are
    gathered once (a set bounded by the number of models), so this is one
    aggregation and one join on the page key; no pairing of pages with models.
    """
    k = list(page_key)
    present = preds.groupBy(*k).agg(F.collect_set("model").alias("_have"))
    wanted = F.array(*[F.lit(m) for m in models])
    lacking = F.array_except(wanted, F.coalesce(F.col("_have"), F.array().cast("array<string>")))
    return refs.select(*k).join(present, k, "left").select(
        F.explode_outer(lacking).alias("model"), *k).filter(F.col("model").isNotNull())


def eval_scores(refs: DataFrame, preds: DataFrame, page_key=PAGE_KEY, detail: bool = False, scorers=None) -> DataFrame:
    """Per (model, page): ned, similarity, bleu, struct_f1; with ``scorers`` (``scorers.Scorers``) a column each of them."""
    k = list(page_key)
    if scorers is not None:
        return score_all(spread(eval_pairs(refs, preds, k), ["model", *k]), ["model", *k], scorers)
    return score_pairs(spread(eval_pairs(refs, preds, k), ["model", *k]), ["model", *k], detail=detail)


def eval_elements(refs: DataFrame, preds: DataFrame, page_key=PAGE_KEY) -> DataFrame:
    """Element multisets of every (model, page), see ``metrics.element_table``. Both sides are composed and spread by the page key
    before they meet: every text moves once, and elements are made and counted where their pair is."""
    k = list(page_key)
    bounded_batches(refs.sparkSession)
    r = spread(refs.select(*k, composed("md").alias("_ref")), k)
    h = spread(preds.select("model", *k, composed("md").alias("_hyp")), k)
    return count_elements(r.join(h, k).select("model", *k, "_ref", "_hyp"), ["model", *k])


def eval_summary(scores: DataFrame, group=("model", "lang", "book"), scorers=None) -> DataFrame:
    """Count and mean scores per group (the batch report's closing lines), or each scorer's corpus score."""
    g = list(group)
    if scorers is not None:
        return summary_of(scores, scorers, g)
    return scores.groupBy(*g).agg(
        F.count("*").alias("n_pages"),
        F.bround(F.avg("ned"), 4).alias("avg_ned"),
        F.bround(F.avg("similarity"), 4).alias("avg_similarity"),
        F.bround(F.avg("bleu"), 2).alias("avg_bleu"),
        F.bround(F.avg("struct_f1"), 4).alias("avg_struct_f1"),
    )


def corpus_scores(scores: DataFrame, group=("model",)) -> DataFrame:
    """Corpus scores: mean of pair scores (NED/F1 to 4 places, BLEU to 2); no pair -> 0."""
    g = list(group)
    return scores.groupBy(*g).agg(
        F.count("*").alias("n_pairs"),
        F.coalesce(F.bround(F.avg("ned"), 4), F.lit(0.0)).alias("corpus_ned"),
        F.coalesce(F.bround(F.avg("bleu"), 2), F.lit(0.0)).alias("corpus_bleu"),
        F.coalesce(F.bround(F.avg("struct_f1"), 4), F.lit(0.0)).alias("corpus_struct_f1"),
    )


def model_ranking(scores: DataFrame, group=("lang",), scorers=None) -> DataFrame:
    """Per group and metric: models ranked best first, using each metric's (or scorer's) direction."""
    from pyspark.sql import Window

    g = list(group)
    if scorers is not None:
        return ranking_of(scores, scorers, g)
    metrics = [m for m, *_ in METRIC_META if m in scores.columns]
    means = scores.groupBy("model", *g).agg(*[F.avg(m).alias(m) for m in metrics])
    stacked = means.select("model", *g, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.bround(F.col(m), 6).alias("value"),
                 F.lit(hib).alias("higher_is_better")) for m, _, _, hib in METRIC_META if m in metrics
    ])).alias("s")).select("model", *g, "s.metric", "s.value", "s.higher_is_better")
    order = F.when(F.col("higher_is_better"), -F.col("value")).otherwise(F.col("value"))
    w = Window.partitionBy(*g, "metric").orderBy(order, F.col("model"))
    return stacked.withColumn("rank", F.row_number().over(w).cast("bigint"))
