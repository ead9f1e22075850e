"""Reports that grow: mergeable summary state of scores, closing lines, and the report of a single pair.

A state row holds, for a group, the number of pages and each metric's count and exact decimal sum. States add up in
any order to the same digits, so a batch keeps its own (in a folder that a replay overwrites) and a report
reads the small states, never the scores again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.metrics import METRIC_META, score_pairs

GROUP = ("model", "lang", "book")
# Decimals of each reported average.
PLACES = {"ned": 4, "similarity": 4, "bleu": 2, "struct_f1": 4, "bert_f1": 4}
SUM = "decimal(38,12)"


def metrics_of(df: DataFrame) -> list[str]:
    names = ["ned", "similarity", *[m for m, *_ in METRIC_META if m != "ned"]]
    return [m for m in names if m in df.columns]


def summary_state(scores: DataFrame, group=GROUP) -> DataFrame:
    """group, n_pages, and per metric ``n_<m>`` (scored pages: not null) and ``sum_<m>`` (exact decimal)."""
    sums = [e for m in metrics_of(scores) for e in (F.count(m).alias(f"n_{m}"), F.coalesce(F.sum(F.col(m).cast("decimal(24,12)")), F.lit(0)).cast(SUM).alias(f"sum_{m}"))]
    return scores.groupBy(*group).agg(F.count("*").alias("n_pages"), *sums)


def merge_states(states: DataFrame, group=GROUP) -> DataFrame:
    """Several state rows a group (of batches, or of finer groups) as one."""
    rest = [c for c in states.columns if c == "n_pages" or c.startswith(("n_", "sum_"))]
    return states.groupBy(*group).agg(*[F.sum(c).cast(SUM if c.startswith("sum_") else "long").alias(c) for c in rest])


def report_of(states: DataFrame, group=GROUP) -> DataFrame:
    """group, n_pages and the averages, like ``evaluate.eval_summary``; null where a metric has no score."""
    names = [c[4:] for c in states.columns if c.startswith("sum_")]
    averages = [F.bround(F.try_divide(F.col(f"sum_{m}").cast("double"), F.col(f"n_{m}")), PLACES[m]).alias(f"avg_{m}") for m in names]
    return merge_states(states, group).select(*group, "n_pages", *averages)


def write_state(scores: DataFrame, path: str, batch_id: int, group=GROUP) -> None:
    """The state of one batch; a replayed batch replaces its own."""
    summary_state(scores, group).write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")


def report_lines(report: DataFrame, group=GROUP) -> DataFrame:
    """group, line: ``<n> pages; ned <avg>; ...``, one closing line a group."""
    parts = [F.concat(F.lit(f"{c[4:]} "), F.coalesce(F.format_number(c, PLACES[c[4:]]), F.lit("-"))) for c in report.columns if c.startswith("avg_")]
    return report.select(*group, F.concat_ws("; ", F.concat(F.col("n_pages").cast("string"), F.lit(" pages")), *parts).alias("line"))


def pair_report(pairs: DataFrame, keys, ref: str = "ref", hyp: str = "hyp") -> DataFrame:
    """The report of single pairs: keys, metric, value, higher_is_better, one row a metric in their fixed order (pos)."""
    scored = score_pairs(pairs, list(keys), ref, hyp)
    better = {m: hib for m, _, _, hib in METRIC_META} | {"similarity": True}
    rows = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(better[m]).alias("higher_is_better"))
                     for i, m in enumerate(metrics_of(scored))])
    return scored.select(*keys, F.explode_outer(rows).alias("r")).select(*keys, "r.*")
