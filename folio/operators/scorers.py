"""Scorers: one protocol for the built-in metrics and for those a user adds.

A scorer is a name, a Column of two texts (``score``), an aggregate over the scores of a group
(``corpus_score``), a direction and the decimals of reports. A registered scorer runs through ``score_all``,
``summary_of`` and ``ranking_of`` like the built-in ones, and is callable from SQL under its name if it was
registered with a session (``expose``).

The built-in scorers share their inputs (composed and normalised texts, element lists), so those that are
asked for are computed together by ``metrics.score_pairs``; further scorers are added on the pairs
in the same row. Nothing here adds an exchange except the closing aggregations.

Defined results: a null text is empty for the built-in scorers; a user scorer sees the texts as they are and may
return null, which counts as not scored (left out of averages and of ``n_<name>``, ranked last).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.functions.markdown import ELEMENT_TYPES
from folio.operators.metrics import METRIC_META, score_pairs
from folio.operators.report import PLACES

BUILT_IN = ("ned", "similarity", "bleu", "struct_f1")


def mean_of(column) -> Column:
    return F.try_divide(F.sum(F.col(column).cast("decimal(24,12)")).cast("double"), F.count(column))


@dataclass(frozen=True)
class Scorer:
    """``score(ref, hyp)`` gives a double Column; None marks a metric that ``score_pairs`` makes."""

    name: str
    higher_is_better: bool = True
    places: int = 4
    score: Callable[[Column, Column], Column] | None = None

    def corpus_score(self, column) -> Column:
        """The score of a group: the mean of its pairs (0 without any), to ``places`` decimals. Sums are exact
        decimals (12 places), so the order of the rows does not reach the last digit."""
        return F.coalesce(F.bround(mean_of(column), self.places), F.lit(0.0))


def built_in() -> dict[str, Scorer]:
    better = {m: hib for m, _, _, hib in METRIC_META} | {"similarity": True}
    return {m: Scorer(m, better[m], PLACES[m]) for m in BUILT_IN}


class Scorers:
    """An ordered set of scorers. A name is taken once; those of the result columns are refused."""

    def __init__(self, names=BUILT_IN):
        self.by_name = {m: built_in()[m] for m in names}

    def add(self, scorer: Scorer) -> Scorers:
        if scorer.name in self.by_name or scorer.name in BUILT_IN or scorer.name.startswith("f1_"):
            raise ValueError(f"a scorer named {scorer.name} exists already")
        if scorer.score is None:
            raise ValueError(f"scorer {scorer.name} has no score function")
        self.by_name[scorer.name] = scorer
        return self

    def __iter__(self):
        return iter(self.by_name.values())

    def added(self) -> list[Scorer]:
        return [s for s in self if s.score is not None]


def score_all(pairs: DataFrame, keys, scorers: Scorers, ref: str = "ref", hyp: str = "hyp") -> DataFrame:
    """keys and one column a scorer. Keys with the name of a scorer are refused."""
    keys = list(keys)
    clash = {s.name for s in scorers} & set(keys)
    if clash:
        raise ValueError(f"key columns {sorted(clash)} have the names of scorers")
    own = scorers.added()
    wanted = [s.name for s in scorers if s.score is None]
    # they ride through score_pairs as further key columns
    held = pairs.select(*keys, *[s.score(F.col(ref), F.col(hyp)).cast("double").alias(f"_own_{s.name}") for s in own],
                        F.col(ref).alias("_ref_md"), F.col(hyp).alias("_hyp_md"))
    if wanted:
        held = score_pairs(held, [*keys, *[f"_own_{s.name}" for s in own]], "_ref_md", "_hyp_md")
    return held.select(*keys, *[F.col(f"_own_{s.name}").alias(s.name) if s.score else F.col(s.name) for s in scorers])


def summary_of(scores: DataFrame, scorers: Scorers, group=("model", "lang", "book")) -> DataFrame:
    """group, n_pages and per scorer ``n_<name>`` (pairs it scored) and ``corpus_<name>``."""
    per = [c for s in scorers for c in (F.count(s.name).alias(f"n_{s.name}"), s.corpus_score(s.name).alias(f"corpus_{s.name}"))]
    return scores.groupBy(*group).agg(F.count("*").alias("n_pages"), *per)


def ranking_of(scores: DataFrame, scorers: Scorers, group=("lang",)) -> DataFrame:
    """Per group and scorer the models, best first by its direction; ties by model, unscored models last."""
    g = list(group)
    means = scores.groupBy("model", *g).agg(*[F.bround(mean_of(s.name), 6).alias(f"_m_{s.name}") for s in scorers])
    stacked = means.select("model", *g, F.inline_outer(F.array(*[
        F.struct(F.lit(s.name).alias("metric"), F.col(f"_m_{s.name}").alias("value"), F.lit(s.higher_is_better).alias("higher_is_better")) for s in scorers])))
    order = F.when(F.col("higher_is_better"), -F.col("value")).otherwise(F.col("value"))
    w = Window.partitionBy(*g, "metric").orderBy(order.asc_nulls_last(), "model")
    return stacked.withColumn("rank", F.row_number().over(w).cast("bigint"))


def type_report(scores: DataFrame, keys) -> DataFrame:
    """The element report in long form (keys, type, f1) from ``score_pairs(detail=True)``."""
    rows = F.array(*[F.struct(F.lit(t).alias("type"), F.col(f"f1_{t}").alias("f1")) for t in ELEMENT_TYPES])
    return scores.select(*keys, F.inline_outer(rows))


def expose(spark: SparkSession, name: str, body: str) -> str:
    """A scorer as an SQL function of (ref, hyp), by the SQL expression ``body``, for this session; returns its name.
    An SQL function is inlined by the optimizer, so a query that calls it stays compiled code."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(ref STRING, hyp STRING) RETURNS DOUBLE RETURN {body}")
    return name


def sql_scorer(name: str, higher_is_better: bool = True, places: int = 4) -> Scorer:
    """A scorer that calls the session's SQL function of that name."""
    return Scorer(name, higher_is_better, places, lambda r, h: F.call_function(name, r, h))
