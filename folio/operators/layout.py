"""Storage layout for scoring many models: references and predictions in tables bucketed and sorted by the page key.

Both tables have the same number of buckets over the same keys, so a bucket of pages is joined in its place: scoring a
further model reads the references where they lie and moves none of their text. A model's predictions are a partition of
their own, so a replay replaces that model alone. Choose ``buckets`` so that a bucket of references fits a task
(total size / 128 MB is a start); it is fixed with the table, since another number would need an exchange.

Defined results: those of ``evaluate.eval_pairs`` and ``eval_scores`` (pages with a null in the key never meet, repeated keys meet in
all combinations); a model without predictions has no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.evaluate import PAGE_KEY
from folio.operators.metrics import score_pairs


def write_references(refs: DataFrame, table: str, path: str, buckets: int, page_key=PAGE_KEY) -> None:
    """The reference pages (page key, md) as a bucketed table below ``path``; replaces an earlier one."""
    # hash partitioning over the same keys puts a bucket into one task, so a bucket is one sorted file
    rows = refs.select(*page_key, "md").repartition(buckets, *page_key)
    rows.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, *page_key).sortBy(*page_key).saveAsTable(table)


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_predictions(preds: DataFrame, table: str, path: str, buckets: int, models, page_key=PAGE_KEY) -> None:
    """Predictions (model, page key, md) of the named models in the same buckets, a partition each. What the table held of
    these models is replaced (a replay changes nothing), other models stay; rows of other models in ``preds`` are not written."""
    spark = preds.sparkSession
    types = dict(preds.dtypes)
    keys = ", ".join(f"`{k}`" for k in page_key)
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{c}` {types[c]}" for c in (*page_key, "md"))
        spark.sql(f"CREATE TABLE {table} ({columns}, model STRING) USING parquet PARTITIONED BY (model) "
                  f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(buckets)} BUCKETS LOCATION {_literal(path)}")
    for model in models:
        rows = preds.filter(F.col("model") == model).select(*page_key, "md").repartition(buckets, *page_key)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (model = {_literal(model)}) SELECT * FROM {{rows}}", rows=rows)


def bucketed_pairs(spark: SparkSession, refs: str, preds: str, models=None, page_key=PAGE_KEY) -> DataFrame:
    """model, page key, ref, hyp from the two tables; with ``models`` only their partitions are read. The join merges the
    buckets; a broadcast would send reference text."""
    k = list(page_key)
    p = spark.table(preds)
    if models is not None:
        p = p.filter(F.col("model").isin(*models))
    r = spark.table(refs).select(*k, F.col("md").alias("ref"))
    return r.hint("merge").join(p.select(*k, "model", F.col("md").alias("hyp")), k).select("model", *k, "ref", "hyp")


def bucketed_scores(spark: SparkSession, refs: str, preds: str, models=None, page_key=PAGE_KEY, detail: bool = False) -> DataFrame:
    """The scores of ``evaluate.eval_scores``, each pair scored in its bucket's task: no exchange at all."""
    return score_pairs(bucketed_pairs(spark, refs, preds, models, page_key), ["model", *page_key], detail=detail)
