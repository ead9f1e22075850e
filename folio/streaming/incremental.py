"""Incremental scoring: a page is scored once its reference and a prediction have both landed.

References and predictions are two file streams. They meet in a stream-stream join on the page
key, whose state keeps each side until the other comes: a prediction may land before its
reference, long after it, or in the same batch, and a job that is stopped goes on from its
checkpoint with the state it had. Work per batch grows with what has landed, not with all references.

An amended prediction (or reference) that lands later meets the other side again, so it is
scored again; ``read_scores`` takes for each model and page the pair of the latest landing. Landing
times are the files' modification times, or the column ``at`` names.

``wait`` bounds the state: a side that has waited so long is given up, rows that land later than
that behind the newest are too late. Without it nothing is ever given up; state then holds all
texts, on local disk of the executors (RocksDB) with its log in the checkpoint, not in their heap. The checkpoint gets what a
batch changed (not a copy of all state), densely packed, and keeps the last two batches' versions for a restart.

Each micro-batch is scored with the batch scorer into its own ``batch_id`` folder; a replayed batch
overwrites it, so nothing is scored twice. Rows with a null in the page key never meet, as in the batch join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.evaluate import PAGE_KEY, spread
from folio.operators.metrics import score_pairs
from folio.session import shuffles_dropped

REF_SCHEMA = "lang string, book string, page string, md string"
PRED_SCHEMA = "model string, lang string, book string, page string, md string"
# One RocksDB a partition for both sides (format 3; before, four): each takes some MB of local disk however little it holds.
# Those of a job that has stopped are closed by the next maintenance.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "64",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}


def _landed(spark: SparkSession, path: str, schema: str, side: str, at: str | None, wait: str | None) -> DataFrame:
    rows = spark.readStream.schema(schema if at is None else f"{schema}, {at} timestamp").parquet(path)
    time = F.col("_metadata.file_modification_time") if at is None else F.col(at)
    rows = rows.select(*[c for c in rows.columns if c != at], time.alias(f"{side}_at"))
    return rows if wait is None else rows.withWatermark(f"{side}_at", wait)


def paired_stream(spark: SparkSession, ref_dir: str, pred_dir: str, at: str | None = None, wait: str | None = None) -> DataFrame:
    """Streaming pairs: model, page key, ref, hyp, ref_at, pred_at; one row each time both halves are there."""
    k = list(PAGE_KEY)
    refs = _landed(spark, ref_dir, REF_SCHEMA, "ref", at, wait).withColumnRenamed("md", "ref").alias("r")
    preds = _landed(spark, pred_dir, PRED_SCHEMA, "pred", at, wait).withColumnRenamed("md", "hyp").alias("p")
    same = F.col(f"r.{k[0]}") == F.col(f"p.{k[0]}")
    for c in k[1:]:
        same = same & (F.col(f"r.{c}") == F.col(f"p.{c}"))
    if wait is not None:
        span = F.expr(f"INTERVAL {wait}")
        same = same & (F.col("pred_at") <= F.col("ref_at") + span) & (F.col("ref_at") <= F.col("pred_at") + span)
    return refs.join(preds, same).select("model", *[F.col(f"p.{c}").alias(c) for c in k], "ref", "hyp", "ref_at", "pred_at")


def start_scores(spark: SparkSession, ref_dir: str, pred_dir: str, out_dir: str, checkpoint: str, at: str | None = None,
                 wait: str | None = None, available_now: bool = True, processing_time: str | None = None):
    """Start the scoring of two folders of Parquet files; returns the StreamingQuery."""
    keys = ["model", *PAGE_KEY]
    pairs = paired_stream(spark, ref_dir, pred_dir, at, wait)

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        rows = latest(spread(batch, keys), ["ref", "hyp"])      # spread first: the latest of a page is picked where its rows are
        scored = score_pairs(rows, [*keys, "ref_at", "pred_at"])
        with shuffles_dropped(batch.sparkSession):
            scored.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        w = pairs.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
        return w.start()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def latest(rows: DataFrame, values: list[str], order=()) -> DataFrame:
    """For each model and page the values of the latest landing (prediction's time first, then the reference's;
    equal times: ``order``, then the greater values), by one aggregation without a sort of the texts."""
    keys = ["model", *PAGE_KEY]
    when = F.struct("pred_at", "ref_at", *order, *[F.xxhash64(v).alias(f"_h{i}") for i, v in enumerate(values)])
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct("ref_at", "pred_at", *values), when).alias("v"))
    return picked.select(*keys, "v.*")


def read_scores(spark: SparkSession, out_dir: str) -> DataFrame:
    """The scores that stand: model, page key, ned, similarity, bleu, struct_f1, ..., one row a model and page."""
    rows = spark.read.parquet(out_dir)
    values = [c for c in rows.columns if c not in ("model", *PAGE_KEY, "ref_at", "pred_at", "batch_id")]
    return latest(rows, values, ["batch_id"]).drop("ref_at", "pred_at")


def land_new(rows: DataFrame, path: str) -> None:
    """Append the rows whose page key or text isn't among those landed in ``path``."""
    spark = rows.sparkSession
    k = list(PAGE_KEY)
    rows = rows.select(*k, "md")
    if _has_files(spark, path):
        code = F.xxhash64("md")
        there = spark.read.schema(REF_SCHEMA).parquet(path).select(*k, code.alias("_h"))
        rows = rows.withColumn("_h", code).join(there, [*k, "_h"], "left_anti").drop("_h")
    rows.write.mode("append").option("compression", "zstd").parquet(path)


def _has_files(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def start_incremental_scores(spark: SparkSession, refs: DataFrame | str, pred_dir: str, out_dir: str,
                             checkpoint: str, available_now: bool = True, processing_time: str | None = None):
    """Like ``start_scores`` with the references as a folder or as a table. Of a table the rows that are
    new since the last start are landed beside the checkpoint, so that predictions which came before them
    get their scores. Each batch folder holds the pairs it completed; ``read_scores`` gives those that stand."""
    ref_dir = refs
    if isinstance(refs, DataFrame):
        ref_dir = f"{checkpoint.rstrip('/')}-references"
        land_new(refs, ref_dir)
    return start_scores(spark, ref_dir, pred_dir, out_dir, checkpoint, available_now=available_now, processing_time=processing_time)
