"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

BATCH_ROWS, BATCH_BYTES, DEFAULT_BATCH = 2048, "8m", "67108864b"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "folio") -> SparkSession:
    """Session for tests and the bench (local mode). Cluster jobs bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FOLIO_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir``, else the folder the context
    already has. Only a local session without either gets a scratch folder of its own; on a cluster
    executors could not see it, so there this is an error."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="folio-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of page-sized texts: a worker's memory depends on the batch, not on its partition. Smaller
    settings of the session stay."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    if spark.conf.get(size, DEFAULT_BATCH) == DEFAULT_BATCH:
        spark.conf.set(size, BATCH_BYTES)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the queries in this block go as soon as their query ends. Else they stay on disk until the driver
    collects its garbage, beside the tables made of them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder, for tables written to cut lineage."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``folio`` importable in the Python workers (UDFs are pickled by reference):
    zip the package once per driver and add it with ``addPyFile``, which Spark
    distributes to every executor."""
    import os
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="folio-pkg-"), "folio.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)
