"""Tables written to cut lineage leave nothing else on disk."""

import time

from pyspark.sql import functions as F

from folio.llm.common import written


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.length()) if files.apply(i).getName().startswith("shuffle_")}


def test_written_drops_its_shuffle_files_and_packs_densely(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = _shuffle_files(spark), spark.conf.get(key, "false")
    rows = spark.range(20000).groupBy((F.col("id") % 100).alias("k")).agg(F.count("*").alias("n"))
    out = written(rows, "test")
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(key, "false") == setting
    assert out.count() == 100 and out.agg(F.sum("n")).first()[0] == 20000
    assert all(".zstd." in f for f in out.inputFiles())
