"""Running sums in an order, split over many tasks.

A window over all rows of a key is one task per key. Here rows are cut into ordered
buckets first: sums run inside (key, bucket), and a window only sees one row a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(df: DataFrame, keys, bucket: Column, order, value: Column, out: str, total: str) -> DataFrame:
    """df with ``out`` = sum of ``value`` over the rows before this one in its key, and
    ``total`` = its sum over the key. ``bucket`` must not decrease along ``order``.
    A null in a key or bucket is a value like any other (nulls come first in the order)."""
    k = list(keys)
    rows = df.withColumns({"_bucket": bucket, "_value": value})
    sums = rows.groupBy(*k, "_bucket").agg(F.sum("_value").alias("_sum"))
    along = Window.partitionBy(*k).orderBy("_bucket")
    sums = sums.select(*k, "_bucket", F.coalesce(F.sum("_sum").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_earlier_buckets"),
                       F.sum("_sum").over(Window.partitionBy(*k)).alias(total))
    inside = Window.partitionBy(*k, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    at = [*k, "_bucket"]
    same = [F.col(f"r.`{c}`").eqNullSafe(F.col(f"s.`{c}`")) for c in at]
    found = rows.alias("r").join(sums.alias("s"), same).select("r.*", F.col("s._earlier_buckets"), F.col(f"s.`{total}`"))
    return found.withColumn(out, F.col("_earlier_buckets") + F.col("_inside")).drop("_bucket", "_value", "_inside", "_earlier_buckets")
