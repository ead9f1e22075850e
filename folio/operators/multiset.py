"""Multiset overlap of two sides, per group: the shared core of BLEU and structure F1.

Instead of a full outer join of the two sides, both sides go into one table
with a per-side count and one hash aggregation sums them (partial counts are
combined map-side); the clipped overlap of an item is ``least(ref, hyp)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def item_counts(items: DataFrame, group_keys, item: str = "token",
                ref: str = "r", hyp: str = "h") -> DataFrame:
    """``items`` holds one row per occurrence with 0/1 flags ``r`` and ``h``.
    Returns group keys, item, ref_cnt, hyp_cnt, overlap."""
    keys = list(group_keys)
    return (items.groupBy(*keys, item)
            .agg(F.sum(ref).cast("bigint").alias("ref_cnt"), F.sum(hyp).cast("bigint").alias("hyp_cnt"))
            .withColumn("overlap", F.least("ref_cnt", "hyp_cnt")))


def multiset_overlap(items: DataFrame, group_keys, item: str = "token",
                     ref: str = "r", hyp: str = "h") -> DataFrame:
    """Per group: size of each side and of their multiset intersection."""
    keys = list(group_keys)
    return (item_counts(items, keys, item, ref, hyp)
            .groupBy(*keys)
            .agg(F.sum("ref_cnt").cast("bigint").alias("ref_total"),
                 F.sum("hyp_cnt").cast("bigint").alias("hyp_total"),
                 F.sum("overlap").cast("bigint").alias("overlap")))
