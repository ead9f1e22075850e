"""The corpus pipeline: five stages over documents, each written as Parquet and read
again by the next. ``run`` applies them; ORACLE_SQL is None, since SQL cannot
express the classifier and the fingerprints (tests hold the stages against brute force).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from folio.llm import decontaminate, line_dedup, mixing, quality, simhash  # noqa: E402
from folio.llm.common import written  # noqa: E402


def good_quality(spark, docs, sf_dir):
    """Documents that the weak-label classifier keeps."""
    return quality.classify(docs, filtered=True)


def unique_lines(spark, docs, sf_dir):
    """Documents without repeated multi-line chunks and passages of 50 words or more; every row stays."""
    return line_dedup.dedup_passages(docs, chunks=True).drop("n_removed")


def unique_documents(spark, docs, sf_dir):
    """One document of each SimHash component."""
    return simhash.drop_near_copies(docs, shingle=4, radius=4)


def clean_of_benchmark(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark, docs, sf_dir):
    """Documents repeated so that all sources weigh the same, in random order."""
    return mixing.mix(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("line_dedup", unique_lines),
    ("simhash_near_dedup", unique_documents),
    ("decontamination", clean_of_benchmark),
    ("mixing", mixed),
]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
