"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the output over its share of
the characters (a text counts one at least). Each document inverts the Poisson
distribution of that mean at a uniform number made of the MD5 of seed and doc_id,
so a rerun of a lost task gives the same counts; it is exploded by its count and
dealt out by an MD5 of seed, doc_id and copy. Means above ``part`` are summed from
several independent draws, so no rate is capped.

Defined results: null source is a source of its own; sources without a
target weight go (weight 0); null texts count one character; rows of equal doc_id
get equal counts; null ids draw as one id; an empty table stays empty; further
columns pass, ``copy`` (from 1) and ``shuffle_key`` are added or replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import cut, pack, prepare, unpack

TERMS = 100          # terms of a Poisson distribution of mean 16 or less: what is left is below 1e-40


def _uniform(text):
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def rates(docs: DataFrame, weights: dict | None = None, budget: float | None = None, source_col="source", text_col="text") -> DataFrame:
    """One row a source: _source, mean. Without weights all sources weigh the same;
    without a budget the output has as many characters as the input."""
    mass = F.greatest(F.coalesce(F.length(text_col), F.lit(0)), F.lit(1)).cast("long")
    stats = docs.groupBy(F.col(source_col).alias("_source")).agg(F.sum(mass).alias("mass"))
    if weights is None:
        stats = stats.withColumn("weight", F.lit(1.0))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "_name string, weight double")
        stats = stats.join(given, F.col("_source").eqNullSafe(F.col("_name")), "left").drop("_name").fillna(0.0, ["weight"])
    stats = cut(stats)                           # one row a source
    all_of = stats.agg(F.sum("mass").alias("mass"), F.sum("weight").alias("weight")).first()
    goal = float(budget) if budget is not None else float(all_of.mass or 0)
    share = F.col("weight") / F.lit(float(all_of.weight)) if all_of.weight else F.lit(0.0)
    return stats.select("_source", (share * F.lit(goal) / F.col("mass")).alias("mean"))


def mix(docs: DataFrame, weights: dict | None = None, budget: float | None = None, seed: int = 17,
        id_col="doc_id", source_col="source", text_col="text", part: float = 16.0, broadcast_sources: int = 10_000) -> DataFrame:
    """docs repeated to the target weights, in a global random order."""
    prepare(docs.sparkSession)
    facts = F.array(*[F.lit(float(math.factorial(k))) for k in range(TERMS)])
    r = rates(docs, weights, budget, source_col, text_col)
    r = r.withColumn("parts", F.greatest(F.ceil(F.col("mean") / part), F.lit(1)).cast("int")).withColumn("each", F.col("mean") / F.col("parts"))
    r = r.withColumn("pmf", F.transform(facts, lambda f, k: F.exp(-F.col("each")) * F.pow(F.col("each"), k) / f))
    r = r.withColumn("cdf", F.transform("pmf", lambda p, k: F.aggregate(F.slice("pmf", F.lit(1), k + 1), F.lit(0.0), lambda a, x: a + x))).select("_source", "parts", "cdf")
    r = cut(r)                                   # one row a source
    if r.count() <= broadcast_sources:           # else a join by source, whose hot keys Spark splits
        r = F.broadcast(r)
    name = F.col("_name")
    rows = pack(docs, _name=F.coalesce(F.col(id_col).cast("string"), F.lit("")), _from=F.col(source_col)).join(r, F.col("_from").eqNullSafe(F.col("_source")))
    draw = lambda j: F.size(F.filter("cdf", lambda c: c <= _uniform(F.concat(F.lit(f"{seed}:"), name, F.lit(":"), j.cast("string")))))
    one = rows.withColumn("_u", _uniform(F.concat(F.lit(f"{seed}:"), name, F.lit(":1"))))
    first = F.size(F.filter("cdf", lambda c: c <= F.col("_u")))
    more = F.aggregate(F.when(F.col("parts") > 1, F.sequence(F.lit(2), F.col("parts"))).otherwise(F.array().cast("array<int>")), F.lit(0), lambda a, j: a + draw(j))
    n = one.withColumn("_times", first + more).filter("_times > 0")
    copies = n.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times").cast("long"))))
    copies = copies.withColumn("_order", F.md5(F.concat(F.lit(f"{seed}#"), name, F.lit("#"), F.col("_copy").cast("string")).cast("binary")))
    out = copies.repartition("_order").sortWithinPartitions("_order")
    return unpack(out, docs.columns, copy=F.col("_copy"), shuffle_key=F.col("_order"))


def oracle_sql(seed: int = 17, table: str = "documents") -> str:
    """DuckDB twin of mix() with default parameters, for means up to 16."""
    u = f"(('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '') || ':1'), 1, 13))::BIGINT::DOUBLE + 0.5) / {1 << 52}.0"
    facts = ", ".join(repr(float(math.factorial(k))) for k in range(TERMS))
    return f"""WITH stats AS (SELECT source, sum(greatest(coalesce(length(text), 0), 1)) AS mass FROM {table} GROUP BY source),
means AS (SELECT source, (1.0::DOUBLE / (SELECT count(*)::DOUBLE FROM stats)) * (SELECT sum(mass)::DOUBLE FROM stats) / mass::DOUBLE AS mean FROM stats),
cdf AS (SELECT source, sum(exp(-mean) * pow(mean, k) / ([{facts}]::DOUBLE[])[k + 1]) OVER (PARTITION BY source ORDER BY k) AS c
        FROM means, (SELECT unnest(range({TERMS})) AS k)),
levels AS (SELECT source, list(c) AS cs FROM cdf GROUP BY source),
counted AS (SELECT d.*, len(list_filter(l.cs, lambda c: c <= {u})) AS times FROM {table} d JOIN levels l ON d.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, text, lang, source, n_chars, copy, md5('{seed}#' || coalesce(doc_id::VARCHAR, '') || '#' || copy::VARCHAR) AS shuffle_key
FROM (SELECT *, unnest(range(1, times + 1)) AS copy FROM counted WHERE times > 0)"""
