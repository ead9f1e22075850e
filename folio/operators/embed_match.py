"""Embedding match of pairs of any length: a tiled two-sided maximum.

Each token's best cosine on the other side needs all token pairs of a page pair, so a long pair is cut into
tiles: equal vectors of a side are one row with a count, the rows of a side are dealt by their hash to as many
tiles as ``tile`` rows each need, every (reference tile, prediction tile) is one row of a join and one matrix
product, and the partial maxima of a vector meet in a ``max`` aggregate. No group, task or row holds more than
two tiles; the tile numbers come from counts by (pair, bucket of the hash), so a pair that holds a third of all
tokens is spread as well.

Precision is the mean of the prediction's maxima, recall that of the reference's, F1 = 2PR/(P+R) rounded to 6.

Defined results: a null vector is no token; both sides empty 1.0 (only with ``pairs``), one side empty 0.0; a zero
vector is at cosine 0 to all; null keys are keys like any other; order and repeated rows do not matter beyond their count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 256


def _unit(rows: pa.ListArray) -> np.ndarray:
    m = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def _best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per tile pair the best cosine of every vector of both sides."""
    for b in batches:
        keys = b.column(b.schema.get_field_index("_id"))
        ref, hyp = (b.column(b.schema.get_field_index(c)) for c in ("_ref", "_hyp"))
        for i in range(b.num_rows):
            r, h = _unit(ref[i].values), _unit(hyp[i].values)
            sim = r @ h.T
            yield pa.RecordBatch.from_arrays([keys.slice(i, 1), *[pa.array([x], pa.list_(pa.float64())) for x in (sim.max(axis=1), sim.max(axis=0))]],
                                             ["_id", "best_ref", "best_hyp"])


def tiled_embedding_match(token_vec: DataFrame, pair_keys, side: str = "side", vec: str = "vec", pairs: DataFrame | None = None,
                          tile: int = 4096) -> DataFrame:
    """keys, n_ref, n_hyp, precision, recall, bert_f1; one row a pair (of ``pairs`` too, if given)."""
    keys = list(pair_keys)
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    ks = [f"_k{i}" for i in range(len(keys))]
    rows = token_vec.select(*named, (F.col(side) == "ref").alias("_is_ref"), F.col(vec).alias("_vec")).filter("_vec is not null")
    distinct = rows.groupBy(*ks, "_is_ref", "_vec").agg(F.count("*").alias("_n"))
    distinct = distinct.withColumn("_hash", F.xxhash64("_vec")).withColumn("_bucket", F.pmod("_hash", F.lit(BUCKETS)))

    # tokens and tiles of both sides, by pair and bucket; the window sees at most BUCKETS rows a pair
    per_bucket = distinct.groupBy(*ks, "_bucket").agg(*[F.count_if(F.col("_is_ref") == s).alias(f"_d_{n}") for n, s in (("ref", True), ("hyp", False))],
                                                      *[F.sum(F.when(F.col("_is_ref") == s, F.col("_n")).otherwise(0)).alias(f"_n_{n}") for n, s in (("ref", True), ("hyp", False))])
    w = Window.partitionBy(*ks)
    sizes = per_bucket.select(*ks, "_bucket", *[F.ceil(F.sum(f"_d_{n}").over(w) / tile).alias(f"_t_{n}") for n in ("ref", "hyp")])
    totals = per_bucket.groupBy(*ks).agg(F.sum("_n_ref").alias("n_ref"), F.sum("_n_hyp").alias("n_hyp"))

    def same(a, b, names):
        cond = F.lit(True)
        for k in names:
            cond = cond & a[k].eqNullSafe(b[k])
        return cond

    sized = distinct.alias("d").join(sizes.alias("s"), same(distinct, sizes, [*ks, "_bucket"])).select(
        *[F.col(f"d.{k}") for k in ks], "_is_ref", "_vec", "_n", "_hash", "_t_ref", "_t_hyp")
    own = F.when(F.col("_is_ref"), F.col("_t_ref")).otherwise(F.col("_t_hyp"))
    # the bucket's bits are spent, so tiles go by another hash of the vector
    tiles = sized.withColumn("_tile", F.pmod(F.xxhash64("_hash", F.lit(7)), own)).groupBy(*ks, "_is_ref", "_tile", "_t_ref", "_t_hyp").agg(
        F.sort_array(F.collect_list(F.struct("_vec", "_n"))).alias("_rows"))
    vecs, counts = F.col("_rows._vec"), F.col("_rows._n")

    def facing(is_ref: bool, mine: str, other: str) -> DataFrame:
        """The tiles of a side, each once for every tile of the other."""
        x = tiles.filter(F.col("_is_ref") == is_ref).filter(F.col(f"_t_{other}") > 0)
        span = F.sequence(F.lit(0).cast("long"), F.col(f"_t_{other}") - 1)
        return x.select(*ks, F.col("_tile").alias(f"_i_{mine}"), vecs.alias(f"_{mine}"), counts.alias(f"_c_{mine}"), F.explode_outer(span).alias(f"_i_{other}"))

    r, h = facing(True, "ref", "hyp"), facing(False, "hyp", "ref")
    met = r.join(h, same(r, h, [*ks, "_i_ref", "_i_hyp"])).select(
        F.struct(*[r[k] for k in ks], r["_i_ref"], r["_i_hyp"], "_c_ref", "_c_hyp").alias("_id"), "_ref", "_hyp")
    id_type = met.schema["_id"].dataType.simpleString()
    best = met.mapInArrow(_best, f"_id {id_type}, best_ref array<double>, best_hyp array<double>")
    def merged(n: str) -> F.Column:
        """Tile, place in the tile, best cosine and count of every vector of a side."""
        both = F.arrays_zip(F.col(f"best_{n}").alias("b"), F.col("_id")[f"_c_{n}"].alias("c"))
        return F.transform(both, lambda x, i: F.struct(F.lit(n == "ref").alias("_is_ref"), F.col("_id")[f"_i_{n}"].alias("_tile"),
                                                       i.alias("_at"), x["b"].alias("_b"), x["c"].alias("_c")))

    each = best.select(*[F.col("_id")[k].alias(k) for k in ks], F.inline_outer(F.concat(merged("ref"), merged("hyp"))))
    most = each.groupBy(*ks, "_is_ref", "_tile", "_at").agg(F.max("_b").alias("_b"), F.max("_c").alias("_c"))
    sums = most.groupBy(*ks).agg(*[F.sum(F.when(F.col("_is_ref") == s, F.col("_b") * F.col("_c"))).alias(f"_s_{n}") for n, s in (("ref", True), ("hyp", False))])
    if pairs is not None:
        asked = pairs.select(*named).distinct()
        totals = asked.join(totals, same(asked, totals, ks), "left").select(*[asked[k] for k in ks], "n_ref", "n_hyp")
    found = totals.join(sums, same(totals, sums, ks), "left").select(
        *[totals[k].alias(keys[i]) for i, k in enumerate(ks)], *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_ref", "n_hyp")],
        "_s_ref", "_s_hyp")
    none = (F.col("n_ref") == 0) & (F.col("n_hyp") == 0)

    def mean(total: str, n: str) -> F.Column:
        return F.when(none, 1.0).otherwise(F.coalesce(F.try_divide(F.col(total), F.col(n)), F.lit(0.0)))

    found = found.select(*keys, "n_ref", "n_hyp", mean("_s_hyp", "n_hyp").alias("precision"), mean("_s_ref", "n_ref").alias("recall"))
    p, q = F.col("precision"), F.col("recall")
    return found.withColumn("bert_f1", F.when(p + q == 0, 0.0).otherwise(F.bround(2 * p * q / (p + q), 6)))
