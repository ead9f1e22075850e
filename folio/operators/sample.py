"""Zones, seeded stratified sampling, book gates and first-N accepted books.

Windows here run on narrow key-only projections (book keys, chunk index,
zone, rank). The rank filter carries a literal bound, so Spark plans a
partial WindowGroupLimit before the shuffle: at most k rows per book and
zone leave each map task, even for a book that holds a large share of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.params import Params

ZONES = ("mandatory", "front", "body", "back")
ZONE_RANK = {z: i for i, z in enumerate(ZONES)}


def zone_of(idx, n, params: Params = Params()) -> Column:
    """Zone of chunk ``idx`` in a book of ``n`` chunks (0-based positions)."""
    idx, n = F.col(idx) if isinstance(idx, str) else idx, F.col(n) if isinstance(n, str) else n
    m = F.least(F.lit(params.n_front_mandatory), n)
    rest = n - m
    front_size = F.greatest(F.lit(params.strata_map["front"] + 1), F.floor(rest / 10))
    w = F.least(front_size, F.floor(rest / 3))
    return (F.when(idx < m, "mandatory").when(idx < m + w, "front")
            .when(idx < n - w, "body").otherwise("back"))


def zone_rank(zone) -> Column:
    z = F.col(zone) if isinstance(zone, str) else zone
    out = None
    for name, r in ZONE_RANK.items():
        out = (F.when(z == name, r) if out is None else out.when(z == name, r))
    return out


def assign_zones(chunks: DataFrame, params: Params = Params()) -> DataFrame:
    """Adds ``zone`` to rows carrying ``chunk_idx`` and ``n_chunks``."""
    return chunks.withColumn("zone", zone_of("chunk_idx", "n_chunks", params))


def sample_rank(seed: str, book_keys, idx="chunk_idx") -> Column:
    """Seeded random order: md5 of seed, book key and chunk index (stable under repartitioning)."""
    parts = [F.lit(seed)] + [F.col(k).cast("string") for k in book_keys] + [F.col(idx).cast("string")]
    return F.md5(F.concat_ws("|", *parts))


def stratified_sample(zoned: DataFrame, params: Params = Params(), book_keys=("book_id",)) -> DataFrame:
    """Keep all mandatory chunks and ``k`` seeded-random chunks of each other zone.

    Output: book keys, chunk_idx, zone, sample_pos (1-based order inside the zone).
    """
    keys = list(book_keys)
    k_of = F.when(F.col("zone") == "mandatory", F.lit(params.n_front_mandatory))
    for z, k in params.strata:
        k_of = k_of.when(F.col("zone") == z, F.lit(k))
    max_k = max([params.n_front_mandatory] + [k for _, k in params.strata])
    order = (F.when(F.col("zone") == "mandatory", F.lpad(F.col("chunk_idx").cast("string"), 20, "0"))
             .otherwise(sample_rank(params.seed, keys)))
    w = Window.partitionBy(*keys, "zone").orderBy(order, F.col("chunk_idx"))
    return (zoned.select(*keys, "chunk_idx", "zone")
            .withColumn("sample_pos", F.row_number().over(w))
            .filter((F.col("sample_pos") <= F.lit(max_k)) & (F.col("sample_pos") <= k_of))
            .withColumn("sample_pos", F.col("sample_pos").cast("bigint")))


def book_gate(chunks: DataFrame, rendered: DataFrame, params: Params = Params(),
              book_keys=("book_id",), min_chunks: int = 10) -> tuple[DataFrame, DataFrame]:
    """Gates of a book: enough chunks, then enough sampled pages that rendered.

    ``chunks`` carries book keys, chunk_idx, n_chunks; ``rendered`` book keys, chunk_idx.
    Returns (books, pages): one row per book with its counts and ``accepted``;
    the sampled-and-rendered pages of accepted books.
    """
    keys = list(book_keys)
    books = chunks.groupBy(*keys).agg(F.max("n_chunks").cast("bigint").alias("n_chunks"))
    eligible = chunks.filter(F.col("n_chunks") >= min_chunks)
    sampled = stratified_sample(assign_zones(eligible, params), params, keys)
    pages = sampled.join(rendered.select(*keys, "chunk_idx"), keys + ["chunk_idx"], "left_semi")
    counts = sampled.groupBy(*keys).agg(F.count("*").alias("n_sampled")).join(
        pages.groupBy(*keys).agg(F.count("*").alias("n_pages")), keys, "left")
    books = (books.join(counts, keys, "left")
             .select(*keys, "n_chunks",
                     F.coalesce("n_sampled", F.lit(0)).cast("bigint").alias("n_sampled"),
                     F.coalesce("n_pages", F.lit(0)).cast("bigint").alias("n_pages"))
             .withColumn("accepted", (F.col("n_chunks") >= min_chunks) & (F.col("n_pages") >= params.n_pages)))
    kept = pages.join(books.filter("accepted").select(*keys), keys, "left_semi")
    return books, kept


def first_accepted(books: DataFrame, params: Params = Params(), lang="lang", rank="cand_rank") -> DataFrame:
    """First ``n_books`` accepted books per language in candidate order."""
    w = Window.partitionBy(lang).orderBy(F.col(rank), F.col("book_id"))
    return (books.filter("accepted")
            .withColumn("accept_pos", F.row_number().over(w))
            .filter(F.col("accept_pos") <= F.lit(params.n_books))
            .withColumn("accept_pos", F.col("accept_pos").cast("bigint")))
