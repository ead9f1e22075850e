"""Catalog source: landed catalog API pages (JSON) -> candidate books per language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from folio.operators.prefix import running_sum
from pyspark.sql.types import (ArrayType, LongType, MapType, StringType, StructField, StructType)

# Accepted EPUB mime types, in order of preference.
EPUB_TYPES = ("application/epub+zip", "application/epub")

BOOK_RAW = StructType([
    StructField("id", LongType()),
    StructField("title", StringType()),
    StructField("authors", ArrayType(StructType([StructField("name", StringType())]))),
    StructField("languages", ArrayType(StringType())),
    StructField("formats", MapType(StringType(), StringType())),
])
API_PAGE = StructType([
    StructField("page", LongType()),
    StructField("next", StringType()),
    StructField("results", ArrayType(BOOK_RAW)),
])


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row per listed book: the API envelope (page, next, results) with a fixed schema."""
    pages = spark.read.schema(API_PAGE).json(path)
    return pages.select("page", F.posexplode_outer("results").alias("pos", "b")).filter(F.col("b").isNotNull()) \
                .select("page", "pos", "b.*")


def epub_url(formats) -> F.Column:
    return F.coalesce(*[F.col(formats)[t] for t in EPUB_TYPES])


def candidates(book_raw: DataFrame, seed: str = "42", per_page_cap: int | None = None, languages=None) -> DataFrame:
    """Candidate books per language: EPUB link present, author names projected, a book
    listed on several pages kept once (first listing), then a seeded random order.

    ``languages`` (codes) keeps only books listed in one of them. The random rank is
    counted in 256 buckets of the order, so a language is not one task.
    ``per_page_cap`` keeps only the first k link-bearing books of each API page.
    """
    x = (book_raw.select("id", "title", "authors", "formats", "page", "pos", F.explode_outer("languages").alias("lang"))
         .filter(F.col("lang").isNotNull())
         .withColumn("epub_url", epub_url("formats"))
         .filter(F.col("epub_url").isNotNull()))
    if languages is not None:
        x = x.filter(F.col("lang").isin(*languages))
    if per_page_cap:
        w = Window.partitionBy("lang", "page").orderBy("pos")
        x = x.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= per_page_cap).drop("_k")
    first = Window.partitionBy("lang", "id").orderBy("page", "pos")
    x = x.withColumn("_first", F.row_number().over(first)).filter("_first = 1").drop("_first")
    x = x.withColumn("_order", F.md5(F.concat_ws("|", F.lit(seed), F.col("id").cast("string"))))
    x = running_sum(x, ["lang"], F.substring("_order", 1, 2), ["_order", "id"], F.lit(1), "_before", "_total")
    return x.select(
        "lang", F.col("id").alias("book_id"), "title",
        F.transform(F.coalesce("authors", F.array().cast("array<struct<name:string>>")), lambda a: a["name"]).alias("authors"),
        "epub_url", (F.col("_before") + 1).cast("bigint").alias("cand_rank"))
