"""File sources and sinks: page Markdown files, page images, dataset tree layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_KEY = ("lang", "book", "page")


def write_pages(pages: DataFrame, path: str, text: str = "md", keys=PAGE_KEY) -> None:
    """Page sink: a table of page keys and texts in one folder a language, for any number of pages."""
    pages.select(*keys, text).write.mode("overwrite").partitionBy("lang").parquet(path)


def read_pages(spark: SparkSession, path: str, keys=PAGE_KEY) -> DataFrame:
    """The table written by ``write_pages``: keys, md."""
    return spark.read.parquet(path).select(*[F.col(k).cast("string") for k in keys], "md")


def export_pages(pages: DataFrame, path: str, text: str = "md", keys=PAGE_KEY) -> None:
    """A small selection of pages (a sampled benchmark) as files: one folder per page key
    holding the page text (the text writer adds one newline after the value;
    ``read_md_files`` removes exactly that one)."""
    (pages.select(*keys, text).repartition(*keys)
     .write.mode("overwrite").partitionBy(*keys).text(path))


def read_md_files(spark: SparkSession, path: str, keys=PAGE_KEY) -> DataFrame:
    """Whole-file read of a page tree written by ``export_pages``: keys, md."""
    df = (spark.read.option("basePath", path).option("pathGlobFilter", "*.txt")
          .text(path, wholetext=True))
    return df.select(*[F.col(k).cast("string") for k in keys],
                     F.regexp_replace("value", r"\n\z", "").alias("md"))


def read_md_dir(spark: SparkSession, path: str) -> DataFrame:
    """``*.md`` files of a folder (reference or prediction dir): name, md."""
    df = spark.read.option("pathGlobFilter", "*.md").text(path, wholetext=True)
    return df.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1).alias("name"),
                     F.col("value").alias("md"))


def read_page_tree(spark: SparkSession, path: str) -> DataFrame:
    """Page files of a tree ``<lang>/<book>/pages/page_0007.md`` (references) or
    ``<lang>/<book>/page_0007.md`` (predictions): lang, book, page, md; other files are left out, and so
    are empty ones, which Spark's text reader skips (``sources.page_tree`` keeps them)."""
    df = spark.read.option("pathGlobFilter", "page_*.md").option("recursiveFileLookup", "true").text(path, wholetext=True)
    at = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rx = r"([^/]+)/([^/]+)/(?:pages/)?(page_[^/]+[.]md)$"
    rows = df.select(at.alias("_at"), F.col("value").alias("md"))
    return rows.select(*[F.regexp_extract("_at", rx, i + 1).alias(k) for i, k in enumerate(PAGE_KEY)], "md").filter("page <> ''")


def read_page_files(spark: SparkSession, path: str, with_content: bool = False) -> DataFrame:
    """``page_*.jpg`` images below ``path`` (listing only unless ``with_content``)."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", "page_*.jpg")
          .option("recursiveFileLookup", "true").load(path))
    cols = ["path", "length"] + (["content"] if with_content else [])
    return df.select(*cols)


def dataset_layout(files: DataFrame, path: str = "path") -> DataFrame:
    """``…/<lang>/<book>/pages/<page>`` -> lang, book, page (other paths dropped)."""
    rx = r"([^/]+)/([^/]+)/pages/([^/]+)$"
    return files.select(
        F.regexp_extract(path, rx, 1).alias("lang"), F.regexp_extract(path, rx, 2).alias("book"),
        F.regexp_extract(path, rx, 3).alias("page"), *[c for c in files.columns if c != path]
    ).filter(F.col("page") != "")
