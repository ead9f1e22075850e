"""Catalog pages of unknown shape: landed API pages read as VARIANT, field by field.

Each file holds one JSON value a line (or a file with ``whole_files``). A page is parsed once into a variant; every field is
taken with a tolerant cast, so an extra field changes nothing and a mistyped one loses only itself. What can't be
read becomes rows of ``landed_errors`` instead of an empty page, and the ``next`` links say which pages never landed.

Defined results: an unreadable line, a value that is no object and a page whose ``results`` is no list have no
books and one error row; a listed item that is no object has no book row and one error row; in a list field, entries of a wrong type
are left out; a page that landed twice (same text) is read once, pages of equal number and different text are all read; a blank line is no page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NUMBER = r"[?&]page=(\d+)"      # the page number in a ``next`` link


def landed_pages(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """file, value, v (variant; null if it is no JSON), page, next; one row for each different text of a file."""
    rows = spark.read.text(path, wholetext=whole_files).select(F.col("_metadata.file_path").alias("file"), "value")
    return pages_of(rows)


def pages_of(rows: DataFrame) -> DataFrame:
    """The same from rows (file, value)."""
    x = rows.filter(F.length(F.trim("value")) > 0).groupBy("value").agg(F.min("file").alias("file"))
    x = x.select("file", "value", F.try_parse_json("value").alias("v"))
    return x.select("file", "value", "v", F.try_variant_get("v", "$.page", "long").alias("page"), F.try_variant_get("v", "$.next", "string").alias("next"))


def _kind(v) -> F.Column:
    """Upper-case name of a variant's type: OBJECT<..>, ARRAY<..>, BIGINT, VOID, ..."""
    return F.schema_of_variant(v)


def _items(pages: DataFrame) -> DataFrame:
    listed = F.try_variant_get("v", "$.results", "array<variant>")
    return pages.select("file", "page", F.posexplode_outer(listed).alias("pos", "b")).filter(F.col("pos").isNotNull())


def _texts(v, path: str) -> F.Column:
    return F.filter(F.transform(F.try_variant_get(v, path, "array<variant>"), lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))),
                    lambda x: x.isNotNull())


def catalog_books(pages: DataFrame) -> DataFrame:
    """The rows of ``catalog.read_catalog``: page, pos, id, title, authors, languages, formats."""
    b = _items(pages).filter(F.startswith(_kind("b"), F.lit("OBJECT")))
    link = F.try_variant_get("b", "$.formats", "map<string,variant>")
    formats = F.transform_values(F.map_filter(link, lambda k, x: F.schema_of_variant(x) == "STRING"), lambda k, x: F.try_variant_get(x, "$", "string"))
    people = F.transform(F.try_variant_get("b", "$.authors", "array<variant>"),
                         lambda a: F.when(F.schema_of_variant(F.try_variant_get(a, "$.name", "variant")) == "STRING", F.struct(F.try_variant_get(a, "$.name", "string").alias("name"))))
    title = F.when(_kind(F.try_variant_get("b", "$.title", "variant")) == "STRING", F.try_variant_get("b", "$.title", "string"))
    return b.select("page", "pos", F.try_variant_get("b", "$.id", "long").alias("id"), title.alias("title"),
                    F.filter(people, lambda a: a.isNotNull()).alias("authors"), _texts("b", "$.languages").alias("languages"), formats.alias("formats"))


def landed_errors(pages: DataFrame) -> DataFrame:
    """file, page, pos, error: what could not be read (pos: the item, null for a page)."""
    listed = F.try_variant_get("v", "$.results", "variant")
    page_error = (F.when(F.col("v").isNull(), "no JSON").when(~F.startswith(_kind("v"), F.lit("OBJECT")), "no object")
                  .when(listed.isNull() | ~F.startswith(_kind(listed), F.lit("ARRAY")), "no results"))
    whole = pages.select("file", "page", F.lit(None).cast("int").alias("pos"), page_error.alias("error"))
    items = _items(pages).select("file", "page", "pos", F.when(F.startswith(_kind("b"), F.lit("OBJECT")), F.lit(None)).otherwise("no object").alias("error"))
    return whole.unionByName(items).filter("error is not null")


def missing_pages(pages: DataFrame) -> DataFrame:
    """page, next: the pages that a landed page names as its next and that did not land themselves."""
    named = pages.select(F.nullif(F.regexp_extract("next", NUMBER, 1), F.lit("")).try_cast("long").alias("page"), "next").filter("page is not null")
    here = pages.filter("page is not null").select("page").distinct()
    return named.groupBy("page").agg(F.min("next").alias("next")).join(here, "page", "left_anti")
