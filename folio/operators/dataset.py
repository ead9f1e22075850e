"""Dataset assembly: full-book Markdown, page records, nested metadata, sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions.text import page_name, title_slug
from folio.operators.sample import zone_rank

BOOK_SEPARATOR = "\n\n---\n\n"


def full_book_parts(sections: DataFrame, book_keys=("book_id",)) -> DataFrame:
    """The full-book Markdown as ordered parts: part i is the separator (except for the
    first section) followed by the section text. Concatenating a book's parts in
    ``section_pos`` order gives the book file; no book is ever held in one value."""
    keys = list(book_keys)
    firsts = sections.groupBy(*keys).agg(F.min("section_pos").alias("first_pos"))
    return sections.select(*keys, "section_pos", "md").join(firsts, keys).select(
        *keys, "section_pos",
        F.when(F.col("section_pos") == F.col("first_pos"), F.col("md"))
         .otherwise(F.concat(F.lit(BOOK_SEPARATOR), F.col("md"))).alias("part"),
    )


def write_full_books(sections: DataFrame, path: str, book_keys=("book_id",), num_partitions: int | None = None) -> None:
    """Write ``<path>/<book key>=.../part-*.txt``; reading a book folder's files in name
    order and concatenating them yields the book (sections joined by the separator).
    The text writer ends every row with a newline, so each row carries the separator
    minus that newline, and the last section drops its own final newline. Range
    partitioning spreads one large book over several tasks instead of one."""
    keys = list(book_keys)
    lasts = sections.groupBy(*keys).agg(F.max("section_pos").alias("_last"))
    rows = sections.join(lasts, keys).select(
        *keys, "section_pos",
        F.when(F.col("section_pos") == F.col("_last"), F.regexp_replace("md", r"\n\z", ""))
         .otherwise(F.concat("md", F.lit(BOOK_SEPARATOR[:-1]))).alias("part"))
    ordered = rows.repartitionByRange(num_partitions, *keys, "section_pos") if num_partitions \
        else rows.repartitionByRange(*keys, "section_pos")
    (ordered.sortWithinPartitions(*keys, "section_pos").select(*keys, "part")
     .write.mode("overwrite").partitionBy(*keys).text(path))


def book_dir(book_id, title) -> F.Column:
    return F.concat(F.col(book_id).cast("string"), F.lit("_"), title_slug(title))


def page_records(pages: DataFrame, books: DataFrame) -> DataFrame:
    """Sampled, rendered pages of accepted books with their file paths.

    ``pages``: book_id, chunk_idx, zone, sample_pos; ``books``: lang, book_id, title.
    """
    b = books.select("lang", "book_id", "title", book_dir("book_id", "title").alias("dir"))
    base = F.concat_ws("/", "lang", "dir", F.lit("pages"))
    return pages.join(b, "book_id").select(
        "lang", "book_id", "title",
        F.col("chunk_idx").alias("page_idx"), "zone", "sample_pos",
        F.concat_ws("/", base, page_name("chunk_idx", "jpg")).alias("img_path"),
        F.concat_ws("/", base, page_name("chunk_idx", "md")).alias("md_path"),
    )


def book_metadata(records: DataFrame, books: DataFrame) -> DataFrame:
    """One row per accepted book with its pages nested in zone order, then sample order.
    A book holds at most ``n_pages`` pages, so the nested array is bounded."""
    page = F.struct(zone_rank("zone").alias("zr"), F.col("sample_pos").alias("sp"),
                    F.col("page_idx").cast("int").alias("page_idx"), "zone", "img_path", "md_path")
    nested = records.groupBy("lang", "book_id").agg(F.array_sort(F.collect_list(page)).alias("p"))
    pages = F.transform("p", lambda x: F.struct(x["page_idx"].alias("page_idx"), x["zone"].alias("zone"),
                                               x["img_path"].alias("img_path"), x["md_path"].alias("md_path")))
    return nested.join(books.select("book_id", "title", "authors"), "book_id").select(
        "lang", "book_id", "title", "authors", pages.alias("pages"))


def language_metadata(book_meta: DataFrame) -> DataFrame:
    """Per language: its accepted books (at most ``n_books`` each), as nested rows."""
    book = F.struct(F.col("book_id").alias("id"), "title", "authors", "pages")
    return book_meta.groupBy("lang").agg(F.array_sort(F.collect_list(book)).alias("books"))


def write_metadata(lang_meta: DataFrame, path: str) -> None:
    """JSON sink, one folder per language; non-ASCII is written as is."""
    lang_meta.write.mode("overwrite").partitionBy("lang").json(path)


BOOKS_SCHEMA = "array<struct<id:string,title:string,authors:array<string>,pages:array<struct<page_idx:int,zone:string,img_path:string,md_path:string>>>>"


def global_metadata(lang_meta: DataFrame, languages=()) -> DataFrame:
    """One row, ``value``: the whole dataset's metadata as a JSON object, language -> its books, in the order of the names.
    ``languages`` without an accepted book get an empty list. Bounded: languages x ``n_books`` x ``n_pages``."""
    spark = lang_meta.sparkSession
    rows = lang_meta.select(F.col("lang").cast("string").alias("lang"), F.to_json("books").alias("j")).filter("lang IS NOT NULL")
    named = spark.range(1).select(F.explode_outer(F.lit(list(languages)).cast("array<string>")).alias("lang")).filter("lang IS NOT NULL")
    rows = rows.unionByName(named.join(rows.select("lang"), "lang", "left_anti").select("lang", F.lit("[]").alias("j")))
    # a name as a JSON string: the one element of an array, without its brackets
    name = F.regexp_replace(F.to_json(F.array("lang")), r"^\[|\]$", "")
    entry = F.concat(name, F.lit(": "), F.col("j"))
    parts = rows.agg(F.array_sort(F.collect_list(F.struct("lang", entry.alias("e")))).alias("p"))
    return parts.select(F.concat(F.lit("{"), F.array_join(F.transform("p", lambda x: x["e"]), ",\n"), F.lit("}")).alias("value"))


def write_global_metadata(lang_meta: DataFrame, path: str, languages=()) -> None:
    """The global file beside those of the languages, in a folder of its own."""
    global_metadata(lang_meta, languages).coalesce(1).write.mode("overwrite").text(path)


def read_global_metadata(spark, path: str) -> DataFrame:
    """lang, books of the file written by ``write_global_metadata``."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode_outer(F.from_json("value", f"map<string,{BOOKS_SCHEMA}>")).alias("lang", "books")).filter("lang IS NOT NULL")
