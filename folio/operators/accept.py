"""Accept books in candidate order and stop once enough stand.

Judging a book is dear: its archive is opened, converted, split, sampled and gated. Only the
first N accepted books of a language are wanted, so candidates are judged in blocks of their
rank, each block ``growth`` times the one before; a language whose N books stand takes no part
in later blocks, whose books are then never read. The growing blocks bound the waste: at most
about ``growth`` times the books that one-by-one judging would open, in a number of rounds that is
logarithmic in them, and every round is one distributed job over all languages still open.

What is judged is written by round; only 'is a language open' reaches the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.operators.sample import first_accepted
from folio.params import Params
from folio.session import shared_path

MOST_BOOKS = 10_000


def accept_until(candidates: DataFrame, judge: Callable[[DataFrame], tuple[DataFrame, DataFrame]], params: Params = Params(),
                 first_block: int | None = None, growth: int = 2, lang: str = "lang", book: str = "book_id",
                 rank: str = "cand_rank") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(books, pages, rounds): the first ``n_books`` accepted books a language in candidate order with
    ``accept_pos``, their pages, and a row for each language and round with the first and last rank
    judged, how many books were, and how many stand by then.

    ``candidates`` has lang, book and rank (1, 2, ... a language; gaps may occur). ``judge`` gets the keys
    (lang, book, rank) of a block and returns its books (lang, book, accepted, ...) and the pages of
    accepted ones (lang, book, ...); it should read no other books (``sections_of``).
    Rows are those of judging everything. A candidate with a null language or rank is left out.
    Without any candidate, ``judge`` sees one empty block.
    """
    if growth < 1 or (first_block is not None and first_block < 1):
        raise ValueError("blocks need a size and a growth of at least 1")
    spark = candidates.sparkSession
    run = shared_path(spark, f"folio-accept-{uuid.uuid4().hex}")
    candidates.select(lang, book, F.col(rank).cast("long").alias(rank)).dropna(subset=[lang, rank]).write.parquet(f"{run}/candidates")
    candidates = spark.read.parquet(f"{run}/candidates")
    ends = candidates.groupBy(lang).agg(F.max(rank).alias("_last"))
    low, size, no = 0, first_block or 2 * params.n_books, 0
    open_langs = candidates.select(lang).distinct()
    while True:
        high = low + size
        block = candidates.filter((F.col(rank) > low) & (F.col(rank) <= high)).join(open_langs, lang, "left_semi")
        block.write.parquet(f"{run}/blocks/round={no}")
        block = spark.read.parquet(f"{run}/blocks/round={no}")
        books, pages = judge(block)
        # judging hands its keys on as columns: what it gives beyond the block is no result of this round
        books = books.drop(rank).join(block, [lang, book])
        books.write.mode("overwrite").parquet(f"{run}/books/round={no}")
        pages.write.mode("overwrite").parquet(f"{run}/pages/round={no}")
        judged = spark.read.parquet(f"{run}/books")
        stand = judged.filter("accepted").groupBy(lang).agg(F.count("*").alias("_n")).filter(F.col("_n") >= params.n_books)
        state = open_langs.join(stand, lang, "left_anti").join(ends.filter(F.col("_last") > high), lang, "left_semi")
        state.write.mode("overwrite").parquet(f"{run}/open/round={no}")
        open_langs = spark.read.parquet(f"{run}/open/round={no}")
        no, low, size = no + 1, high, size * growth
        if open_langs.isEmpty():
            break
    books = first_accepted(judged.drop("round"), params, lang, rank)
    pages = spark.read.parquet(f"{run}/pages").drop("round").join(books.select(lang, book), [lang, book], "left_semi")
    upto = Window.partitionBy(lang).orderBy("round")
    blocks = spark.read.parquet(f"{run}/blocks").groupBy(lang, "round").agg(F.min(rank).alias("first"), F.max(rank).alias("last"), F.count("*").alias("n_judged"))
    stand = judged.filter("accepted").groupBy(lang, "round").agg(F.count("*").alias("_n"))
    rounds = blocks.join(stand, [lang, "round"], "left").select(lang, "round", "first", "last", "n_judged",
                                                                F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("n_accepted"))
    return books, pages, rounds


def land_sections(sections: DataFrame, path: str, lang: str = "lang", book: str = "book_id") -> None:
    """Sections as a table with one folder a book, which ``sections_of`` opens one by one."""
    sections.write.partitionBy(lang, book).parquet(path)


def sections_of(spark: SparkSession, path: str, schema, keys: DataFrame, lang: str = "lang", book: str = "book_id") -> DataFrame:
    """The sections of the books in ``keys``. A block of up to MOST_BOOKS books becomes a filter on the folder names, so that
    no other folder is opened; a larger one is joined, and the folders are pruned at run time."""
    table = spark.read.schema(schema).parquet(path)
    some = keys.select(lang, book).distinct().limit(MOST_BOOKS + 1).collect()
    if len(some) > MOST_BOOKS:
        return table.join(keys.select(lang, book).distinct(), [lang, book], "left_semi")
    by_lang: dict = {}
    for k in some:
        by_lang.setdefault(k[0], []).append(k[1])
    wanted = F.lit(False)
    for name, names in by_lang.items():
        wanted = wanted | (F.col(lang).eqNullSafe(F.lit(name)) & F.col(book).isin(names))
    return table.filter(wanted)
