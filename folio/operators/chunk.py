"""Split book sections into page-sized chunks and number them per book.

All splitting happens in-row with higher-order functions (no shuffle). Chunk
numbering needs the chunk count of every earlier section of the book; that is
computed on a narrow (book, section, count) table and joined back on a row
number, so a very large book never lands in one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import col, posexplode_rows, py_strip
from folio.operators.prefix import running_sum
from folio.params import Params
from folio.session import shared_path

# A page marker "[p. N]" starts a new piece; the marker stays with its piece.
MARKER_SPLIT = r"(?U)(?=\[p\. \d+\])"


def paragraphs(md) -> Column:
    """Blank-line separated paragraphs, stripped, empty ones dropped."""
    return F.filter(F.transform(F.split(col(md), r"\n{2,}"), py_strip), lambda p: p != "")


def pack_ends(paras, limit: int) -> Column:
    """Greedy packing, pass 1: indices of the paragraphs that close a block. A block
    closes when the summed length of its paragraphs (separators not counted) reaches
    ``limit``. The accumulator only grows at block ends."""
    init = F.struct(
        F.array().cast("array<int>").alias("ends"),
        F.lit(0).cast("long").alias("run"),
        F.lit(0).alias("i"),
    )

    def step(acc, p):
        run = acc["run"] + F.length(p)
        closes = run >= F.lit(limit)
        return F.struct(
            F.when(closes, F.array_append(acc["ends"], acc["i"])).otherwise(acc["ends"]).alias("ends"),
            F.when(closes, F.lit(0).cast("long")).otherwise(run).alias("run"),
            (acc["i"] + 1).alias("i"),
        )

    return F.aggregate(col(paras), init, step)["ends"]


def pack_blocks(paras, ends, min_chars: int) -> Column:
    """Greedy packing, pass 2: blocks joined by a blank line, each ending with a newline;
    the unfilled tail is kept only with ``min_chars`` characters.

    ``paras`` and ``ends`` must be column references (materialised by an earlier
    projection): lambdas re-evaluate any expression they mention once per element.
    """
    paras, ends = col(paras), col(ends)

    def block(e, j):
        start = F.when(j == 0, F.lit(0)).otherwise(F.element_at(ends, j) + 1)  # 0-based
        return F.concat(F.array_join(F.slice(paras, start + 1, e - start + 1), "\n\n"), F.lit("\n"))

    full = F.transform(ends, block)
    tail_start = F.when(F.size(ends) == 0, F.lit(0)).otherwise(F.element_at(ends, -1) + 1)
    tail_len = F.size(paras) - tail_start
    tail = F.array_join(F.slice(paras, tail_start + 1, F.greatest(tail_len, F.lit(1))), "\n\n")
    keep_tail = (tail_len > 0) & (F.length(tail) >= F.lit(min_chars))
    return F.when(keep_tail, F.array_append(full, F.concat(tail, F.lit("\n")))).otherwise(full)


def with_packed(df: DataFrame, md: str, out: str, limit: int, min_chars: int) -> DataFrame:
    """Adds ``out``: the greedy paragraph blocks of column ``md``."""
    return (df.withColumn("_paras", paragraphs(py_strip(md)))
              .withColumn("_ends", pack_ends("_paras", limit))
              .withColumn(out, pack_blocks("_paras", "_ends", min_chars))
              .drop("_paras", "_ends"))


def split_markers(md, min_chars: int) -> Column:
    """Pieces between page markers that keep ``min_chars`` after stripping, each + newline."""
    pieces = F.transform(F.split(py_strip(md), MARKER_SPLIT), py_strip)
    return F.transform(F.filter(pieces, lambda p: F.length(p) >= F.lit(min_chars)),
                       lambda p: F.concat(p, F.lit("\n")))


def with_pieces(df: DataFrame, md: str = "md", out: str = "pieces", params: Params = Params()) -> DataFrame:
    """Adds ``out``: the chunks of one section - marker pieces if at least two survive,
    else packed paragraphs of the whole section."""
    staged = with_packed(df.withColumn("_bym", split_markers(md, params.min_md_chars)),
                         md, "_packed", params.page_chars, params.min_md_chars)
    return (staged.withColumn(out, F.when(F.size("_bym") >= 2, F.col("_bym")).otherwise(F.col("_packed")))
                  .drop("_bym", "_packed"))


def split_sections(sections: DataFrame, params: Params = Params(), book_keys=("book_id",)) -> DataFrame:
    """Section rows -> one row per piece (book keys, section_pos, piece_pos, section_id, md).

    Sections shorter than ``min_md_chars`` after stripping are skipped.
    """
    keys = list(book_keys)
    kept = sections.filter(F.length(py_strip("md")) >= params.min_md_chars)
    pieces = with_pieces(kept.select(*keys, "section_pos", "section_id", "md"), "md", "pieces", params)
    return posexplode_rows(pieces, [*keys, "section_pos", "section_id"], "pieces", "piece_pos", "md")


def index_chunks(sections: DataFrame, params: Params = Params(), book_keys=("book_id",), stride: int = 256) -> DataFrame:
    """Split sections and give every chunk its 0-based position in the book.

    Output: book keys, section_pos, piece_pos, chunk_idx, n_chunks, section_id, md.

    Sections are split once, into a table in the shared checkpoint folder, where each gets a row number
    of its own. The positions come from its piece counts alone: sums run over ``stride`` section numbers at a
    time, so a long book is many tasks; the texts move once, to meet their offsets by row number.
    Sections of one position follow each other by id and text; a null book or position is a value like any other.
    """
    keys = list(book_keys)
    spark = sections.sparkSession
    kept = with_pieces(sections.filter(F.length(py_strip("md")) >= params.min_md_chars)
                       .select(*keys, "section_pos", "section_id", "md"), "md", "pieces", params).drop("md")
    path = shared_path(spark, f"folio-pieces-{uuid.uuid4().hex}")
    kept.withColumns({"n_pieces": F.size("pieces"), "_text": F.xxhash64("pieces"), "_row": F.monotonically_increasing_id()}).write.option("compression", "zstd").parquet(path)
    kept = spark.read.parquet(path)
    counts = kept.select(*keys, "section_pos", "section_id", "_text", "_row", "n_pieces")
    offsets = running_sum(counts, keys, F.floor(F.col("section_pos") / stride), ["section_pos", "section_id", "_text", "_row"],
                          F.col("n_pieces"), "offset", "n_chunks")
    joined = kept.drop("n_pieces", "_text").join(offsets.select("_row", "offset", "n_chunks"), "_row")
    return posexplode_rows(joined, [*keys, "section_pos", "section_id", "offset", "n_chunks"],
                           "pieces", "piece_pos", "md").select(
        *keys, "section_pos", "piece_pos",
        (F.col("offset") + F.col("piece_pos")).cast("bigint").alias("chunk_idx"),
        F.col("n_chunks").cast("bigint").alias("n_chunks"),
        "section_id", "md",
    )
