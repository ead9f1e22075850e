"""Inputs derived inside Spark from the driver tables (see FIXTURES.md).

Every derivation here has a twin SQL text in ``folio.plans.oracle`` so the
DuckDB check builds the same input independently.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from folio.functions.text import nfc
from folio.session import bounded_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, with_nfc: bool = True) -> DataFrame:
    df = table(spark, sf_dir, "documents")
    bounded_batches(spark)
    return df.withColumn("text", nfc("text")) if with_nfc else df


def book_id_col() -> F.Column:
    """Book key of the fixture: one book per (lang, source)."""
    return F.concat_ws("_", "lang", "source")


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX1: one section per document; its lines become paragraphs."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        "lang", book_id_col().alias("book_id"),
        F.col("doc_id").alias("section_pos"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("section_id"),
        F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("md"),
    )


def rich_line(line, i) -> F.Column:
    """FX3: give line i a Markdown form chosen by i mod 9."""
    s = i.cast("string")
    k = i % 9
    return (
        F.when(k == 0, F.concat(F.lit("## "), line))
        .when(k == 1, F.concat(F.lit("- "), line))
        .when(k == 2, F.concat(F.lit("> "), line))
        .when(k == 3, F.concat(F.lit("**"), line, F.lit("** [^"), s, F.lit("]")))
        .when(k == 4, F.concat(F.lit("*"), line, F.lit("*")))
        .when(k == 5, F.concat(F.lit("$x_"), s, F.lit("$ "), line))
        .when(k == 6, F.concat(F.lit("![pic "), s, F.lit("](images/"), s, F.lit(".png) "), line))
        .when(k == 7, F.concat(F.lit("[p. "), s, F.lit("] "), line))
        .otherwise(line)
    )


def rich_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX3 sections: Markdown-rich lines, separated by blank lines."""
    d = table(spark, sf_dir, "documents")
    md = F.array_join(F.transform(F.split("text", "\n"), lambda x, i: rich_line(x, i)), "\n\n")
    return d.select(
        "lang", book_id_col().alias("book_id"),
        F.col("doc_id").alias("section_pos"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("section_id"),
        md.alias("md"),
    )


# FX13: how line i (its letters and spaces, x) is written, by i mod 17.
BLOCK_FORMS = ("{x}\n===", "> {x}", "{x}", "> {x}", "", "- {x}", "  - {x}", "  {x}", "", "  {x}", "1. {x}", "{x}", "", "{x}", "{x}\n---", "> {x}", "# {x}")


def block_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX13: every document as lines with setext headings, quotes with lazy lines and nested items."""
    d = table(spark, sf_dir, "documents")

    def written(line, i):
        x = F.concat(F.lit("w "), F.btrim(F.regexp_replace(line, "[^A-Za-z ]", "")))
        out = None
        for k, form in enumerate(BLOCK_FORMS):
            head, mark, tail = form.partition("{x}")
            v = F.concat(F.lit(head), x, F.lit(tail)) if mark else F.lit(form)
            out = F.when(i % len(BLOCK_FORMS) == k, v) if out is None else out.when(i % len(BLOCK_FORMS) == k, v)
        return out

    return d.select("doc_id", F.array_join(F.transform(F.split("text", "\n"), written), "\n").alias("md"))


MODEL_A = "acme-lab/pager-1"
MODEL_B = "north/pager-2"


def predict_a(md) -> F.Column:
    """FX4 first model: drop every 5th line (i mod 5 = 4), 'tion' -> 't1on'."""
    kept = F.filter(F.split(md, "\n"), lambda x, i: i % 5 != 4)
    return F.replace(F.array_join(kept, "\n"), F.lit("tion"), F.lit("t1on"))


def predict_b(md) -> F.Column:
    """FX4 second model: 'an' -> 'en'."""
    return F.replace(md, F.lit("an"), F.lit("en"))


def nfd(md) -> F.Column:
    """Accents as separate code points (Arrow-batched)."""
    return _nfd(F.col(md))


@F.pandas_udf(StringType())
def _nfd(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None else unicodedata.normalize("NFD", x))


def books(spark: SparkSession, sf_dir: str, seed: str = "42") -> DataFrame:
    """Candidate books: one per (lang, source); candidate order is a seeded random rank (FX12)."""
    from pyspark.sql import Window

    d = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(
        F.min_by(F.split("text", "\n")[0], F.col("doc_id")).alias("title"))
    rank = F.md5(F.concat_ws("|", F.lit(seed), book_id_col()))
    return d.select(
        "lang", book_id_col().alias("book_id"),
        "title",
        F.array(F.concat(F.lit("Author "), F.col("source"))).alias("authors"),
        F.row_number().over(Window.partitionBy("lang").orderBy(rank)).cast("bigint").alias("cand_rank"),
    )


def rendered(spark: SparkSession, sf_dir: str, chunks: DataFrame, keys=("book_id",)) -> DataFrame:
    """Pages whose image exists: every chunk except those of documents labelled toxic and low quality."""
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1 AND quality = 0").select(F.col("doc_id").alias("section_pos"))
    return chunks.join(toxic, "section_pos", "left_anti").select(*keys, "chunk_idx")


def ref_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference pages: the chunks of the Markdown-rich sections, named like page files."""
    from folio.functions.text import page_name
    from folio.operators.chunk import index_chunks

    ch = index_chunks(rich_sections(spark, sf_dir),
                      book_keys=("lang", "book_id"))
    return ch.select("lang", F.col("book_id").alias("book"), page_name("chunk_idx", "md").alias("page"),
                     "section_pos", "chunk_idx", "md")


def predictions(spark: SparkSession, sf_dir: str, refs: DataFrame) -> DataFrame:
    """Two models' predictions; the first has none for pages of documents in ``labels``."""
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("section_pos"))
    a = refs.join(labelled, "section_pos", "left_anti").select(
        F.lit(MODEL_A).alias("model"), "lang", "book", "page", predict_a("md").alias("md"))
    b = refs.select(F.lit(MODEL_B).alias("model"), "lang", "book", "page", predict_b("md").alias("md"))
    return a.unionByName(b)


def raw_line(x, i) -> F.Column:
    """FX5: wrap line i in converter noise chosen by i mod 12."""
    k = i % 12
    L = F.lit
    return (F.when(k == 0, F.concat(L("["), x, L("]{.c}")))
            .when(k == 1, F.concat(L("[]{#a}"), x))
            .when(k == 2, F.concat(L("["), x, L("](#a)")))
            .when(k == 3, F.concat(L("["), x, L("](b.xhtml)")))
            .when(k == 4, F.concat(L("["), x, L("](https://h/)")))
            .when(k == 5, F.concat(x, L("^[[3]](n.html#f)^")))
            .when(k == 6, F.concat(x, L("[[4]](n.html)")))
            .when(k == 7, F.concat(x, L("^5^")))
            .when(k == 8, F.concat(L("::: d\n"), x))
            .when(k == 9, F.concat(L("| "), x))
            .when(k == 10, F.concat(x, L(" \\[pg!7\\]")))
            .otherwise(F.concat(L("<span>"), x, L("</span> ![fig](img/a.png) ![](img/b.png)"))))


def raw_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX5: converter-style Markdown per document, with a YAML block in front."""
    d = table(spark, sf_dir, "documents")
    body = F.array_join(F.transform(F.split("text", "\n"), lambda x, i: raw_line(x, i)), "\n")
    return d.select("doc_id", F.concat(F.lit("---\ntitle: t\n---\n"), body).alias("md"))


# Classes given to successive <p> tags of the classed pages (FX9).
HEADING_CLASSES = ("title", "chapter", "section", "paragraph", "h4", "calibre")


def classed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX9: the k-th <p> of each page gets class HEADING_CLASSES[k mod 6]."""
    p = table(spark, sf_dir, "pages")
    classes = F.array(*[F.lit(c) for c in HEADING_CLASSES])
    parts = F.split("html", "<p>", -1)
    html = F.array_join(F.transform(parts, lambda s, i: F.when(i == 0, s).otherwise(
        F.concat(F.lit('<p class="'), F.element_at(classes, ((i - 1) % 6) + 1), F.lit('">'), s))), "")
    return p.select("page_id", "url", html.alias("html"))


def catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX7: catalog rows, one book per (lang, source); id = its first doc_id; formats by
    id mod 3 (epub+zip / epub / html only); 8 books per API page in id order, and
    every book with id mod 5 = 0 listed again on the following page."""
    from pyspark.sql import Window

    d = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(
        F.min("doc_id").alias("id"), F.min_by(F.split("text", "\n")[0], F.col("doc_id")).alias("t"))
    url = F.concat(F.lit("https://books.example/"), F.col("id").cast("string"))
    fmts = (F.when(F.col("id") % 3 == 0, F.create_map(F.lit("application/epub+zip"), F.concat(url, F.lit(".epub")),
                                                       F.lit("text/html"), F.concat(url, F.lit(".html"))))
            .when(F.col("id") % 3 == 1, F.create_map(F.lit("application/epub"), F.concat(url, F.lit(".epub3")),
                                                      F.lit("text/html"), F.concat(url, F.lit(".html"))))
            .otherwise(F.create_map(F.lit("text/html"), F.concat(url, F.lit(".html")))))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("id")) - 1
    b = d.select("id", F.col("t").alias("title"),
                 F.array(F.struct(F.concat(F.lit("Author "), F.col("source")).alias("name"))).alias("authors"),
                 F.array("lang").alias("languages"), fmts.alias("formats"),
                 (F.floor(rank / 8) + 1).cast("bigint").alias("page"), (rank % 8).cast("bigint").alias("pos"))
    again = b.filter(F.col("id") % 5 == 0).withColumn("page", F.col("page") + 1).withColumn("pos", F.col("pos") + 100)
    return b.unionByName(again)


CONTAINER_XML = ('<?xml version="1.0"?><container version="1.0" '
                 'xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles>'
                 '<rootfile full-path="OEBPS/content.opf" media-type="application/oebps-package+xml"/>'
                 '</rootfiles></container>')


def epub_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX6: a book per 10 consecutive pages; manifest item ``i<page>`` (href ``.css`` when
    page_id mod 7 = 0, none when mod 11 = 0), spine in descending page order, member
    files for every page except page_id mod 13 = 0. Rows: book_id, entry_path, text."""
    p = table(spark, sf_dir, "pages").withColumn("book_id", F.concat(F.lit("b"), F.floor(F.col("page_id") / 10).cast("string")))
    pid = F.col("page_id").cast("string")
    item = (F.when(F.col("page_id") % 11 == 0, F.concat(F.lit('<item id="i'), pid, F.lit('" media-type="text/html"/>')))
            .otherwise(F.concat(F.lit('<item id="i'), pid, F.lit('" href="p'), pid,
                                F.when(F.col("page_id") % 7 == 0, F.lit(".css")).otherwise(F.lit(".xhtml")),
                                F.lit('" media-type="application/xhtml+xml"/>'))))
    per_book = p.groupBy("book_id").agg(F.collect_list(F.struct("page_id", item.alias("item"))).alias("xs"))
    asc = F.array_sort("xs")
    opf = F.concat(
        F.lit('<?xml version="1.0"?><package xmlns="http://www.idpf.org/2007/opf" version="3.0"><manifest>'),
        F.array_join(F.transform(asc, lambda x: x["item"]), ""), F.lit("</manifest><spine>"),
        F.array_join(F.transform(F.reverse(asc), lambda x: F.concat(F.lit('<itemref idref="i'),
                                                                    x["page_id"].cast("string"), F.lit('"/>'))), ""),
        F.lit("</spine></package>"))
    books = per_book.select("book_id", opf.alias("opf"))
    meta = books.select("book_id", F.lit("META-INF/container.xml").alias("entry_path"), F.lit(CONTAINER_XML).alias("text")) \
        .unionByName(books.select("book_id", F.lit("OEBPS/content.opf").alias("entry_path"), F.col("opf").alias("text")))
    members = p.filter(F.col("page_id") % 13 != 0).select(
        "book_id", F.concat(F.lit("OEBPS/p"), pid, F.lit(".xhtml")).alias("entry_path"), F.col("html").alias("text"))
    return meta.unionByName(members)


def epub_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The FX6 parts zipped into one EPUB archive per book: (path, content)."""
    import io
    import zipfile

    import pandas as pd

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("mimetype", "application/epub+zip")
            for name, text in sorted(zip(pdf["entry_path"], pdf["text"])):
                zf.writestr(name, text)
        return pd.DataFrame({"path": [pdf["book_id"].iloc[0]], "content": [buf.getvalue()]})

    return epub_parts(spark, sf_dir).groupBy("book_id").applyInPandas(pack, "path string, content binary")
