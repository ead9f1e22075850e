"""HTML pages / archive members -> cleaned Markdown sections (see folio.functions.html)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions import clean as CL
from folio.functions import html as H
from folio.functions.text import posexplode_rows, py_strip
from folio.params import Params


def html_blocks(pages: DataFrame, keys=("page_id",), html: str = "html", drop_nav: bool = False) -> DataFrame:
    """One row per non-empty block: keys, pos, tag, cls, text."""
    k = list(keys)
    b = H.split_blocks(pages.select(*k, html), html, "blocks", drop_nav)
    rows = posexplode_rows(b, k, "blocks", "pos", "b")
    return rows.select(*k, F.col("pos").cast("bigint").alias("pos"), "b.tag", "b.cls", "b.text").filter("text <> ''")


def html_to_markdown(pages: DataFrame, keys=("page_id",), html: str = "html", params: Params = Params(),
                     drop_nav: bool = False, number_images_first: bool = False) -> DataFrame:
    """keys, md: promoted, rendered and cleaned Markdown of each page (before the length gate)."""
    k = list(keys)
    b = H.split_blocks(pages.select(*k, html), html, "_blocks", drop_nav)
    b = b.withColumn("_blocks", H.promote("_blocks", params.max_heading_words))
    md = b.select(*k, H.blocks_to_markdown("_blocks").alias("_raw"))
    return CL.clean_markdown(md, "_raw", "md", number_images_first).select(*k, "md")


def section_filter(sections: DataFrame, params: Params = Params(), md: str = "md") -> DataFrame:
    """Keep converted sections with at least ``min_section_chars`` after stripping."""
    return sections.filter(F.length(py_strip(md)) >= params.min_section_chars)
