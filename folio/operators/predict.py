"""Prediction side: pending pages (resume), batches of 8, chat messages, model slot."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions.text import col, model_slug, py_strip
from folio.operators.prefix import running_sum
from folio.params import Params
from folio.session import bounded_batches

PAGE_KEY = ("lang", "book", "page")


def md_name(image_name) -> F.Column:
    """``page_0007.jpg`` -> ``page_0007.md``."""
    return F.regexp_replace(col(image_name), r"\.jpg$", ".md")


def pending_pages(images: DataFrame, done: DataFrame, book_key=("lang", "book")) -> DataFrame:
    """Images without an existing prediction file: anti-join on the .md name."""
    k = list(book_key)
    imgs = images.withColumn("md_page", md_name("page"))
    return imgs.join(done.select(*k, F.col("page").alias("md_page")), [*k, "md_page"], "left_anti")


def pending_counts(images: DataFrame, done: DataFrame, book_key=("lang", "book")) -> DataFrame:
    """Per book: total images, already predicted, still pending."""
    k = list(book_key)
    imgs = images.select(*k, md_name("page").alias("md_page"), F.lit(1).alias("img"))
    have = done.select(*k, F.col("page").alias("md_page"), F.lit(1).alias("has")).dropDuplicates([*k, "md_page"])
    j = imgs.join(have, [*k, "md_page"], "left")
    return j.groupBy(*k).agg(
        F.count("*").alias("n_total"),
        F.sum(F.when(F.col("has") == 1, 1).otherwise(0)).cast("bigint").alias("n_done"),
        F.sum(F.when(F.col("has").isNull(), 1).otherwise(0)).cast("bigint").alias("n_pending"))


def number_batches(pending: DataFrame, params: Params = Params(), book_key=("lang", "book"), prefix: int = 7) -> DataFrame:
    """Pending pages in name order per book, cut into batches of ``batch_size``.

    Adds ``pos`` (1-based order) and ``batch`` (0-based); a book's batch ids are
    independent of how the table is partitioned. Positions are counted inside of the first ``prefix``
    characters of the name (``page_00``: 100 pages) and over those, so a book is many tasks."""
    k = list(book_key)
    counted = running_sum(pending, k, F.substring("page", 1, prefix), ["page"], F.lit(1), "_before", "_total")
    return (counted.withColumn("pos", (F.col("_before") + 1).cast("bigint")).drop("_before", "_total")
            .withColumn("batch", F.floor((F.col("pos") - 1) / params.batch_size).cast("bigint")))


def data_url(content, mime: str = "image/jpeg") -> F.Column:
    """Base64 data URL of stored bytes (Spark's base64 wraps lines: the breaks are removed)."""
    return F.concat(F.lit(f"data:{mime};base64,"), F.regexp_replace(F.base64(col(content)), r"\s", ""))


def chat_messages(url, prompt) -> F.Column:
    """One user message: the image part, then the text prompt."""
    image_part = F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"),
                          F.struct(col(url).alias("url")).alias("image_url"))
    text_part = F.struct(F.lit("text").alias("type"), col(prompt).alias("text"),
                         F.lit(None).cast("struct<url:string>").alias("image_url"))
    return F.array(F.struct(F.lit("user").alias("role"), F.array(image_part, text_part).alias("content")))


def batch_ends(pdf, keys) -> list[int]:
    """Where the runs of equal keys end, in rows sorted by them. A null equals a null."""
    new = False
    for c in keys:
        value, before = pdf[c], pdf[c].shift()
        new |= ((value != before) & ~(value.isna() & before.isna())).to_numpy()
    return [*(i for i in new.nonzero()[0].tolist() if i), len(pdf)]


def predict_batches(batched: DataFrame, model_fn: Callable | None = None, model_id: str | None = None,
                    book_key=("lang", "book"), setup: Callable | None = None) -> DataFrame:
    """Run ``model_fn(list[messages_json]) -> list[str]`` once per batch of pages.

    Batches are dealt out by (model, book, batch) and arrive in page order; a task holds the
    batches of one bounded Arrow batch at a time. ``setup()`` makes the model function once per task (a loaded model).
    The output text is stripped and keyed like the input page (``.md`` name). Rows carry
    their ``model``, or all get ``model_id``."""
    import pandas as pd

    k = ["model", *book_key]
    bounded_batches(batched.sparkSession)
    rows = batched if model_id is None else batched.withColumn("model", F.lit(model_id))
    schema = ", ".join(f"{c} string" for c in k) + ", page string, batch bigint, md string"

    def run(frames):
        model = setup() if setup else model_fn

        def answers(pdf: pd.DataFrame, ends: list[int]) -> pd.DataFrame:
            # one call of the model a batch; the frame around the answers is made once for all of them
            res, messages, md, at = pdf[[*k, "page", "batch"]].copy(), pdf["messages"].tolist(), [], 0
            for end in ends:
                found = list(model(messages[at:end]))
                if len(found) != end - at:
                    raise ValueError(f"{len(found)} answers to a batch of {end - at} pages")
                md += [o if o is not None else "" for o in found]
                at = end
            res["page"] = res["page"].str.replace(r"\.jpg$", ".md", regex=True)
            res["md"] = md
            return res

        rest = None
        for pdf in frames:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if pdf.empty:
                continue
            ends = batch_ends(pdf, [*k, "batch"])
            if len(ends) > 1:
                yield answers(pdf[:ends[-2]], ends[:-1])
            rest = pdf[ends[-2]:] if len(ends) > 1 else pdf
        if rest is not None:
            yield answers(rest, [len(rest)])

    msgs = rows.select(*k, "page", "pos", "batch", F.to_json("messages").alias("messages"))
    out = msgs.repartition(*k, "batch").sortWithinPartitions(*k, "batch", "pos").mapInPandas(run, schema)
    return out.withColumn("md", py_strip("md")).withColumn("model_slug", model_slug("model"))


def write_predictions(preds: DataFrame, path: str) -> None:
    """Prediction sink: a table of (lang, book, page, md) partitioned by model, for any number of pages."""
    preds.write.mode("overwrite").partitionBy("model_slug").parquet(path)
