"""EPUB archives: members of each archive as rows, then OPF manifest and spine."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from folio.functions.text import posexplode_rows

HTML_NAME = r"\.(html|xhtml|htm)$"
ENTRY_SCHEMA = "book_id string, entry_path string, content binary, error string"


def read_archives(spark: SparkSession, path: str, glob: str = "*.epub") -> DataFrame:
    """(path, content) of every archive below ``path`` (binaryFile source)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path).select("path", "content"))


def epub_entries(archives: DataFrame, book_id: str = "path", suffixes=None) -> DataFrame:
    """One row per archive member: book_id, entry_path, content. A broken archive gives
    one row with ``error`` set instead of failing the job. ``suffixes`` keeps only
    members with those endings (plus the container and package files)."""
    import io
    import zipfile

    keep = tuple(s.lower() for s in suffixes) if suffixes else None

    def unzip(batches):
        for pdf in batches:
            for bid, blob in zip(pdf[book_id], pdf["content"]):     # one archive's members at a time
                rows = []
                try:
                    with zipfile.ZipFile(io.BytesIO(blob)) as zf:
                        for name in zf.namelist():
                            if keep and not (name.lower().endswith(keep) or name.endswith((".opf", "container.xml"))):
                                continue
                            rows.append((str(bid), name, zf.read(name), None))
                except Exception as exc:  # noqa: BLE001 - reported per archive
                    rows.append((str(bid), None, None, f"{type(exc).__name__}: {exc}"))
                yield pd.DataFrame(rows, columns=["book_id", "entry_path", "content", "error"])

    return archives.select(book_id, "content").mapInPandas(unzip, ENTRY_SCHEMA)


def utf8_text(content) -> F.Column:
    """Bytes as text, invalid UTF-8 replaced (never fails)."""
    return F.make_valid_utf8(F.col(content).cast("string"))


def package_of(xml) -> tuple[list[str], list[str], list[str]]:
    """Ids and hrefs of the manifest items that have both, and the spine's idrefs."""
    import xml.etree.ElementTree as ET

    tags = [(e.tag.rsplit("}", 1)[-1], e.attrib) for e in ET.fromstring(xml).iter() if isinstance(e.tag, str)]
    items = [(a["id"], a["href"]) for t, a in tags if t == "item" and "id" in a and "href" in a]
    return [i for i, _ in items], [h for _, h in items], [a["idref"] for t, a in tags if t == "itemref" and "idref" in a]


def rootfile_of(xml) -> str | None:
    import xml.etree.ElementTree as ET

    return next((e.attrib["full-path"] for e in ET.fromstring(xml).iter()
                 if isinstance(e.tag, str) and e.tag.rsplit("}", 1)[-1] == "rootfile" and "full-path" in e.attrib), None)


def _or_none(fn, text):
    try:
        return fn(text.encode())
    except Exception:  # noqa: BLE001 - a malformed file is a book without a spine, not a failed job
        return None


@F.pandas_udf(StringType())
def _rootfile(txt: pd.Series) -> pd.Series:
    return txt.map(lambda x: _or_none(rootfile_of, x))


_PACKAGE = StructType([StructField(n, ArrayType(StringType())) for n in ("ids", "hrefs", "spine")])


@F.pandas_udf(_PACKAGE)
def _package(txt: pd.Series) -> pd.DataFrame:
    found = [_or_none(package_of, x) or ([], [], []) for x in txt]
    return pd.DataFrame({n: [f[k] for f in found] for k, n in enumerate(("ids", "hrefs", "spine"))})


def archive_spine(archives: DataFrame, book_id: str = "path") -> DataFrame:
    """Archive bytes to spine-ordered HTML members in one pass: book_id, spine_pos, idref,
    entry_path, html, error. Every archive is unzipped once and nothing is joined. A broken archive, container or
    package gives one row with ``error`` (a missing member is skipped, as in ``opf_spine``)."""
    import io
    import posixpath
    import re
    import zipfile

    cols = ["book_id", "spine_pos", "idref", "entry_path", "html", "error"]

    def run(batches):
        for pdf in batches:
            for bid, blob in zip(pdf[book_id], pdf["content"]):
                rows = []
                try:
                    with zipfile.ZipFile(io.BytesIO(blob)) as zf:
                        at = rootfile_of(zf.read("META-INF/container.xml"))
                        ids, hrefs, spine = package_of(zf.read(at))
                        manifest, there = dict(zip(ids, hrefs)), set(zf.namelist())
                        for pos, ref in enumerate(spine):
                            name = posixpath.join(posixpath.dirname(at), manifest.get(ref, ""))
                            if ref in manifest and re.search(HTML_NAME, name.lower()) and name in there:
                                rows.append((str(bid), pos, ref, name, zf.read(name).decode("utf-8", "replace"), None))
                except Exception as exc:  # noqa: BLE001 - reported per archive
                    rows = [(str(bid), None, None, None, None, f"{type(exc).__name__}: {exc}")]
                yield pd.DataFrame(rows, columns=cols).astype({"spine_pos": "Int64"})

    return archives.select(book_id, "content").mapInPandas(run, "book_id string, spine_pos bigint, idref string, entry_path string, html string, error string")


def opf_spine(entries: DataFrame) -> DataFrame:
    """Spine-ordered HTML members of each book: book_id, spine_pos, idref, entry_path, html.

    The container names the package file; manifest items need both id and href (a
    repeated id keeps its last href); a malformed container or package gives no rows; spine items without a manifest entry, non-HTML
    hrefs and missing members are skipped."""
    text = entries.filter(F.col("entry_path").isNotNull()).select("book_id", "entry_path", utf8_text("content").alias("txt"))
    root = text.filter(F.col("entry_path") == "META-INF/container.xml").select("book_id", _rootfile("txt").alias("opf_path")).filter("opf_path is not null")
    # the package file is no HTML member: those stay out of the join
    opf = text.filter(~F.lower("entry_path").rlike(HTML_NAME)).join(root, "book_id").filter(F.col("entry_path") == F.col("opf_path"))
    opf = opf.select("book_id", "opf_path", _package("txt").alias("p")).select("book_id", "opf_path", "p.*")
    items = posexplode_rows(opf.select("book_id", "opf_path", F.arrays_zip("ids", "hrefs").alias("z")),
                            ["book_id", "opf_path"], "z", "item_pos", "it") \
        .select("book_id", "opf_path", "item_pos", F.col("it.ids").alias("item_id"), F.col("it.hrefs").alias("href"))
    manifest = items.groupBy("book_id", "opf_path", "item_id").agg(F.max_by("href", "item_pos").alias("href"))
    spine = posexplode_rows(opf, ["book_id"], "spine", "spine_pos", "idref")
    opf_dir = F.regexp_extract("opf_path", r"^(.*)/[^/]*$", 1)
    j = (spine.join(manifest, (spine.book_id == manifest.book_id) & (spine.idref == manifest.item_id))
         .select(spine.book_id, "spine_pos", "idref", "href", "opf_path")
         .filter(F.lower("href").rlike(HTML_NAME))
         .withColumn("entry_path", F.when(opf_dir == "", F.col("href")).otherwise(F.concat_ws("/", opf_dir, "href"))))
    members = text.select("book_id", "entry_path", F.col("txt").alias("html"))
    return j.join(members, ["book_id", "entry_path"]).select(
        "book_id", F.col("spine_pos").cast("bigint").alias("spine_pos"), "idref", "entry_path", "html")
