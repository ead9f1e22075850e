import io
import os
import tempfile
import zipfile

from pyspark.sql import functions as F

from folio.functions.clean import clean_markdown
from folio.sources import epub as EP
from folio.sources import files as FS


def test_clean_rules_literals(spark):
    raw = ("---\ntitle: x\n---\n::: div\n### [T](#r){.a}\n[span]{.c} []{#a} [in](#x) x^[[3]](n.html#f)^ "
           "y[[4]](n.html) z^5^ [rel](b.xhtml) [web](https://h/) | line\n<b>t</b> \\[pg!7\\] \\* ![a](https://i/x.png)\n\n\n\nend")
    got = clean_markdown(spark.createDataFrame([(raw,)], "md string")).first().clean
    assert got.startswith("### T\nspan  in x[^3] y[^4] z[^5] rel [web](https://h/)")
    assert "[p. 7]" in got and "* ![image_1](images/image_1.png)" in got and "\n\n\nend" not in got
    assert got.endswith("end\n")


def test_epub_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="folio-epub-")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("META-INF/container.xml", '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container">'
                    '<rootfiles><rootfile full-path="content.opf"/></rootfiles></container>')
        zf.writestr("content.opf", '<package xmlns="http://www.idpf.org/2007/opf"><manifest>'
                    '<item id="a" href="a.xhtml"/><item id="b" href="b.html"/><item id="b" href="b2.html"/>'
                    '<item id="c" href="c.css"/><item id="d"/></manifest><spine><itemref idref="b"/>'
                    '<itemref idref="a"/><itemref idref="c"/><itemref idref="x"/><itemref idref="d"/></spine></package>')
        zf.writestr("a.xhtml", "<p>A</p>")
        zf.writestr("b2.html", "<p>B</p>")
    with open(os.path.join(d, "book.epub"), "wb") as f:
        f.write(buf.getvalue())
    with open(os.path.join(d, "broken.epub"), "wb") as f:
        f.write(b"not a zip")
    entries = EP.epub_entries(EP.read_archives(spark, d))
    assert entries.filter("error IS NOT NULL").count() == 1
    spine = [(r.spine_pos, r.idref, r.entry_path) for r in EP.opf_spine(entries).orderBy("spine_pos").collect()]
    assert spine == [(0, "b", "b2.html"), (1, "a", "a.xhtml")]


def test_page_tree_and_layout(spark):
    d = tempfile.mkdtemp(prefix="folio-pages-")
    pages = spark.createDataFrame([("it", "1_x", "page_0001.md", "# a\n"), ("de", "2_y", "page_0002.md", "b")],
                                  "lang string, book string, page string, md string")
    FS.export_pages(pages, d)
    back = sorted(tuple(r) for r in FS.read_md_files(spark, d).collect())
    assert back == sorted(tuple(r) for r in pages.collect())
    img = os.path.join(d, "ds", "it", "1_x", "pages")
    os.makedirs(img)
    with open(os.path.join(img, "page_0001.jpg"), "wb") as f:
        f.write(b"\xff\xd8jpg")
    lay = FS.dataset_layout(FS.read_page_files(spark, os.path.join(d, "ds"))).collect()
    assert [(r.lang, r.book, r.page) for r in lay] == [("it", "1_x", "page_0001.jpg")]


def test_full_book_files_and_metadata_sink(spark):
    from folio.operators import dataset as D
    d = tempfile.mkdtemp(prefix="folio-books-")
    secs = spark.createDataFrame([("b1", 2, "second\n"), ("b1", 1, "first\n"), ("b1", 3, "third\n"), ("b2", 5, "only\n")],
                                 "book_id string, section_pos long, md string")
    D.write_full_books(secs, os.path.join(d, "books"), num_partitions=3)
    for book, want in (("b1", "first\n\n\n---\n\nsecond\n\n\n---\n\nthird\n"), ("b2", "only\n")):
        folder = os.path.join(d, "books", f"book_id={book}")
        text = "".join(open(os.path.join(folder, f)).read() for f in sorted(os.listdir(folder)) if f.endswith(".txt"))
        assert text == want
    parts = sorted((r.section_pos, r.part) for r in D.full_book_parts(secs).filter("book_id = 'b1'").collect())
    assert "".join(p for _, p in parts) == "first\n\n\n---\n\nsecond\n\n\n---\n\nthird\n"
    meta = spark.createDataFrame([("it", "b1", "T", ["A"], [(0, "mandatory", "x.jpg", "x.md")])],
                                 "lang string, book_id string, title string, authors array<string>, "
                                 "pages array<struct<page_idx:int,zone:string,img_path:string,md_path:string>>")
    D.write_metadata(D.language_metadata(meta), os.path.join(d, "meta"))
    back = spark.read.json(os.path.join(d, "meta")).collect()
    assert back[0].lang == "it" and back[0].books[0].id == "b1"


def test_page_table_and_tree(spark, tmp_path):
    pages = spark.createDataFrame([("it", "b_1", "page_0001.md", "a\n\nb"), ("de", "b 2", "page_0002.md", "")], "lang string, book string, page string, md string")
    FS.write_pages(pages, str(tmp_path / "t"))
    assert sorted(map(tuple, FS.read_pages(spark, str(tmp_path / "t")).collect())) == sorted(map(tuple, pages.collect()))
    for where, text in (("refs/it/b 1+x/pages/page_0001.md", "one\n"), ("refs/it/b 1+x/book.md", "no"), ("preds/de/b/page_0003.md", "two")):
        f = tmp_path / where
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(text)
    assert list(map(tuple, FS.read_page_tree(spark, str(tmp_path / "refs")).collect())) == [("it", "b 1+x", "page_0001.md", "one\n")]
    assert list(map(tuple, FS.read_page_tree(spark, str(tmp_path / "preds")).collect())) == [("de", "b", "page_0003.md", "two")]


def test_broken_books_do_not_fail_the_job(spark):
    import io
    import zipfile

    box = '<container><rootfiles><rootfile full-path="c.opf"/></rootfiles></container>'
    opf = '<package><manifest><item id="a" href="a.html"/></manifest><spine><itemref idref="a"/><itemref idref="x"/></spine></package>'

    def book(**files):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            for name, text in files.items():
                z.writestr({"box": "META-INF/container.xml", "opf": "c.opf", "a": "a.html"}[name], text)
        return buf.getvalue()

    books = [("good", book(box=box, opf=opf, a="<p>x")), ("cut opf", book(box=box, opf=opf[:60], a="<p>x")), ("cut box", book(box=box[:20], opf=opf)),
             ("no zip", b"nothing"), ("no opf", book(box=box)), ("no member", book(box=box, opf=opf))]
    df = spark.createDataFrame(books, "path string, content binary")
    rows = EP.archive_spine(df).collect()
    assert [(r.book_id, r.spine_pos, r.html) for r in rows if r.error is None] == [("good", 0, "<p>x")]
    assert {r.book_id for r in rows if r.error} == {"cut opf", "cut box", "no zip", "no opf"}
    assert [r.book_id for r in EP.opf_spine(EP.epub_entries(df)).collect()] == ["good"]


def test_running_sum_over_buckets(spark):
    from folio.operators.prefix import running_sum

    df = spark.range(0, 1000).select((F.col("id") % 2).alias("k"), "id", (F.col("id") % 7).alias("v"))
    got = {(r.k, r.id): (r.before, r.total) for r in running_sum(df, ["k"], F.floor(F.col("id") / 10), ["id"], F.col("v"), "before", "total").collect()}
    for k in (0, 1):
        ids = range(k, 1000, 2)
        run, total = 0, sum(i % 7 for i in ids)
        for i in ids:
            assert got[k, i] == (run, total)
            run += i % 7


def test_global_metadata(spark, tmp_path):
    import json

    from folio.operators import dataset as D

    meta = spark.createDataFrame([("it", [("b2", 'Li"bro\u00e8', ["A"], [(3, "body", "i.jpg", "m.md")]), ("b1", None, [], [])]), ("de", []), (None, [])],
                                 "lang string, books " + D.BOOKS_SCHEMA)
    D.write_global_metadata(meta, str(tmp_path / "g"), ["fr", "de", 'x"y'])
    (name,) = [f for f in os.listdir(tmp_path / "g") if f.endswith(".txt")]
    with open(tmp_path / "g" / name, encoding="utf-8") as f:
        raw = f.read()
    got = json.loads(raw)
    assert list(got) == ["de", "fr", "it", 'x"y'] and got["de"] == got["fr"] == got['x"y'] == []
    assert got["it"][0]["pages"] == [{"page_idx": 3, "zone": "body", "img_path": "i.jpg", "md_path": "m.md"}] and "\u00e8" in raw
    back = {r.lang: r.books for r in D.read_global_metadata(spark, str(tmp_path / "g")).collect()}
    assert [b.id for b in back["it"]] == ["b2", "b1"] and back["fr"] == []
    D.write_global_metadata(meta.filter("false"), str(tmp_path / "none"))
    assert D.read_global_metadata(spark, str(tmp_path / "none")).count() == 0


def test_per_page_cap_keeps_the_first_linked_books(spark):
    from folio.sources.catalog import candidates

    link = {"application/epub+zip": "u"}
    rows = [(i, f"t{i}", [], ["it"], link if i % 2 else {}, i // 6, i % 6) for i in range(18)] + [(1, "again", [], ["it"], link, 2, 0)]
    raw = spark.createDataFrame(rows, "id long, title string, authors array<struct<name:string>>, languages array<string>, formats map<string,string>, page long, pos long")
    capped = {r.book_id: r.title for r in candidates(raw, per_page_cap=2).collect()}
    assert capped == {i: f"t{i}" for i in (1, 3, 7, 9, 13)}       # the repeat takes a place on its page, but no second row
    ranks = sorted(r.cand_rank for r in candidates(raw, per_page_cap=2).collect())
    assert ranks == [1, 2, 3, 4, 5]
    assert candidates(raw).count() == 9
