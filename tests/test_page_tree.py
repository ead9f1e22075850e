"""Page trees: exact names out and in, packing, pruning, failed tasks."""

import os
import pickle

import pytest
from pyspark.sql import functions as F

from folio.sources import page_tree as PT
from folio.sources.files import read_md_dir, read_page_tree

ROW = "lang string, book string, page string, md string"
PAGES = [("italian", f"{b}_Libro", f"page_{i:04d}.md", f"# {b} {i}\n\ntèsto\r\n" * (i % 3)) for b in (7, 8) for i in range(5)] + [("german", "9_Büch er", "page_0000.md", "\n")]


@pytest.fixture
def tree(spark, tmp_path):
    PT.register(spark)
    root = str(tmp_path / "tree")
    spark.createDataFrame(PAGES, ROW).repartition(3).withColumn("more", F.lit(1)).write.format("page_tree").mode("append").save(root)
    return root


def files(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs)


def read(spark, root, **options):
    return spark.read.format("page_tree").options(**options).load(root)


def test_names_and_texts_out_and_in(spark, tree):
    assert files(tree) == sorted(f"{lang}/{book}/pages/{page}" for lang, book, page, _ in PAGES)
    for lang, book, page, md in PAGES:
        with open(f"{tree}/{lang}/{book}/pages/{page}", newline="") as f:
            assert f.read() == md
    assert sorted(map(tuple, read(spark, tree).collect())) == sorted(PAGES)
    assert sorted(map(tuple, read_page_tree(spark, tree).collect())) == sorted(p for p in PAGES if p[3])
    assert sorted(r.name for r in read_md_dir(spark, f"{tree}/italian/7_Libro/pages").collect()) == [f"page_{i:04d}.md" for i in (1, 2, 4)]


def test_small_files_are_packed(spark, tree):
    assert read(spark, tree).rdd.getNumPartitions() == 1
    assert read(spark, tree, openCost="1000", partitionBytes="3100").rdd.getNumPartitions() == 4
    assert read(spark, tree, openCost="1000", partitionBytes="3100").count() == len(PAGES)
    assert read(spark, tree, partitionBytes="1").rdd.getNumPartitions() == len(PAGES)


def test_filters_cut_the_listing(spark, tree, tmp_path):
    os.makedirs(f"{tree}/italian/broken/pages")
    with open(f"{tree}/italian/broken/pages/page_0001.md", "wb") as f:
        f.write(b"\xff\xfe broken")
    some = read(spark, tree).filter("lang = 'italian' AND book IN ('7_Libro', 'none', '..') AND md <> ''")
    assert sorted(r.page for r in some.collect()) == sorted(p for lang, b, p, md in PAGES if b == "7_Libro" and md)
    assert read(spark, tree).filter("lang = 'german' AND page = 'page_0000.md'").count() == 1
    assert read(spark, tree).filter("lang = 'italian' AND lang = 'german'").count() == 0
    with pytest.raises(Exception):
        read(spark, tree).filter("book = 'broken'").collect()


def test_append_and_overwrite(spark, tree):
    new = spark.createDataFrame([("italian", "7_Libro", "page_0001.md", "new"), ("italian", "7_Libro", "page_0099.md", None)], ROW)
    new.write.format("page_tree").mode("append").save(tree)
    got = {(r.book, r.page): r.md for r in read(spark, tree).collect()}
    assert len(got) == len(PAGES) + 1 and got["7_Libro", "page_0001.md"] == "new" and got["7_Libro", "page_0099.md"] == ""
    new.write.format("page_tree").mode("overwrite").save(tree)
    assert files(tree) == ["italian/7_Libro/pages/page_0001.md", "italian/7_Libro/pages/page_0099.md"]


def test_predictions_without_inner_folder(spark, tmp_path):
    PT.register(spark)
    root = str(tmp_path / "pred")
    spark.createDataFrame(PAGES, ROW).write.format("page_tree").option("inner", "").mode("append").save(root)
    assert "italian/7_Libro/page_0003.md" in files(root)
    assert sorted(map(tuple, read(spark, root, inner="").collect())) == sorted(PAGES)


@pytest.mark.parametrize("bad", [None, "", "..", "a/b", ".hidden"])
def test_a_failed_task_leaves_nothing(spark, tree, bad):
    before = files(tree)
    rows = [("italian", "new", f"page_{i:04d}.md", "x") for i in range(50)] + [("italian", bad, "page_0000.md", "x")]
    with pytest.raises(Exception):
        spark.createDataFrame(rows, ROW).repartition(3).write.format("page_tree").mode("append").save(tree)
    assert files(tree) == before


def test_only_mounted_folders():
    assert [PT.local_path(x) for x in ("/a/b", "file:/a/b", "file:///a/b")] == ["/a/b"] * 3
    with pytest.raises(ValueError):
        PT.local_path("hdfs://x/a")


def test_empty_tree(spark, tmp_path):
    PT.register(spark)
    assert read(spark, str(tmp_path)).count() == 0
    assert read(spark, str(tmp_path / "missing")).count() == 0
    spark.createDataFrame([], ROW).write.format("page_tree").mode("append").save(str(tmp_path))
    assert files(str(tmp_path)) == []
    with pytest.raises(Exception):
        spark.createDataFrame([("x",)], "lang string").write.format("page_tree").mode("append").save(str(tmp_path))


def test_driver_works_once_a_folder(tmp_path, monkeypatch):
    rows = [{"lang": "it", "book": f"b{i % 3}", "page": f"page_{i:04d}.md", "md": "è" * (i % 4) if i % 5 else None} for i in range(2100)]
    calls = []

    def counted(name, fn):
        return lambda *a, **b: calls.append(name) or fn(*a, **b)

    monkeypatch.setattr(PT.os, "makedirs", counted("makedirs", os.makedirs))
    monkeypatch.setattr(PT.os.path, "getsize", counted("getsize", os.path.getsize))
    monkeypatch.setattr(PT.os.path, "isfile", counted("isfile", os.path.isfile))
    writer = PT.PageTreeWriter(str(tmp_path), "pages", False)
    writer.commit([writer.write(iter(rows[:1500])), None, writer.write(iter([*rows[1500:], {**rows[0], "md": "last"}]))])
    assert calls.count("makedirs") < 30
    calls.clear()
    reader = PT.PageTreeReader(str(tmp_path), "pages", ".md", 64 << 20, 1 << 16)
    parts = reader.partitions()
    assert not calls
    got = {(book, page): md for p in parts for _, book, page, md in reader.read(p)}
    assert got == {(r["book"], r["page"]): r["md"] or "" for r in rows} | {("b0", "page_0000.md"): "last"}
    os.makedirs(tmp_path / "it" / "b0" / "pages" / "folder.md")
    assert sum(len(p.rows) for p in reader.partitions()) == len(rows)


def test_driver_holds_few_bytes_a_file(tmp_path):
    rows = [{"lang": "it", "book": f"b{i // 1500}", "page": f"page_{i:04d}\n.md" if i % 100 == 7 else f"page_{i:04d}.md", "md": "x"} for i in range(3000)]
    writer = PT.PageTreeWriter(str(tmp_path), "pages", False)
    messages = [writer.write(iter(rows)), writer.write(iter([]))]
    assert len(pickle.dumps(messages)) < 1000                # names are on disk, not in the commit message
    writer.commit(messages)
    assert not [n for n in os.listdir(tmp_path) if n != "it"]
    parts = PT.PageTreeReader(str(tmp_path), "pages", ".md", 64 << 20, 1 << 16).partitions()
    assert len(pickle.dumps(parts)) < 10 * len(rows)
    assert [x for p in parts for x in p.rows] == sorted((r["lang"], r["book"], r["page"]) for r in rows)
    again = PT.PageTreeWriter(str(tmp_path), "pages", True)
    again.commit([again.write(iter(rows[:3]))])
    assert len(files(str(tmp_path))) == 3
