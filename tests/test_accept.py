"""Accepting books in candidate order with an early stop."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from folio.operators import accept as A
from folio.operators import chunk as C
from folio.operators import sample as S
from folio.params import Params

SECTION = "lang string, book_id string, section_pos long, section_id string, md string"
CAND = "lang string, book_id string, cand_rank long"
P = Params(page_chars=10, min_md_chars=5, n_books=2)


def book(lang, name, n):
    return [(lang, name, i, f"s{i}", f"paragraph {i} of {name} with enough letters") for i in range(n)]


@pytest.fixture(scope="module")
def shelf(spark):
    """Books of 70 pages are accepted, books of 12 aren't; it: 2nd and 5th of 12 stand, de: one in all, fr: none."""
    rows, cands = [], []
    for lang, good in (("it", {2, 5, 9}), ("de", {3}), ("fr", set())):
        for r in range(1, 13):
            rows += book(lang, f"{lang}{r}", 70 if r in good else 12)
            cands.append((lang, f"{lang}{r}", r))
    return spark.createDataFrame(rows, SECTION), spark.createDataFrame(cands, CAND)


def judge_of(spark, path, seen=None):
    def judge(keys):
        sections = A.sections_of(spark, path, spark.createDataFrame([], SECTION).schema, keys)
        if seen is not None:
            files = sections.select(F.input_file_name().alias("f")).distinct().collect()
            seen.append({os.path.dirname(r.f).rsplit("book_id=", 1)[1] for r in files})
        chunks = C.index_chunks(sections, P, ("lang", "book_id"))
        return S.book_gate(chunks, chunks, P, ("lang", "book_id"))
    return judge


def full(spark, sections, cands):
    chunks = C.index_chunks(sections, P, ("lang", "book_id"))
    books, pages = S.book_gate(chunks, chunks, P, ("lang", "book_id"))
    books = S.first_accepted(books.join(cands, ["lang", "book_id"]), P)
    return books, pages.join(books.select("lang", "book_id"), ["lang", "book_id"], "left_semi")


@pytest.mark.parametrize("first, growth", [(1, 2), (4, 1), (100, 2)])
def test_same_rows_as_judging_everything(spark, shelf, tmp_path, first, growth):
    sections, cands = shelf
    A.land_sections(sections, str(tmp_path / "s"))
    seen = []
    books, pages, rounds = A.accept_until(cands, judge_of(spark, str(tmp_path / "s"), seen), P, first, growth)
    want_books, want_pages = full(spark, sections, cands)
    cols = ["lang", "book_id", "cand_rank", "n_chunks", "n_pages", "accept_pos"]
    assert sorted(map(tuple, books.select(cols).collect())) == sorted(map(tuple, want_books.select(cols).collect()))
    page = ["lang", "book_id", "chunk_idx", "zone", "sample_pos"]
    assert sorted(map(tuple, pages.select(page).collect())) == sorted(map(tuple, want_pages.select(page).collect()))
    # a counter of opened folders: italian books behind the block of the 2nd accepted one (rank 5) stay closed
    end, high, size = 0, 0, first
    while high < 5:
        high, size = high + size, size * growth
        end = high
    opened = set().union(*seen)
    assert opened == {f"it{r}" for r in range(1, min(end, 12) + 1)} | {f"{x}{r}" for x in ("de", "fr") for r in range(1, 13)}
    by_lang = {r.lang: r.n for r in rounds.groupBy("lang").agg(F.sum("n_judged").alias("n")).collect()}
    assert by_lang == {"it": min(end, 12), "de": 12, "fr": 12}


def test_broken_books_behind_the_stop_do_no_harm(spark, shelf, tmp_path):
    sections, cands = shelf
    path = str(tmp_path / "s")
    A.land_sections(sections.filter("lang = 'it'"), path)
    folder = f"{path}/lang=it/book_id=it12"
    for f in os.listdir(folder):
        if f.endswith(".parquet"):
            with open(f"{folder}/{f}", "wb") as out:
                out.write(b"broken")
            if os.path.exists(f"{folder}/.{f}.crc"):
                os.remove(f"{folder}/.{f}.crc")
    some = cands.filter("lang = 'it'")
    books, _, _ = A.accept_until(some, judge_of(spark, path), P, 2, 2)
    assert [r.book_id for r in books.orderBy("accept_pos").collect()] == ["it2", "it5"]
    with pytest.raises(Exception):
        A.accept_until(some, judge_of(spark, path), P, 100)
    shutil.rmtree(path)


def test_odd_candidates(spark, shelf, tmp_path):
    sections, cands = shelf
    path = str(tmp_path / "s")
    A.land_sections(sections, path)
    none, pages, rounds = A.accept_until(cands.filter("false"), judge_of(spark, path), P)
    assert none.count() == pages.count() == rounds.count() == 0
    # gaps in the ranks, nulls, candidates without sections, and books nobody asked for
    odd = spark.createDataFrame([("it", "it9", 700), ("it", "it2", 3), (None, "it5", 1), ("it", "it5", None), ("it", "missing", 2)], CAND)
    books, _, rounds = A.accept_until(odd, judge_of(spark, path), P, 2)
    assert [(r.book_id, r.accept_pos) for r in books.orderBy("accept_pos").collect()] == [("it2", 1), ("it9", 2)]
    assert sum(r.n_judged for r in rounds.collect()) == 3
    with pytest.raises(ValueError):
        A.accept_until(cands, judge_of(spark, path), P, 0)


def test_large_blocks_are_joined(spark, shelf, tmp_path, monkeypatch):
    sections, cands = shelf
    path = str(tmp_path / "s")
    A.land_sections(sections, path)
    monkeypatch.setattr(A, "MOST_BOOKS", 3)
    got = A.sections_of(spark, path, sections.schema, cands.filter("cand_rank <= 4"))
    assert got.select("book_id").distinct().count() == 12
