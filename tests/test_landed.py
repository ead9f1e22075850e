"""Catalog pages of unknown shape."""

import json

from folio.sources import landed as L
from folio.sources.catalog import candidates, read_catalog


def _page(n, books, last=False, **more):
    return json.dumps({"page": n, "next": None if last else f"https://c.example/books?page={n + 1}", "results": books, **more})


def _book(i, **over):
    return {"id": i, "title": f"T{i}", "authors": [{"name": "A", "birth_year": 1900}], "languages": ["en"], "formats": {"application/epub+zip": f"u{i}"}, **over}


def test_well_formed_pages_equal_the_fixed_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join([_page(1, [_book(1), _book(2, title=None)]), "", _page(2, [_book(3, authors=[])], last=True)]))
    pages = L.landed_pages(spark, str(tmp_path))
    key = lambda r: (r["page"], r["pos"])
    got, want = (sorted((r.asDict(True) for r in x.collect()), key=key) for x in (L.catalog_books(pages), read_catalog(spark, str(tmp_path))))
    assert got == want and len(got) == 3
    assert L.landed_errors(pages).count() == 0 and L.missing_pages(pages).count() == 0
    assert candidates(L.catalog_books(pages)).count() == candidates(read_catalog(spark, str(tmp_path))).count() == 3


def test_a_bad_field_loses_only_itself(spark, tmp_path):
    books = [_book(1, title=7), _book("x"), _book(3, authors=[{"name": None}, "y", {"name": 4}, {"name": "B"}]), _book(4, languages="en"),
             _book(5, languages=["fr", 3, None]), _book(6, formats={"application/epub+zip": 1, "text/html": "h"}), _book(7, formats=[1]), 12, None, _book(8, id="9")]
    (tmp_path / "a.json").write_text("\n".join([_page(1, books, extra={"x": [1]}), '{"page": 2, "results"', "[1]", '{"page": "4", "results": 5}', _page(5, []), _page(5, [])]))
    pages = L.landed_pages(spark, str(tmp_path))
    got = {r.pos: r for r in L.catalog_books(pages).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4, 5, 6, 9]
    assert got[0].title is None and got[0].id == 1 and got[1].id is None and got[1].title == "Tx" and got[9].id == 9
    assert [a.name for a in got[2].authors] == ["B"] and got[3].languages is None and got[4].languages == ["fr"]
    assert got[5].formats == {"text/html": "h"} and got[6].formats is None
    errors = sorted((r.page or 0, -1 if r.pos is None else r.pos, r.error) for r in L.landed_errors(pages).collect())
    assert errors == [(0, -1, "no JSON"), (0, -1, "no object"), (1, 7, "no object"), (1, 8, "no object"), (4, -1, "no results")]
    assert sorted(r.page for r in L.missing_pages(pages).collect()) == [2, 6]
    assert pages.filter("page = 5").count() == 1


def test_no_pages(spark):
    pages = L.pages_of(spark.createDataFrame([], "file string, value string"))
    assert L.catalog_books(pages).count() == L.landed_errors(pages).count() == L.missing_pages(pages).count() == 0
