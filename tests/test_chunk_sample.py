import re

from pyspark.sql import functions as F

from folio.operators.chunk import index_chunks
from folio.operators.sample import assign_zones, stratified_sample
from folio.params import Params
from folio.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def paragraphs(md):
    return [p.strip() for p in md.split("\n\n") if p.strip()]


def test_chunks_keep_paragraphs_and_limits(spark):
    """Joined blocks give the paragraphs back; a block but the last of its section reaches the
    limit, and would not without its last paragraph; blocks are numbered through the book."""
    p = Params(page_chars=800)
    secs = {(r.book_id, r.section_pos): r.md for r in fx.sections(spark, SF).collect()}
    rows = index_chunks(fx.sections(spark, SF), p).collect()
    by_section, by_book = {}, {}
    for r in rows:
        by_section.setdefault((r.book_id, r.section_pos), []).append((r.piece_pos, r.md))
        by_book.setdefault(r.book_id, []).append((r.chunk_idx, r.section_pos, r.n_chunks))
    for key, blocks in by_section.items():
        blocks = [md for _, md in sorted(blocks)]
        parts = [paragraphs(b) for b in blocks]
        flat, whole = [x for b in parts for x in b], paragraphs(secs[key])
        assert flat == whole[:len(flat)]
        left = whole[len(flat):]
        assert len("\n\n".join(left)) < p.min_md_chars
        for b in parts[:-1]:
            assert sum(map(len, b)) >= p.page_chars > sum(map(len, b[:-1]))
        assert all(b.endswith("\n") and len(b.strip()) >= p.min_md_chars for b in blocks)
    for key, md in secs.items():
        assert (key in by_section) == (len(md.strip()) >= p.min_md_chars)
    for chunks in by_book.values():
        chunks.sort()
        assert [c for c, _, _ in chunks] == list(range(len(chunks))) and {n for _, _, n in chunks} == {len(chunks)}
        assert [s for _, s, _ in chunks] == sorted(s for _, s, _ in chunks)


def test_page_markers_start_pieces(spark):
    long = "w" * 200
    df = spark.createDataFrame([("b", 0, "s", f"{long}\n\n[p. 2] {long}\n\nshort [p. 3] tiny [p. 4] {long} tail")],
                               "book_id string, section_pos long, section_id string, md string")
    got = [r.md for r in index_chunks(df, Params()).orderBy("chunk_idx").collect()]
    assert got == [long + "\n", f"[p. 2] {long}\n\nshort\n", f"[p. 4] {long} tail\n"]


def zones_of(spark, n):
    df = spark.range(0, n).select(F.lit("b").alias("book_id"), F.col("id").alias("chunk_idx"), F.lit(n).alias("n_chunks"))
    return assign_zones(df)


def test_zones_are_runs_in_order(spark):
    for n, sizes in ((10, (3, 2, 3, 2)), (60, (3, 5, 47, 5)), (200, (3, 19, 159, 19))):
        z = [r.zone for r in zones_of(spark, n).orderBy("chunk_idx").collect()]
        runs = re.findall(r"(m+)(f*)(b*)(k*)", "".join({"mandatory": "m", "front": "f", "body": "b", "back": "k"}[x] for x in z))
        assert tuple(map(len, runs[0])) == sizes and sum(sizes) == n


def test_sample_is_stable_and_stratified(spark):
    z = zones_of(spark, 60)
    s1 = sorted((r.chunk_idx, r.zone) for r in stratified_sample(z).collect())
    s2 = sorted((r.chunk_idx, r.zone) for r in stratified_sample(z.repartition(7)).collect())
    assert s1 == s2
    assert [sum(x == k for _, x in s1) for k in ("mandatory", "front", "body", "back")] == [3, 2, 10, 5]


def test_repeated_positions_and_null_keys_keep_one_row_each(spark):
    long = ["x" * 200, "y" * 200, "z" * 200, "w" * 200]
    rows = [("b", 0, "s", long[0]), ("b", 0, "s", long[1]), ("b", 0, "s", long[1]), ("b", 1, "t", long[2]), (None, 0, "s", long[3]), (None, None, None, long[0]), ("c", None, "u", long[1])]
    df = spark.createDataFrame(rows, "book_id string, section_pos long, section_id string, md string")
    got = index_chunks(df, Params()).collect()
    by_book = {}
    for r in got:
        by_book.setdefault(r.book_id, []).append((r.chunk_idx, r.md.strip()))
        assert r.n_chunks == {"b": 4, "c": 1, None: 2}[r.book_id]
    assert len(got) == len(rows)
    assert {k: [i for i, _ in sorted(v)] for k, v in by_book.items()} == {"b": [0, 1, 2, 3], "c": [0], None: [0, 1]}
    assert sorted(md for _, md in by_book["b"]) == sorted([long[0], long[1], long[1], long[2]]) and max(by_book["b"])[1] == long[2]
    assert sorted(by_book[None]) == [(0, long[0]), (1, long[3])]


def test_running_sum_keeps_null_keys(spark):
    from folio.operators.prefix import running_sum

    df = spark.createDataFrame([(None, i, 1) for i in range(600)] + [("a", 5, 7), ("a", None, 2)], "k string, i long, v long")
    got = running_sum(df, ["k"], F.floor(F.col("i") / 256), ["i"], F.col("v"), "before", "total").collect()
    assert sorted((r.i, r.before, r.total) for r in got if r.k is None) == [(i, i, 600) for i in range(600)]
    assert {(r.i, r.before, r.total) for r in got if r.k == "a"} == {(None, 0, 9), (5, 2, 9)}
