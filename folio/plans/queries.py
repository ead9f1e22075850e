"""Registered queries: name -> (Spark builder, DuckDB SQL builder or None).

Each Spark builder takes (spark, sf_dir) and returns a DataFrame over the
whole driver tables; the SQL builder returns the independent DuckDB twin.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import accept as A
from folio.operators import chunk as C
from folio.operators import dataset as D
from folio.operators import sample as S
from folio.functions import text as T
from folio.functions.bleu import tokenize_13a
from folio.functions import markdown as MD
from folio.functions.markdown import ELEMENT_TYPES
from folio.operators import evaluate as E
from folio.operators import metrics as M
from folio.params import Params
from folio.plans import fixtures as fx
from folio.plans import oracle as O

REGISTRY: dict = {}

GATE_PARAMS = Params(page_chars=800)   # FIXTURES §4: accepted and rejected books both occur


def register(name, sql=None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# ---------------------------------------------------------------- chunking

def _sql_split_markers():
    return f"""WITH RECURSIVE {O.chunks_ctes(O.rich_sections_sql(), Params())}
SELECT book_id, section_pos,
       row_number() OVER (PARTITION BY book_id, section_pos ORDER BY k) - 1 AS piece_pos,
       piece || chr(10) AS md
FROM mpieces"""


@register("split_markers", _sql_split_markers)
def q_split_markers(spark, sf):
    p = Params()
    s = fx.rich_sections(spark, sf).filter(F.length(C.py_strip("md")) >= p.min_md_chars)
    s = s.withColumn("pieces", C.split_markers("md", p.min_md_chars))
    return T.posexplode_rows(s, ["book_id", "section_pos"], "pieces", "piece_pos", "md") \
            .withColumn("piece_pos", F.col("piece_pos").cast("bigint"))


def _sql_pack_paragraphs():
    return f"""WITH RECURSIVE {O.chunks_ctes(O.sections_sql(), Params())}
SELECT book_id, section_pos, piece_pos, md FROM bypack"""


@register("pack_paragraphs", _sql_pack_paragraphs)
def q_pack_paragraphs(spark, sf):
    p = Params()
    s = fx.sections(spark, sf).filter(F.length(C.py_strip("md")) >= p.min_md_chars)
    s = C.with_packed(s, "md", "packed", p.page_chars, p.min_md_chars)
    return T.posexplode_rows(s, ["book_id", "section_pos"], "packed", "piece_pos", "md") \
            .withColumn("piece_pos", F.col("piece_pos").cast("bigint"))


def _sql_split_sections():
    return f"""WITH RECURSIVE {O.chunks_ctes(O.rich_sections_sql(), Params())}
SELECT book_id, section_pos, piece_pos, section_id, md FROM pieces"""


@register("split_sections", _sql_split_sections)
def q_split_sections(spark, sf):
    return C.split_sections(fx.rich_sections(spark, sf), Params()) \
            .withColumn("piece_pos", F.col("piece_pos").cast("bigint"))


def _sql_chunk_index():
    return f"""WITH RECURSIVE {O.chunks_ctes(O.sections_sql(), GATE_PARAMS)}
SELECT book_id, section_pos, piece_pos, chunk_idx, n_chunks, section_id, md FROM chunks"""


@register("chunk_index_default", lambda: f"""WITH RECURSIVE {O.chunks_ctes(O.sections_sql(), Params())}
SELECT book_id, section_pos, piece_pos, chunk_idx, n_chunks, section_id, md FROM chunks""")
def q_chunk_index_default(spark, sf):
    return C.index_chunks(fx.sections(spark, sf)).withColumn("piece_pos", F.col("piece_pos").cast("bigint"))


@register("chunk_index", _sql_chunk_index)
def q_chunk_index(spark, sf):
    return C.index_chunks(fx.sections(spark, sf), GATE_PARAMS) \
            .withColumn("piece_pos", F.col("piece_pos").cast("bigint"))


# ---------------------------------------------------------------- sampling and gates

def _gate_chunks(spark, sf):
    return C.index_chunks(fx.sections(spark, sf), GATE_PARAMS)


def _sample_sql(select):
    return f"""WITH RECURSIVE {O.chunks_ctes(O.sections_sql(), GATE_PARAMS)}{O.sample_ctes(GATE_PARAMS)}
{select}"""


@register("zones", lambda: _sample_sql("SELECT book_id, chunk_idx, n_chunks, zone FROM zoned"))
def q_zones(spark, sf):
    return S.assign_zones(_gate_chunks(spark, sf), GATE_PARAMS).select("book_id", "chunk_idx", "n_chunks", "zone")


@register("stratified_sample", lambda: _sample_sql("SELECT book_id, chunk_idx, zone, sample_pos FROM sampled"))
def q_stratified_sample(spark, sf):
    ch = _gate_chunks(spark, sf).filter("n_chunks >= 10")
    return S.stratified_sample(S.assign_zones(ch, GATE_PARAMS), GATE_PARAMS)


def _gate(spark, sf):
    ch = _gate_chunks(spark, sf)
    return S.book_gate(ch, fx.rendered(spark, sf, ch), GATE_PARAMS)


@register("book_gate", lambda: _sample_sql("SELECT book_id, n_chunks, n_sampled, n_pages, accepted FROM gate"))
def q_book_gate(spark, sf):
    return _gate(spark, sf)[0]


@register("accepted_books", lambda: _sample_sql(f"""SELECT lang, book_id, cand_rank, n_chunks, n_pages, accept_pos FROM (
  SELECT c.lang, g.*, c.cand_rank,
         row_number() OVER (PARTITION BY c.lang ORDER BY c.cand_rank, g.book_id) AS accept_pos
  FROM gate g JOIN ({O.books_sql()}) c USING (book_id) WHERE g.accepted
) WHERE accept_pos <= {GATE_PARAMS.n_books}"""))
def q_accepted_books(spark, sf):
    books, _ = _gate(spark, sf)
    cands = fx.books(spark, sf).select("lang", "book_id", "cand_rank")
    return S.first_accepted(books.join(cands, "book_id"), GATE_PARAMS).select(
        "lang", "book_id", "cand_rank", "n_chunks", "n_pages", "accept_pos")


UNTIL_PARAMS = Params(page_chars=400, n_books=2)
UNTIL_BLOCK, UNTIL_GROWTH = 3, 4      # blocks end at rank 3, 15, 63, ...


@register("accept_until", lambda: f"""WITH RECURSIVE {O.chunks_ctes(O.sections_sql(), UNTIL_PARAMS)}{O.sample_ctes(UNTIL_PARAMS)},
cand AS ({O.books_sql()}),
standing AS (SELECT c.lang, g.*, c.cand_rank, row_number() OVER (PARTITION BY c.lang ORDER BY c.cand_rank, g.book_id) AS accept_pos
           FROM gate g JOIN cand c USING (book_id) WHERE g.accepted),
ends AS (SELECT lang, min(4 ** k - 1) AS high FROM standing, range(1, 30) r(k)
         WHERE accept_pos = {UNTIL_PARAMS.n_books} AND 4 ** k - 1 >= cand_rank GROUP BY lang),
opened AS (SELECT lang, count(*) AS n_judged FROM cand LEFT JOIN ends USING (lang) WHERE cand_rank <= coalesce(high, 1e9) GROUP BY lang)
SELECT lang, book_id, cand_rank, n_chunks, n_pages, accept_pos, n_judged FROM standing JOIN opened USING (lang) WHERE accept_pos <= {UNTIL_PARAMS.n_books}""")
def q_accept_until(spark, sf):
    """The first accepted books, judged in growing blocks of candidates over landed sections; n_judged
    counts the books of the language that were opened at all."""
    path = _run_dir(spark, sf, "sections")
    rows = fx.sections(spark, sf)
    A.land_sections(rows, path)

    def judge(keys):
        chunks = C.index_chunks(A.sections_of(spark, path, rows.schema, keys), UNTIL_PARAMS, ("lang", "book_id"))
        books, pages = S.book_gate(chunks, fx.rendered(spark, sf, chunks, ("lang", "book_id")), UNTIL_PARAMS, ("lang", "book_id"))
        return books, pages

    books, _, rounds = A.accept_until(fx.books(spark, sf), judge, UNTIL_PARAMS, UNTIL_BLOCK, UNTIL_GROWTH)
    opened = rounds.groupBy("lang").agg(F.sum("n_judged").alias("n_judged"))
    return books.join(opened, "lang").select("lang", "book_id", "cand_rank", "n_chunks", "n_pages", "accept_pos", "n_judged")


@register("dataset_metadata", lambda: _sample_sql(f"""SELECT lang, book_id, title, to_json(authors) AS authors_json,
  to_json(list(struct_pack(page_idx := CAST(chunk_idx AS INTEGER), zone := zone,
      img_path := lang || '/' || book_id || '_' || {O.slug_sql('title')} || '/pages/' || printf('page_%04d.jpg', chunk_idx),
      md_path := lang || '/' || book_id || '_' || {O.slug_sql('title')} || '/pages/' || printf('page_%04d.md', chunk_idx))
    ORDER BY CASE zone WHEN 'mandatory' THEN 0 WHEN 'front' THEN 1 WHEN 'body' THEN 2 ELSE 3 END, sample_pos)) AS pages_json
FROM (
  SELECT c.lang, c.title, c.authors, p.* FROM pages p JOIN ({O.books_sql()}) c USING (book_id)
  WHERE p.book_id IN (SELECT book_id FROM (
     SELECT g.book_id, row_number() OVER (PARTITION BY c2.lang ORDER BY c2.cand_rank, g.book_id) AS ap
     FROM gate g JOIN ({O.books_sql()}) c2 USING (book_id) WHERE g.accepted) WHERE ap <= {GATE_PARAMS.n_books})
) GROUP BY lang, book_id, title, authors"""))
def q_dataset_metadata(spark, sf):
    books, pages = _gate(spark, sf)
    cands = fx.books(spark, sf)
    first = S.first_accepted(books.join(cands.select("lang", "book_id", "cand_rank"), "book_id"), GATE_PARAMS)
    pages = pages.join(first.select("book_id"), "book_id", "left_semi")
    meta = D.book_metadata(D.page_records(pages, cands), cands)
    return meta.select("lang", "book_id", "title", F.to_json("authors").alias("authors_json"),
                       F.to_json("pages").alias("pages_json"))


GLOBAL_LANGUAGES = ("en", "fr", "de", "es", "it")


@register("global_metadata", lambda: f"""SELECT l.lang, count(x.book_id) AS n_books, coalesce(string_agg(x.book_id || ' ' || x.title, '; ' ORDER BY x.book_id), '') AS books,
  coalesce(sum(json_array_length(x.pages_json)), 0)::BIGINT AS n_pages
  FROM (VALUES {", ".join(f"('{x}')" for x in GLOBAL_LANGUAGES)}) l(lang) LEFT JOIN ({REGISTRY["dataset_metadata"][1]()}) x ON x.lang = l.lang GROUP BY l.lang""")
def q_global_metadata(spark, sf):
    """The dataset's one metadata file, written and read back: the accepted books of every language, none for some."""
    books, pages = _gate(spark, sf)
    cands = fx.books(spark, sf)
    first = S.first_accepted(books.join(cands.select("lang", "book_id", "cand_rank"), "book_id"), GATE_PARAMS)
    meta = D.book_metadata(D.page_records(pages.join(first.select("book_id"), "book_id", "left_semi"), cands), cands)
    root = _run_dir(spark, sf, "metadata")
    D.write_global_metadata(D.language_metadata(meta), root, GLOBAL_LANGUAGES)
    found = D.read_global_metadata(spark, root)
    return found.select("lang", F.size("books").cast("long").alias("n_books"), F.array_join(F.transform("books", lambda b: F.concat_ws(" ", b["id"], b["title"])), "; ").alias("books"),
                        F.aggregate("books", F.lit(0).cast("long"), lambda n, b: n + F.size(b["pages"])).alias("n_pages"))


@register("full_book_md", lambda: f"""SELECT book_id, section_pos,
  CASE WHEN section_pos = min(section_pos) OVER (PARTITION BY book_id) THEN md
       ELSE chr(10) || chr(10) || '---' || chr(10) || chr(10) || md END AS part
FROM ({O.sections_sql()})""")
def q_full_book_md(spark, sf):
    return D.full_book_parts(fx.sections(spark, sf))


@register("book_slug", lambda: f"""SELECT lang, book_id, title, {O.slug_sql('title')} AS slug,
  book_id || '_' || {O.slug_sql('title')} AS book_dir FROM ({O.books_sql()})""")
def q_book_slug(spark, sf):
    b = fx.books(spark, sf)
    return b.select("lang", "book_id", "title", T.title_slug("title").alias("slug"),
                    D.book_dir("book_id", "title").alias("book_dir"))


# ---------------------------------------------------------------- evaluation

MODELS = (fx.MODEL_A, fx.MODEL_B)
PAIR = ["model", "lang", "book", "page"]


def _eval_sql(select):
    return f"""WITH RECURSIVE {O.chunks_ctes(O.rich_sections_sql(), Params())}{O.eval_ctes(*MODELS)}
{select}"""


def _inputs(spark, sf, texts=True):
    # Both sides derive from the reference pages: cut the lineage once (a packed table
    # in the shared folder) so the chunk pipeline runs once, not per branch.
    # Queries on page keys drop the texts before the cut.
    from folio.session import shuffles_dropped
    refs = fx.ref_pages(spark, sf)
    refs = refs if texts else refs.withColumn("md", F.lit(""))
    path = _run_dir(spark, sf, "refs")
    with shuffles_dropped(spark):
        refs.write.option("compression", "zstd").parquet(path)
    refs = spark.read.schema(refs.schema).parquet(path)
    return refs, fx.predictions(spark, sf, refs)


def _scores(spark, sf, detail=False):
    refs, preds = _inputs(spark, sf)
    return E.eval_scores(refs, preds, detail=detail)


@register("eval_pairs", lambda: _eval_sql(
    "SELECT model, lang, book, page, length(ref) AS ref_chars, length(hyp) AS hyp_chars FROM pairs"))
def q_eval_pairs(spark, sf):
    refs, preds = _inputs(spark, sf)
    p = E.eval_pairs(refs, preds)
    return p.select(*PAIR, F.length("ref").cast("bigint").alias("ref_chars"),
                    F.length("hyp").cast("bigint").alias("hyp_chars"))


@register("missing_predictions", lambda: _eval_sql(f"""SELECT m.model, r.lang, r.book, r.page
FROM refs r, (VALUES ('{fx.MODEL_A}'), ('{fx.MODEL_B}')) m(model)
WHERE NOT EXISTS (SELECT 1 FROM preds p WHERE p.model = m.model AND p.lang = r.lang AND p.book = r.book AND p.page = r.page)"""))
def q_missing_predictions(spark, sf):
    refs, preds = _inputs(spark, sf, texts=False)
    return E.missing_predictions(refs, preds, MODELS).select(*PAIR)


@register("normalise_text", lambda: f"""SELECT doc_id,
  {O.norm_sql("replace(text, chr(10), ' ' || chr(9) || chr(13) || chr(10) || chr(10) || chr(10)) || '  '")} AS text_norm
FROM documents""")
def q_normalise_text(spark, sf):
    d = fx.documents(spark, sf)
    messy = F.concat(F.replace("text", F.lit("\n"), F.lit(" \t\r\n\n\n")), F.lit("  "))
    return d.select("doc_id", T.normalise(messy).alias("text_norm"))


@register("tokenize_13a", lambda: f"""SELECT doc_id, CAST(len(tk) AS BIGINT) AS n_tokens, array_to_string(tk, ' ') AS tokens
FROM (SELECT doc_id, {O.tok13a_sql(O.norm_sql('text'))} AS tk FROM documents)""")
def q_tokenize_13a(spark, sf):
    d = fx.documents(spark, sf).select("doc_id", tokenize_13a(T.normalise("text")).alias("tk"))
    return d.select("doc_id", F.size("tk").cast("bigint").alias("n_tokens"), F.array_join("tk", " ").alias("tokens"))


@register("ned", lambda: _eval_sql("SELECT model, lang, book, page, ned, similarity FROM scores"))
def q_ned(spark, sf):
    refs, preds = _inputs(spark, sf)
    p = M.prepare_pairs(E.spread(E.eval_pairs(refs, preds), PAIR), PAIR)
    return p.select(*PAIR, M.ned("_rn", "_hn").alias("ned")).withColumn("similarity", M.similarity("ned"))


@register("bleu", lambda: _eval_sql("SELECT model, lang, book, page, round_even(bleu, 6) AS bleu FROM scores"))
def q_bleu(spark, sf):
    return _scores(spark, sf).select(*PAIR, F.bround("bleu", 6).alias("bleu"))


@register("eval_decomposed", lambda: _eval_sql(
    "SELECT model, lang, book, page, ned, similarity, round_even(bleu, 6) AS bleu, struct_f1 FROM scores"))
def q_eval_decomposed(spark, sf):
    """The same scores from predictions whose accents are separate code points (NFD)."""
    refs, preds = _inputs(spark, sf)
    return E.eval_scores(refs, preds.withColumn("md", fx.nfd("md"))).withColumn("bleu", F.bround("bleu", 6))


@register("bleu_counts", lambda: _eval_sql(
    "SELECT model, lang, book, page, ref_len, hyp_len, correct_1, correct_2, correct_3, correct_4, "
    "t1 AS total_1, t2 AS total_2, t3 AS total_3, t4 AS total_4 FROM bz"))
def q_bleu_counts(spark, sf):
    refs, preds = _inputs(spark, sf)
    s = M.score_pairs(E.spread(E.eval_pairs(refs, preds), PAIR), PAIR, with_counts=True)
    return s.select(*PAIR, "ref_len", "hyp_len", *[f"correct_{n}" for n in range(1, 5)],
                    *[f"total_{n}" for n in range(1, 5)])


@register("struct_f1", lambda: _eval_sql("SELECT model, lang, book, page, struct_f1 FROM scores"))
def q_struct_f1(spark, sf):
    return _scores(spark, sf).select(*PAIR, "struct_f1")


@register("md_elements", lambda: _eval_sql("SELECT model, lang, book, page, side, type, token, cnt FROM ecount"))
def q_md_elements(spark, sf):
    refs, preds = _inputs(spark, sf)
    return E.eval_elements(refs, preds)


@register("md_blocks", lambda: O.block_elements_sql())
def q_md_blocks(spark, sf):
    """Headings, quotes and items of documents written with setext headings, lazy lines and nested items."""
    found = MD.with_elements(fx.block_markdown(spark, sf), "md", "es").select("doc_id", F.explode_outer("es").alias("e")).select("doc_id", "e.*")
    return found.filter(F.col("type").isin("headings", "blockquotes", "list_items")).groupBy("doc_id", "type", "token").agg(F.count("*").alias("cnt"))


@register("multiset_overlap", lambda: _eval_sql(
    "SELECT model, lang, book, page, type, rt AS ref_total, ht AS hyp_total, tp AS overlap FROM etype"))
def q_multiset_overlap(spark, sf):
    from folio.operators.multiset import multiset_overlap
    refs, preds = _inputs(spark, sf)
    el = E.eval_elements(refs, preds)
    items = el.select(*PAIR, "type", "token",
                      F.when(F.col("side") == "ref", F.col("cnt")).otherwise(0).alias("r"),
                      F.when(F.col("side") == "hyp", F.col("cnt")).otherwise(0).alias("h"))
    return multiset_overlap(items, PAIR + ["type"], "token")


@register("struct_f1_detail", lambda: _eval_sql(
    "SELECT p.model, p.lang, p.book, p.page, " + ", ".join(
        f"coalesce(max(f1) FILTER (WHERE type = '{t}'), 1.0) AS f1_{t}" for t in ELEMENT_TYPES) +
    ", any_value(s.struct_f1) AS struct_f1 FROM pairs p JOIN sf1 s USING (model, lang, book, page) "
    "LEFT JOIN ef1 e USING (model, lang, book, page) GROUP BY p.model, p.lang, p.book, p.page"))
def q_struct_f1_detail(spark, sf):
    return _scores(spark, sf, detail=True).select(*PAIR, *[f"f1_{t}" for t in ELEMENT_TYPES], "struct_f1")


@register("eval_scores", lambda: _eval_sql(
    "SELECT model, lang, book, page, ned, similarity, round_even(bleu, 6) AS bleu, struct_f1 FROM scores"))
def q_eval_scores(spark, sf):
    return _scores(spark, sf).withColumn("bleu", F.bround("bleu", 6))


@register("eval_summary", lambda: _eval_sql(
    "SELECT model, lang, book, count(*) AS n_pages, round_even(avg(ned), 4) AS avg_ned, "
    "round_even(avg(similarity), 4) AS avg_similarity, round_even(avg(bleu), 2) AS avg_bleu, "
    "round_even(avg(struct_f1), 4) AS avg_struct_f1 FROM scores GROUP BY ALL"))
def q_eval_summary(spark, sf):
    return E.eval_summary(_scores(spark, sf))


@register("merged_summary", lambda: REGISTRY["eval_summary"][1]())
def q_merged_summary(spark, sf):
    """The summary from states that five batches of pages wrote, the scores read once."""
    from folio.operators import report as R
    scores = _scores(spark, sf).withColumn("part", F.pmod(F.xxhash64("page"), F.lit(5))).checkpoint()
    root = _run_dir(spark, sf, "states")
    for k in range(5):
        R.write_state(scores.filter(F.col("part") == k), root, k)
    return R.report_of(R.read_states(spark, root))


@register("corpus_scores", lambda: _eval_sql(
    "SELECT model, count(*) AS n_pairs, coalesce(round_even(avg(ned), 4), 0.0) AS corpus_ned, "
    "coalesce(round_even(avg(bleu), 2), 0.0) AS corpus_bleu, "
    "coalesce(round_even(avg(struct_f1), 4), 0.0) AS corpus_struct_f1 FROM scores GROUP BY ALL"))
def q_corpus_scores(spark, sf):
    return E.corpus_scores(_scores(spark, sf))


@register("model_ranking", lambda: _eval_sql(
    "SELECT model, lang, metric, value, higher_is_better, row_number() OVER (PARTITION BY lang, metric ORDER BY "
    "CASE WHEN higher_is_better THEN -value ELSE value END, model) AS rank FROM ("
    "SELECT model, lang, 'ned' AS metric, round_even(avg(ned), 6) AS value, false AS higher_is_better FROM scores GROUP BY ALL "
    "UNION ALL SELECT model, lang, 'bleu', round_even(avg(bleu), 6), true FROM scores GROUP BY ALL "
    "UNION ALL SELECT model, lang, 'struct_f1', round_even(avg(struct_f1), 6), true FROM scores GROUP BY ALL)"))
def q_model_ranking(spark, sf):
    return E.model_ranking(_scores(spark, sf))


# ---------------------------------------------------------------- scorers of a user

RATIO = "coalesce(least(length(ref), length(hyp)) / nullif(greatest(length(ref), length(hyp)), 0), 1.0)"


def _user_scorers(spark):
    """Two metrics of score_pairs, one SQL function and one Column of line sets."""
    from folio.operators import scorers as SC

    def same_lines(ref, hyp):
        a, b = F.split(ref, "\n"), F.split(hyp, "\n")
        return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))

    ratio = SC.sql_scorer(SC.expose(spark, "length_ratio", RATIO), places=6)
    return SC.Scorers(["ned", "struct_f1"]).add(ratio).add(SC.Scorer("line_share", score=same_lines))


def _exact_mean(m):
    return f"CAST(sum(CAST({m} AS DECIMAL(24,12))) AS DOUBLE) / count({m})"


def _user_scores_sql(select):
    return _eval_sql(f"""SELECT * FROM (WITH us AS (SELECT model, lang, book, page, s.ned, s.struct_f1, {RATIO} AS length_ratio,
    len(list_intersect(string_split(ref, chr(10)), string_split(hyp, chr(10))))
      / len(list_distinct(list_concat(string_split(ref, chr(10)), string_split(hyp, chr(10))))) AS line_share
  FROM scores s JOIN pairs p USING (model, lang, book, page)) {select})""")


@register("scorer_summary", lambda: _user_scores_sql("SELECT model, lang, book, count(*) AS n_pages, " + ", ".join(
    f"count({m}) AS n_{m}, round_even({_exact_mean(m)}, {k}) AS corpus_{m}" for m, k in (("ned", 4), ("struct_f1", 4), ("length_ratio", 6), ("line_share", 4)))
    + " FROM us GROUP BY ALL"))
def q_scorer_summary(spark, sf):
    scorers = _user_scorers(spark)
    refs, preds = _inputs(spark, sf)
    return E.eval_summary(E.eval_scores(refs, preds, scorers=scorers), scorers=scorers)


@register("scorer_ranking", lambda: _user_scores_sql(
    "SELECT model, lang, metric, value, higher_is_better, row_number() OVER (PARTITION BY lang, metric ORDER BY "
    "CASE WHEN higher_is_better THEN -value ELSE value END, model) AS rank FROM (" + " UNION ALL ".join(
        f"SELECT model, lang, '{m}' AS metric, round_even({_exact_mean(m)}, 6) AS value, {b} AS higher_is_better FROM us GROUP BY ALL"
        for m, b in (("ned", "false"), ("struct_f1", "true"), ("length_ratio", "true"), ("line_share", "true"))) + ")"))
def q_scorer_ranking(spark, sf):
    scorers = _user_scorers(spark)
    refs, preds = _inputs(spark, sf)
    return E.model_ranking(E.eval_scores(refs, preds, scorers=scorers), scorers=scorers)


# ---------------------------------------------------------------- cleaning

from folio.functions import clean as CL  # noqa: E402


def _clean_sql(select):
    steps = O.clean_rules_sql("md")
    cols = ", ".join(f"{expr} AS s_{rid}" for rid, expr in steps)
    return f"WITH raw AS ({O.raw_markdown_sql()}), st AS (SELECT doc_id, md, {cols} FROM raw)\n{select}"


@register("clean_markdown", lambda: _clean_sql(f"SELECT doc_id, {O.strip('s_C10')} || chr(10) AS clean FROM st"))
def q_clean_markdown(spark, sf):
    return CL.clean_markdown(fx.raw_markdown(spark, sf), "md", "clean").select("doc_id", "clean")


def _rules_sql():
    ids = [r[0] for r in CL.RULES]
    prev = ["md"] + [f"s_{i}" for i in ids[:-1]]
    union = " UNION ALL ".join(
        f"SELECT '{rid}' AS rule, CAST(count(*) FILTER (WHERE s_{rid} <> {p}) AS BIGINT) AS n_changed FROM st"
        for rid, p in zip(ids, prev))
    return _clean_sql(union)


@register("clean_markdown_rules", _rules_sql)
def q_clean_markdown_rules(spark, sf):
    df, names = CL.clean_steps(fx.raw_markdown(spark, sf), "md")
    prev = ["md"] + names[:-1]
    agg = df.agg(*[F.sum(F.when(F.col(n) != F.col(p), 1).otherwise(0)).cast("bigint").alias(n)
                   for n, p in zip(names, prev)])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(n[2:]).alias("rule"), F.col(n).alias("n_changed")) for n in names])).alias("r")
    ).select("r.rule", "r.n_changed")


@register("render_text", lambda: f"""WITH RECURSIVE {O.chunks_ctes(O.rich_sections_sql(), Params())}
SELECT book_id, chunk_idx, regexp_replace(md, '!\\[[^\\]]*\\]\\([^)]+\\)', '', 'g') AS text FROM chunks""")
def q_render_text(spark, sf):
    ch = C.index_chunks(fx.rich_sections(spark, sf), Params())
    return ch.select("book_id", "chunk_idx", CL.strip_images("md").alias("text"))


def flagship(spark, sf):
    """Flagship: the evaluation report per model, language and book."""
    return q_eval_summary(spark, sf)


# ---------------------------------------------------------------- HTML -> Markdown

from folio.operators import convert as CV  # noqa: E402


@register("html_blocks", lambda: f"WITH {O.html_ctes('SELECT page_id, html FROM pages')}\nSELECT page_id, CAST(pos AS BIGINT) AS pos, tag, cls, text FROM hb WHERE text <> ''")
def q_html_blocks(spark, sf):
    return CV.html_blocks(fx.table(spark, sf, "pages"))


@register("promote_headings", lambda: f"WITH {O.html_ctes(O.classed_pages_sql())}\nSELECT page_id, CAST(pos AS BIGINT) AS pos, tag, cls, text FROM pm WHERE cls <> ''")
def q_promote_headings(spark, sf):
    from folio.functions import html as H
    from folio.functions.text import posexplode_rows
    p = fx.classed_pages(spark, sf)
    b = H.split_blocks(p.select("page_id", "html"), "html", "blocks")
    b = b.withColumn("blocks", H.promote("blocks"))
    rows = posexplode_rows(b, ["page_id"], "blocks", "pos", "b")
    return rows.select("page_id", F.col("pos").cast("bigint").alias("pos"), "b.tag", "b.cls", "b.text") \
               .filter("cls <> ''")


@register("html_to_markdown", lambda: f"WITH {O.html_ctes(O.classed_pages_sql())}\nSELECT page_id, md FROM pclean")
def q_html_to_markdown(spark, sf):
    return CV.html_to_markdown(fx.classed_pages(spark, sf))


@register("section_filter", lambda: f"WITH {O.html_ctes(O.classed_pages_sql())}\nSELECT page_id, CAST(length(md) AS BIGINT) AS n_chars, md FROM pclean WHERE length({O.strip('md')}) >= 50")
def q_section_filter(spark, sf):
    s = CV.section_filter(CV.html_to_markdown(fx.classed_pages(spark, sf)))
    return s.select("page_id", F.length("md").cast("bigint").alias("n_chars"), "md")


# ---------------------------------------------------------------- prediction side

from folio.operators import predict as PR  # noqa: E402

PROMPT = "Transcribe this page image into clean Markdown."


MODEL_BOOK = ("model", "lang", "book")


def _images_and_done(spark, sf, texts=False):
    refs, preds = _inputs(spark, sf, texts)
    images = refs.select(F.explode_outer(F.array(*map(F.lit, MODELS))).alias("model"), "lang", "book",
                         F.regexp_replace("page", r"\.md$", ".jpg").alias("page"),
                         *([F.encode("md", "UTF-8").alias("content")] if texts else []))
    return images, preds.select("model", "lang", "book", "page")


_WANTED = f"(SELECT m.model, r.* FROM refs r, (VALUES ('{fx.MODEL_A}'), ('{fx.MODEL_B}')) m(model))"
_PENDING = f"""SELECT model, lang, book, page, pos, CAST(floor((pos - 1) / 8) AS BIGINT) AS batch, md FROM (
  SELECT r.model, r.lang, r.book, replace(r.page, '.md', '.jpg') AS page, r.md,
         row_number() OVER (PARTITION BY r.model, r.lang, r.book ORDER BY replace(r.page, '.md', '.jpg')) AS pos
  FROM {_WANTED} r WHERE NOT EXISTS (SELECT 1 FROM preds p WHERE p.model = r.model
     AND p.lang = r.lang AND p.book = r.book AND p.page = r.page))"""


@register("pending_pages", lambda: _eval_sql(f"""SELECT r.model, r.lang, r.book, count(*) AS n_total,
  CAST(count(p.page) AS BIGINT) AS n_done, CAST(count(*) - count(p.page) AS BIGINT) AS n_pending
FROM {_WANTED} r LEFT JOIN preds p USING (model, lang, book, page)
GROUP BY r.model, r.lang, r.book"""))
def q_pending_pages(spark, sf):
    images, done = _images_and_done(spark, sf)
    return PR.pending_counts(images, done, MODEL_BOOK)


@register("predict_batches", lambda: _eval_sql(f"SELECT model, lang, book, page, pos, batch FROM ({_PENDING})"))
def q_predict_batches(spark, sf):
    images, done = _images_and_done(spark, sf)
    return PR.number_batches(PR.pending_pages(images, done, MODEL_BOOK), book_key=MODEL_BOOK).select(*MODEL_BOOK, "page", "pos", "batch")


def size_model():
    """Stand-in for a loaded model: tells the sizes of the image URL and the prompt of every page."""
    import json

    def answer(messages):
        parts = [json.loads(m)[0]["content"] for m in messages]
        return [f"  # page\n\n{len(p[0]['image_url']['url'])} of image, {len(p[1]['text'])} of prompt  " for p in parts]

    return answer


@register("model_predictions", lambda: _eval_sql(f"""SELECT model, lang, book, replace(page, '.jpg', '.md') AS page, batch,
  '# page' || chr(10) || chr(10) || CAST(23 + 4 * ((strlen(md) + 2) // 3) AS VARCHAR) || ' of image, {len(PROMPT)} of prompt' AS md,
  string_split(model, '/')[-1] AS model_slug FROM ({_PENDING})"""))
def q_model_predictions(spark, sf):
    images, done = _images_and_done(spark, sf, texts=True)
    # batch numbers from the keys alone; the bytes join afterwards
    numbered = PR.number_batches(PR.pending_pages(images.drop("content"), done, MODEL_BOOK), book_key=MODEL_BOOK)
    batched = numbered.join(images, [*MODEL_BOOK, "page"]).withColumn("messages", PR.chat_messages(PR.data_url("content"), F.lit(PROMPT)))
    return PR.predict_batches(batched, setup=size_model)


@register("image_messages", lambda: f"""SELECT page_id, 'data:image/jpeg;base64,' || base64(encode(html)) AS data_url,
  'user' AS role, 'image_url' AS first_part, '{PROMPT}' AS prompt FROM pages""")
def q_image_messages(spark, sf):
    p = fx.table(spark, sf, "pages").select("page_id", F.col("html").cast("binary").alias("content"))
    m = p.select("page_id", PR.data_url("content").alias("data_url")).withColumn(
        "messages", PR.chat_messages("data_url", F.lit(PROMPT)))
    return m.select("page_id", "data_url", F.col("messages")[0]["role"].alias("role"),
                    F.col("messages")[0]["content"][0]["type"].alias("first_part"),
                    F.col("messages")[0]["content"][1]["text"].alias("prompt"))


@register("model_slug", lambda: _eval_sql(
    "SELECT DISTINCT model, string_split(model, '/')[-1] AS slug FROM preds"))
def q_model_slug(spark, sf):
    _, preds = _inputs(spark, sf)
    return preds.select("model").distinct().select("model", T.model_slug("model").alias("slug"))


# ---------------------------------------------------------------- sources

from folio.sources import catalog as CAT  # noqa: E402


@register("catalog_candidates", lambda: """SELECT lang, id AS book_id, title, array_to_string(['Author ' || source], '; ') AS authors,
  CASE id % 3 WHEN 0 THEN 'https://books.example/' || id || '.epub' ELSE 'https://books.example/' || id || '.epub3' END AS epub_url,
  row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || CAST(id AS VARCHAR)), id) AS cand_rank
FROM (SELECT lang, source, min(doc_id) AS id, string_split(arg_min(text, doc_id), chr(10))[1] AS title
      FROM documents GROUP BY lang, source) WHERE id % 3 <> 2""")
def q_catalog_candidates(spark, sf):
    c = CAT.candidates(fx.catalog_raw(spark, sf))
    return c.withColumn("authors", F.array_join("authors", "; "))


def _embedding_sql(size):
    return f"""WITH tv AS (
  SELECT vec_id // {size} AS pair_id, CASE WHEN vec_id % 2 = 0 THEN 'ref' ELSE 'hyp' END AS side, vec_id,
         CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
sims AS (
  SELECT h.pair_id, h.vec_id AS hid, r.vec_id AS rid,
         list_dot_product(h.v, r.v) / (sqrt(list_dot_product(h.v, h.v)) * sqrt(list_dot_product(r.v, r.v))) AS s
  FROM tv h JOIN tv r ON h.pair_id = r.pair_id AND h.side = 'hyp' AND r.side = 'ref'),
pr AS (SELECT pair_id, avg(m) AS p FROM (SELECT pair_id, hid, max(s) AS m FROM sims GROUP BY ALL) GROUP BY pair_id),
rc AS (SELECT pair_id, avg(m) AS r FROM (SELECT pair_id, rid, max(s) AS m FROM sims GROUP BY ALL) GROUP BY pair_id),
cnt AS (SELECT pair_id, count(*) FILTER (WHERE side = 'ref') AS n_ref, count(*) FILTER (WHERE side = 'hyp') AS n_hyp FROM tv GROUP BY pair_id)
SELECT c.pair_id, c.n_ref, c.n_hyp, round_even(coalesce(p, 0.0), 6) AS precision, round_even(coalesce(r, 0.0), 6) AS recall,
  CASE WHEN n_ref = 0 AND n_hyp = 0 THEN 1.0 WHEN n_ref = 0 OR n_hyp = 0 THEN 0.0 WHEN p + r = 0 THEN 0.0
       ELSE round_even(2 * p * r / (p + r), 6) END AS bert_f1
FROM cnt c LEFT JOIN pr USING (pair_id) LEFT JOIN rc USING (pair_id)"""


@register("greedy_embedding_match", lambda: _embedding_sql(16))
def q_greedy_embedding_match(spark, sf):
    e = fx.table(spark, sf, "embeddings")
    tv = e.select(F.floor(F.col("vec_id") / 16).cast("bigint").alias("pair_id"),
                  F.when(F.col("vec_id") % 2 == 0, "ref").otherwise("hyp").alias("side"),
                  F.col("embedding").alias("vec"))
    m = M.greedy_embedding_match(tv, ["pair_id"])
    return m.select("pair_id", "n_ref", "n_hyp", F.bround("precision", 6).alias("precision"),
                    F.bround("recall", 6).alias("recall"), "bert_f1")


@register("tiled_embedding_match", lambda: _embedding_sql(512))
def q_tiled_embedding_match(spark, sf):
    """The same match over long pairs, in tiles of about 64 vectors."""
    from folio.operators.embed_match import tiled_embedding_match
    tv = fx.table(spark, sf, "embeddings").select(F.floor(F.col("vec_id") / 512).cast("bigint").alias("pair_id"),
                                                  F.when(F.col("vec_id") % 2 == 0, "ref").otherwise("hyp").alias("side"), F.col("embedding").alias("vec"))
    m = tiled_embedding_match(tv, ["pair_id"], tile=64)
    return m.select("pair_id", "n_ref", "n_hyp", F.bround("precision", 6).alias("precision"), F.bround("recall", 6).alias("recall"), "bert_f1")


@register("corpus_embedding", lambda: f"""SELECT count(*) AS n_pairs, coalesce(round_even(avg(bert_f1), 4), 0.0) AS corpus_bert_f1
FROM ({REGISTRY["greedy_embedding_match"][1]()})""")
def q_corpus_embedding(spark, sf):
    return M.corpus_embedding_score(q_greedy_embedding_match(spark, sf))


from folio.sources import epub as EP  # noqa: E402


def _opf_sql(select):
    return f"""WITH p AS (SELECT *, 'b' || CAST(page_id // 10 AS VARCHAR) AS book_id FROM pages),
man AS (SELECT book_id, 'i' || CAST(page_id AS VARCHAR) AS item_id,
               'p' || CAST(page_id AS VARCHAR) || CASE WHEN page_id % 7 = 0 THEN '.css' ELSE '.xhtml' END AS href, page_id
        FROM p WHERE page_id % 11 <> 0),
spine AS (SELECT book_id, 'i' || CAST(page_id AS VARCHAR) AS idref,
                 row_number() OVER (PARTITION BY book_id ORDER BY page_id DESC) - 1 AS spine_pos FROM p),
members AS (SELECT book_id, 'OEBPS/p' || CAST(page_id AS VARCHAR) || '.xhtml' AS entry_path, html FROM p WHERE page_id % 13 <> 0)
{select}"""


@register("opf_spine", lambda: _opf_sql("""SELECT s.book_id, s.spine_pos, s.idref, 'OEBPS/' || m.href AS entry_path,
  CAST(length(mb.html) AS BIGINT) AS html_chars
FROM spine s JOIN man m ON m.book_id = s.book_id AND m.item_id = s.idref
JOIN members mb ON mb.book_id = s.book_id AND mb.entry_path = 'OEBPS/' || m.href
WHERE lower(m.href) SIMILAR TO '.*\\.(html|xhtml|htm)'"""))
def q_opf_spine(spark, sf):
    parts = fx.epub_parts(spark, sf).select("book_id", "entry_path", F.encode("text", "UTF-8").alias("content"))
    s = EP.opf_spine(parts)
    return s.select("book_id", "spine_pos", "idref", "entry_path", F.length("html").cast("bigint").alias("html_chars"))


@register("archive_spine", lambda: REGISTRY["opf_spine"][1]())
def q_archive_spine(spark, sf):
    s = EP.archive_spine(fx.epub_archives(spark, sf)).filter("error is null")
    return s.select("book_id", "spine_pos", "idref", "entry_path", F.length("html").cast("bigint").alias("html_chars"))


def _epub_entries_sql():
    c = fx.CONTAINER_XML.replace("'", "''")
    return f"""WITH p AS (SELECT *, 'b' || CAST(page_id // 10 AS VARCHAR) AS book_id FROM pages),
opf AS (
  SELECT book_id, '<?xml version="1.0"?><package xmlns="http://www.idpf.org/2007/opf" version="3.0"><manifest>'
    || string_agg(CASE WHEN page_id % 11 = 0 THEN '<item id="i' || page_id || '" media-type="text/html"/>'
                       ELSE '<item id="i' || page_id || '" href="p' || page_id ||
                            CASE WHEN page_id % 7 = 0 THEN '.css' ELSE '.xhtml' END || '" media-type="application/xhtml+xml"/>' END,
                  '' ORDER BY page_id)
    || '</manifest><spine>' || string_agg('<itemref idref="i' || page_id || '"/>', '' ORDER BY page_id DESC)
    || '</spine></package>' AS x
  FROM p GROUP BY book_id)
SELECT book_id, 'mimetype' AS entry_path, CAST(strlen('application/epub+zip') AS BIGINT) AS n_bytes, CAST(NULL AS VARCHAR) AS error FROM opf
UNION ALL SELECT book_id, 'META-INF/container.xml', CAST(strlen('{c}') AS BIGINT), NULL FROM opf
UNION ALL SELECT book_id, 'OEBPS/content.opf', CAST(strlen(x) AS BIGINT), NULL FROM opf
UNION ALL SELECT book_id, 'OEBPS/p' || page_id || '.xhtml', CAST(strlen(html) AS BIGINT), NULL FROM p WHERE page_id % 13 <> 0"""


@register("epub_entries", _epub_entries_sql)
def q_epub_entries(spark, sf):
    e = EP.epub_entries(fx.epub_archives(spark, sf))
    return e.select("book_id", "entry_path", F.length("content").cast("bigint").alias("n_bytes"), "error")


# ---------------------------------------------------------------- files and streaming

from folio.session import shared_path  # noqa: E402
from folio.sources import files as FS  # noqa: E402


def _run_dir(spark, sf, name):
    import hashlib
    import time
    tag = hashlib.md5(f"{sf}|{time.time_ns()}".encode()).hexdigest()[:10]
    return shared_path(spark, f"folio-{name}-{tag}")


CATALOG_LANGUAGES = ("fr", "de")


@register("catalog_files", lambda: f"SELECT * FROM ({REGISTRY['catalog_candidates'][1]()}) WHERE lang IN {CATALOG_LANGUAGES}")
def q_catalog_files(spark, sf):
    """The catalog as landed API pages (JSON lines), read back and filtered by language."""
    root = _run_dir(spark, sf, "catalog")
    raw = fx.catalog_raw(spark, sf)
    book = F.struct("id", "title", "authors", "languages", "formats")
    books = raw.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("pos", F.to_json(book).alias("b")))).alias("bs"))
    page = F.concat(F.lit('{"page": '), F.col("page").cast("string"), F.lit(', "results": ['), F.array_join(F.transform("bs", lambda x: x["b"]), ", "), F.lit("]}"))
    books.select(page.alias("value")).write.text(root)
    c = CAT.candidates(CAT.read_catalog(spark, root), languages=CATALOG_LANGUAGES)
    return c.withColumn("authors", F.array_join("authors", "; "))


def _land_pages(spark, sf, root, pages=None, odd=True):
    """The catalog as JSON lines with ``next`` links; with ``odd`` a book whose id is a multiple of 7 has a number
    for its title, one of 4 a further field, and every page is followed by its first 30 characters, cut off."""
    raw = fx.catalog_raw(spark, sf)
    book = F.to_json(F.struct("id", "title", "authors", "languages", "formats"))
    if odd:
        book = F.when(F.col("id") % 7 == 0, F.to_json(F.struct("id", F.col("id").alias("title"), "authors", "languages", "formats"))).when(
            F.col("id") % 4 == 0, F.to_json(F.struct("id", "title", "authors", "languages", "formats", F.struct("pos").alias("extra")))).otherwise(book)
    books = raw.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("pos", book.alias("b")))).alias("bs"))
    last = raw.agg(F.max("page")).first()[0]
    link = F.when(F.col("page") < F.lit(last), F.concat(F.lit('"https://books.example/?page='), (F.col("page") + 1).cast("string"), F.lit('"'))).otherwise("null")
    page = F.concat(F.lit('{"page": '), F.col("page").cast("string"), F.lit(', "next": '), link, F.lit(', "results": ['),
                    F.array_join(F.transform("bs", lambda x: x["b"]), ", "), F.lit("]}"))
    lines = (books if pages is None else books.filter(pages)).select(page.alias("value"))
    if odd:
        lines = lines.select(F.explode(F.array("value", F.substring("value", 1, 30))).alias("value"))
    lines.write.text(root)


@register("catalog_landed", lambda: f"""SELECT * REPLACE (CASE WHEN book_id % 7 = 0 THEN NULL ELSE title END AS title)
FROM ({REGISTRY['catalog_candidates'][1]()})""")
def q_catalog_landed(spark, sf):
    """Candidates from pages with mistyped, further and unreadable parts."""
    from folio.sources import landed as L
    root = _run_dir(spark, sf, "landed")
    _land_pages(spark, sf, root)
    c = CAT.candidates(L.catalog_books(L.landed_pages(spark, root)))
    return c.withColumn("authors", F.array_join("authors", "; "))


@register("catalog_gaps", lambda: """WITH b AS (SELECT id, row_number() OVER (PARTITION BY lang ORDER BY id) - 1 AS r
  FROM (SELECT lang, source, min(doc_id) AS id FROM documents GROUP BY lang, source)),
p AS (SELECT DISTINCT page FROM (SELECT r // 8 + 1 AS page FROM b UNION ALL SELECT r // 8 + 2 FROM b WHERE id % 5 = 0)),
here AS (SELECT page FROM p WHERE page % 3 <> 0)
SELECT page + 1 AS page, 'not landed' AS what, 1 AS n FROM here WHERE page < (SELECT max(page) FROM p) AND page + 1 NOT IN (SELECT page FROM here)
UNION ALL SELECT NULL, 'no JSON', count(*) FROM here HAVING count(*) > 0""")
def q_catalog_gaps(spark, sf):
    """What is missing of a catalog of which every third page did not land."""
    from folio.sources import landed as L
    root = _run_dir(spark, sf, "gaps")
    _land_pages(spark, sf, root, F.col("page") % 3 != 0)
    pages = L.landed_pages(spark, root)
    gone = L.missing_pages(pages).select("page", F.lit("not landed").alias("what"))
    return gone.unionByName(L.landed_errors(pages).select("page", F.col("error").alias("what"))).groupBy("page", "what").agg(F.count("*").alias("n"))


@register("md_files", lambda: _eval_sql("SELECT lang, book, page, md FROM refs"))
def q_md_files(spark, sf):
    refs, _ = _inputs(spark, sf)
    root = _run_dir(spark, sf, "pages")
    FS.write_pages(refs, root)
    return FS.read_pages(spark, root)


@register("page_tree_files", lambda: _eval_sql("SELECT lang, book, page, md FROM refs"))
def q_page_tree_files(spark, sf):
    """The reference pages as files <lang>/<book>/pages/page_0007.md, read back."""
    from folio.sources import page_tree as PT
    PT.register(spark)
    refs, _ = _inputs(spark, sf)
    root = _run_dir(spark, sf, "tree")
    refs.write.format("page_tree").mode("append").save(root)
    return spark.read.format("page_tree").load(root)


@register("bucketed_scores", lambda: REGISTRY["eval_scores"][1]())
def q_bucketed_scores(spark, sf):
    """The scores from tables bucketed by page, the second model written after the first."""
    from folio.operators import layout as L
    refs, preds = _inputs(spark, sf)
    root = _run_dir(spark, sf, "buckets")
    r, p = (f"{name}_{root.rsplit('-', 1)[1]}" for name in ("folio_refs", "folio_preds"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    L.write_references(refs, r, f"{root}/refs", buckets)
    for model in MODELS:
        L.write_predictions(preds, p, f"{root}/preds", buckets, [model])
    return L.bucketed_scores(spark, r, p).withColumn("bleu", F.bround("bleu", 6))


@register("incremental_scores", lambda: _eval_sql(
    f"SELECT model, lang, book, page, ned, similarity, round_even(bleu, 6) AS bleu, struct_f1 FROM scores "
    ""))
def q_incremental_scores(spark, sf):
    from folio.streaming.incremental import read_scores, start_incremental_scores
    refs, preds = _inputs(spark, sf)
    base = _run_dir(spark, sf, "stream")
    preds.write.mode("overwrite").option("compression", "zstd").partitionBy("model").parquet(f"{base}/pred")
    q = start_incremental_scores(spark, refs, f"{base}/pred", f"{base}/scores", f"{base}/ckpt")
    q.awaitTermination()
    return read_scores(spark, f"{base}/scores").withColumn("bleu", F.bround("bleu", 6))


@register("late_references", lambda: REGISTRY["incremental_scores"][1]())
def q_late_references(spark, sf):
    """Predictions before their references, references before predictions, and amended predictions, the
    job stopped and started after each landing: the scores are those of the whole."""
    from folio.streaming.incremental import read_scores, start_scores
    refs, preds = _inputs(spark, sf)
    base = _run_dir(spark, sf, "late")
    ref_dir, pred_dir = f"{base}/ref", f"{base}/pred"
    early = F.pmod(F.xxhash64("page"), F.lit(2)) == 0
    first = preds.filter(F.col("model") == fx.MODEL_A).withColumn("md", F.when(early, F.reverse("md")).otherwise(F.col("md")))
    rest = preds.filter((F.col("model") == fx.MODEL_B) | early)
    refs.filter("false").select("lang", "book", "page", "md").write.parquet(ref_dir)
    for rows, path in ((first, pred_dir), (refs.select("lang", "book", "page", "md"), ref_dir), (rest, pred_dir)):
        rows.write.mode("append").option("compression", "zstd").parquet(path)
        start_scores(spark, ref_dir, pred_dir, f"{base}/scores", f"{base}/ckpt").awaitTermination()
    return read_scores(spark, f"{base}/scores").withColumn("bleu", F.bround("bleu", 6))
