"""DuckDB SQL twins of the registered queries (independent formulations).

DuckDB's regex engine has no look-around, so splits that keep a marker use a
sentinel character first; greedy packing is a recursive CTE over paragraphs;
element runs are gaps-and-islands over numbered lines.
"""

from __future__ import annotations

from folio.functions.text import PY_WHITESPACE
from folio.params import Params

WS = PY_WHITESPACE.replace("'", "''")


def strip(x: str) -> str:
    return f"trim({x}, '{WS}')"


def sections_sql() -> str:
    return (
        "SELECT lang, lang || '_' || source AS book_id, doc_id AS section_pos, "
        "'d' || CAST(doc_id AS VARCHAR) AS section_id, "
        "replace(text, chr(10), chr(10) || chr(10)) AS md FROM documents"
    )


def rich_line_sql(x: str, i: str) -> str:
    s = f"CAST({i} AS VARCHAR)"
    return (
        f"CASE {i} % 9 WHEN 0 THEN '## ' || {x} WHEN 1 THEN '- ' || {x} "
        f"WHEN 2 THEN '> ' || {x} WHEN 3 THEN '**' || {x} || '** [^' || {s} || ']' "
        f"WHEN 4 THEN '*' || {x} || '*' WHEN 5 THEN '$x_' || {s} || '$ ' || {x} "
        f"WHEN 6 THEN '![pic ' || {s} || '](images/' || {s} || '.png) ' || {x} "
        f"WHEN 7 THEN '[p. ' || {s} || '] ' || {x} ELSE {x} END"
    )


def rich_sections_sql() -> str:
    return (
        "SELECT lang, lang || '_' || source AS book_id, doc_id AS section_pos, "
        "'d' || CAST(doc_id AS VARCHAR) AS section_id, "
        f"array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: {rich_line_sql('x', '(i - 1)')}), "
        "chr(10) || chr(10)) AS md FROM documents"
    )


def chunks_ctes(sections: str, p: Params) -> str:
    """CTEs ending in ``chunks(lang, book_id, section_pos, piece_pos, chunk_idx, n_chunks, section_id, md)``."""
    lim, mn = p.page_chars, p.min_md_chars
    return f"""
sec AS (SELECT lang, book_id, section_pos, section_id, {strip('md')} AS s FROM ({sections}) WHERE length({strip('md')}) >= {mn}),
mpieces AS (
  SELECT lang, book_id, section_pos, section_id, piece, k FROM (
    SELECT lang, book_id, section_pos, section_id, {strip('u.piece')} AS piece, u.k AS k
    FROM sec, LATERAL (SELECT unnest(string_split(regexp_replace(s, '\\[p\\. ([0-9]+)\\]', chr(1) || '[p. \\1]', 'g'), chr(1))) AS piece,
                              generate_subscripts(string_split(regexp_replace(s, '\\[p\\. ([0-9]+)\\]', chr(1) || '[p. \\1]', 'g'), chr(1)), 1) AS k) u
  ) WHERE length(piece) >= {mn}
),
mcount AS (SELECT book_id, section_pos, count(*) AS n FROM mpieces GROUP BY ALL),
bymarker AS (
  SELECT m.lang, m.book_id, m.section_pos, m.section_id,
         row_number() OVER (PARTITION BY m.book_id, m.section_pos ORDER BY m.k) - 1 AS piece_pos,
         m.piece || chr(10) AS md
  FROM mpieces m JOIN mcount c USING (book_id, section_pos) WHERE c.n >= 2
),
paras AS (
  SELECT lang, book_id, section_pos, section_id,
         row_number() OVER (PARTITION BY book_id, section_pos ORDER BY k) AS k, p
  FROM (
    SELECT lang, book_id, section_pos, section_id, {strip('u.p')} AS p, u.k AS k
    FROM sec, LATERAL (SELECT unnest(string_split_regex(s, '\\n{{2,}}')) AS p,
                              generate_subscripts(string_split_regex(s, '\\n{{2,}}'), 1) AS k) u
    WHERE NOT EXISTS (SELECT 1 FROM mcount c WHERE c.book_id = sec.book_id AND c.section_pos = sec.section_pos AND c.n >= 2)
  ) WHERE p <> ''
),
walk(book_id, section_pos, k, blk, run_after) AS (
  SELECT book_id, section_pos, k, 0, length(p) FROM paras WHERE k = 1
  UNION ALL
  SELECT p.book_id, p.section_pos, p.k,
         CASE WHEN w.run_after >= {lim} THEN w.blk + 1 ELSE w.blk END,
         CASE WHEN w.run_after >= {lim} THEN length(p.p) ELSE w.run_after + length(p.p) END
  FROM walk w JOIN paras p ON p.book_id = w.book_id AND p.section_pos = w.section_pos AND p.k = w.k + 1
),
blocks AS (
  SELECT p.lang, p.book_id, p.section_pos, p.section_id, w.blk AS piece_pos,
         string_agg(p.p, chr(10) || chr(10) ORDER BY p.k) AS body,
         arg_max(w.run_after, w.k) AS last_run
  FROM paras p JOIN walk w USING (book_id, section_pos, k)
  GROUP BY ALL
),
bypack AS (
  SELECT lang, book_id, section_pos, section_id, piece_pos, body || chr(10) AS md
  FROM blocks WHERE last_run >= {lim} OR length(body) >= {mn}
),
pieces AS (SELECT * FROM bymarker UNION ALL SELECT * FROM bypack),
chunks AS (
  SELECT lang, book_id, section_pos, piece_pos,
         row_number() OVER (PARTITION BY book_id ORDER BY section_pos, piece_pos) - 1 AS chunk_idx,
         count(*) OVER (PARTITION BY book_id) AS n_chunks, section_id, md
  FROM pieces
)"""


def zone_sql(idx: str, n: str, p: Params) -> str:
    m = f"least({p.n_front_mandatory}, {n})"
    fs = f"greatest({p.strata_map['front'] + 1}, ({n} - {m}) // 10)"
    w = f"least({fs}, ({n} - {m}) // 3)"
    return (f"CASE WHEN {idx} < {m} THEN 'mandatory' WHEN {idx} < {m} + {w} THEN 'front' "
            f"WHEN {idx} < {n} - {w} THEN 'body' ELSE 'back' END")


def sample_ctes(p: Params) -> str:
    """After ``chunks_ctes``: zoned, sampled, rendered, pages, gate."""
    ks = " ".join(f"WHEN '{z}' THEN {k}" for z, k in p.strata)
    return f""",
zoned AS (SELECT book_id, chunk_idx, n_chunks, section_pos, {zone_sql('chunk_idx', 'n_chunks', p)} AS zone FROM chunks),
ranked AS (
  SELECT book_id, chunk_idx, zone,
         row_number() OVER (PARTITION BY book_id, zone ORDER BY
            CASE WHEN zone = 'mandatory' THEN lpad(CAST(chunk_idx AS VARCHAR), 20, '0')
                 ELSE md5('{p.seed}|' || book_id || '|' || CAST(chunk_idx AS VARCHAR)) END, chunk_idx) AS sample_pos
  FROM zoned WHERE n_chunks >= 10
),
sampled AS (
  SELECT book_id, chunk_idx, zone, sample_pos FROM ranked
  WHERE sample_pos <= CASE zone WHEN 'mandatory' THEN {p.n_front_mandatory} {ks} END
),
rendered AS (
  SELECT book_id, chunk_idx FROM chunks
  WHERE section_pos NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND quality = 0)
),
pages AS (SELECT s.* FROM sampled s SEMI JOIN rendered r USING (book_id, chunk_idx)),
gate AS (
  SELECT b.book_id, b.n_chunks,
         coalesce(s.n_sampled, 0) AS n_sampled, coalesce(g.n_pages, 0) AS n_pages,
         b.n_chunks >= 10 AND coalesce(g.n_pages, 0) >= {p.n_pages} AS accepted
  FROM (SELECT book_id, max(n_chunks) AS n_chunks FROM chunks GROUP BY book_id) b
  LEFT JOIN (SELECT book_id, count(*) AS n_sampled FROM sampled GROUP BY book_id) s USING (book_id)
  LEFT JOIN (SELECT book_id, count(*) AS n_pages FROM pages GROUP BY book_id) g USING (book_id)
)"""


def books_sql(seed: str = "42") -> str:
    return f"""SELECT lang, book_id, title, authors,
       row_number() OVER (PARTITION BY lang ORDER BY md5('{seed}|' || book_id)) AS cand_rank
FROM (
  SELECT lang, lang || '_' || source AS book_id,
         string_split(arg_min(text, doc_id), chr(10))[1] AS title,
         ['Author ' || source] AS authors
  FROM documents GROUP BY lang, source
)"""


def slug_sql(title: str) -> str:
    return f"trim(left(regexp_replace({title}, '[^\\p{{L}}\\p{{N}}\\p{{M}}_\\-]', '_', 'g'), 60), '_')"


# ---------------------------------------------------------------- evaluation

# Oracle-only: DuckDB's levenshtein counts bytes. The fixture text holds exactly these
# 21 non-ASCII letters; each is mapped to its own control byte so that byte distance
# equals code-point distance.
NON_ASCII = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü"
CTRL = "".join(chr(c) for c in list(range(1, 9)) + [11, 12] + list(range(14, 25)))
WS_RE = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in PY_WHITESPACE) + "]"


def norm_sql(x: str) -> str:
    y = f"regexp_replace(nfc_normalize({x}), '\\r\\n|\\r', chr(10), 'g')"
    y = f"regexp_replace({y}, '[ \\t]+', ' ', 'g')"
    y = f"regexp_replace({y}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return strip(y)


def tok13a_sql(x: str) -> str:
    y = f"rtrim({x}, '{WS}')"
    for a, b in (("'<skipped>'", "''"), ("'-' || chr(10)", "''"), ("chr(10)", "' '"),
                 ("'&quot;'", "'\"'"), ("'&amp;'", "'&'"), ("'&lt;'", "'<'"), ("'&gt;'", "'>'")):
        y = f"replace({y}, {a}, {b})"
    y = f"(' ' || {y} || ' ')"
    for pat, rep in ((r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "),
                     (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 ")):
        y = f"regexp_replace({y}, '{pat}', '{rep}', 'g')"
    return f"list_filter(string_split_regex({strip(y)}, '{WS_RE}+'), lambda t: t <> '')"


def ntok_sql(x: str) -> str:
    return f"lower({strip(f'regexp_replace({x}, {chr(39)}{WS_RE}+{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')})"


def inline_sql(x: str) -> str:
    y = f"regexp_replace({x}, '!\\[([^\\]]*)\\]\\([^)]*\\)', ' \\1 ', 'g')"
    y = f"regexp_replace({y}, '\\[([^\\]]*)\\]\\([^)]*\\)', ' \\1 ', 'g')"
    y = f"regexp_replace({y}, '`[^`]*`', ' ', 'g')"
    return f"regexp_replace({y}, '\\*+|~~', ' ', 'g')"


def elements_sql(t: str) -> str:
    """list<struct(type, token)> of a text, RE2 forms of the element contract (all but the types of ``block_ctes``)."""
    fence = ("(?ms)^ {0,3}```.*?(?:^ {0,3}```[^\\n]*(?:\\n|\\z)|\\z)|"
             "^ {0,3}~~~.*?(?:^ {0,3}~~~[^\\n]*(?:\\n|\\z)|\\z)")
    quote = "(?m)(?:^ {0,3}>[^\\n]*(?:\\n|\\z))+"
    delim = "[ \\t]*\\|?(?:[ \\t]*:?-+:?[ \\t]*\\|)+(?:[ \\t]*:?-+:?[ \\t]*)?"
    table = "(?m)^([^\\n|]*\\|[^\\n]*)\\n(" + delim + ")(?:\\n|\\z)((?:[^\\n|]*\\|[^\\n]*(?:\\n|\\z))*)"
    image = "!\\[([^\\]]*)\\]\\([^)]*\\)"
    no_code = f"regexp_replace({t}, '{fence}', chr(10), 'g')"
    no_quote = f"regexp_replace({no_code}, '{quote}', chr(10), 'g')"
    rest = f"regexp_replace({no_quote}, '{table}', chr(10), 'g')"
    bi = "(?s)\\*{3}(.+?)\\*{3}"
    bo = "(?s)\\*{2}(.+?)\\*{2}"
    mb = "(?s)\\$\\$(.*?)\\$\\$"

    def typed(lst, kind, norm=False, inline=False):
        body = "x"
        if inline:
            body = inline_sql(body)
        if norm:
            body = ntok_sql(body)
        return f"list_transform({lst}, lambda x: {{'type': '{kind}', 'token': {body}}})"

    cells = (f"flatten(list_transform(list_filter(flatten(list_transform(regexp_extract_all({no_quote}, '{table}', 3), "
             f"lambda b: string_split(b, chr(10)))), lambda r: trim(r) <> ''), "
             f"lambda r: string_split(regexp_replace(regexp_replace(r, '^[ \\t]*\\|', ''), '\\|[ \\t]*$', ''), '|')))")
    fref = (f"list_transform(list_filter(regexp_extract_all({t}, '\\[\\^\\w+\\]:?', 0), lambda m: NOT suffix(m, ':')), "
            f"lambda m: regexp_extract(m, '\\[\\^(\\w+)\\]', 1))")
    no_bi = f"regexp_replace({t}, '{bi}', ' ', 'g')"
    no_bo = f"regexp_replace({no_bi}, '{bo}', ' ', 'g')"
    parts = [
        typed(cells, "tables", True, True),
        typed(f"regexp_extract_all({t}, '{mb}', 1)", "math_block", True),
        typed(f"regexp_extract_all(regexp_replace({t}, '{mb}', '', 'g'), '\\$([^\\$\\n]+?)\\$', 1)", "math_inline", True),
        typed(f"regexp_extract_all({t}, '\\[p\\.\\s*([0-9]+)\\]', 1)", "page_nums"),
        typed(fref, "footnotes"),
        typed(f"regexp_extract_all({t}, '(?m)^\\[\\^\\w+\\]:\\s*(.+)', 1)", "footnote_defs", True),
        typed(f"regexp_extract_all({rest}, '{image}', 1)", "images", True, True),
        typed(f"regexp_extract_all({no_bi}, '{bo}', 1)", "bold", True),
        typed(f"regexp_extract_all({no_bo}, '\\*([^*\\n]+)\\*', 1)", "italic", True),
        typed(f"regexp_extract_all({t}, '{bi}', 1)", "bold_italic", True),
    ]
    return "list_concat(" + ", ".join(parts) + ")"


def block_markdown_sql() -> str:
    from folio.plans.fixtures import BLOCK_FORMS

    x = "'w ' || trim(regexp_replace(line, '[^A-Za-z ]', '', 'g'))"
    cases = []
    for k, form in enumerate(BLOCK_FORMS):
        head, mark, tail = (y.replace("\n", "' || chr(10) || '") for y in form.partition("{x}"))
        cases.append(f"WHEN {k} THEN '{head}' || {x} || '{tail}'" if mark else f"WHEN {k} THEN ''")
    return (f"SELECT doc_id, string_agg(CASE (i - 1) % {len(BLOCK_FORMS)} {' '.join(cases)} END, chr(10) ORDER BY i) AS md "
            "FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) GROUP BY doc_id")


def block_ctes(src: str) -> str:
    """After ``src(rid, body)``, numbered Markdown texts: ``block_rows(rid, type, token)`` of headings, quotes and items, by
    gaps and islands over numbered lines. A line is lazy if it is text behind a line that leaves a paragraph open; islands of
    lazy lines hang on their first line, whose kind says what they belong to."""
    tok = ntok_sql(inline_sql("txt"))
    mark = "(?:[-*+]|[0-9]{1,9}[.)])"
    return f"""line AS (SELECT rid, unnest(string_split(body, chr(10))) AS x, generate_subscripts(string_split(body, chr(10)), 1) AS i FROM {src}),
kind AS (SELECT *, length(x) - length(ltrim(x, ' ')) AS ind, length(regexp_extract(x, '^ *{mark} +')) AS off,
  CASE WHEN trim(x, ' ' || chr(9)) = '' THEN 'blank' WHEN regexp_matches(x, '^ *>') THEN 'quote' WHEN regexp_matches(x, '^ *#{{1,6}}(?: |$)') THEN 'atx' WHEN regexp_matches(x, '^ *=+ *$') THEN 'eq'
       WHEN regexp_matches(x, '^ *-+ *$') THEN 'dash' WHEN regexp_matches(x, '^ *(?:(?:- *){{3,}}|(?:\\* *){{3,}}|(?:_ *){{3,}})$') THEN 'rule' WHEN regexp_matches(x, '^ *{mark} ') THEN 'item' ELSE 'text' END AS k FROM line),
seen AS (SELECT *, coalesce(k = 'text' AND lag(k) OVER w IN ('text', 'item', 'quote'), false) AS lazy FROM kind WINDOW w AS (PARTITION BY rid ORDER BY i)),
island AS (SELECT *, sum((NOT lazy)::INT) OVER (PARTITION BY rid ORDER BY i) AS para FROM seen),
led AS (SELECT *, first_value(k) OVER (PARTITION BY rid, para ORDER BY i) AS lead_k FROM island),
under AS (SELECT *, lag(para) OVER w AS para_above, lag(lead_k) OVER w AS above FROM led WINDOW w AS (PARTITION BY rid ORDER BY i)),
run AS (SELECT *, sum((lead_k = 'quote' AND above IS DISTINCT FROM 'quote')::INT) OVER (PARTITION BY rid ORDER BY i) AS quote_no FROM under),
quotes AS (SELECT rid, 'blockquotes' AS type, '' AS level, string_agg(regexp_replace(x, '^(?: *> ?)+', ''), chr(10) ORDER BY i) AS txt FROM run WHERE lead_k = 'quote' GROUP BY rid, quote_no),
heads AS (SELECT u.rid, 'headings' AS type, CASE u.k WHEN 'eq' THEN '1:' ELSE '2:' END AS level, string_agg(p.x, chr(10) ORDER BY p.i) AS txt
  FROM under u JOIN under p ON p.rid = u.rid AND p.para = u.para_above WHERE u.k IN ('eq', 'dash') AND u.above = 'text' GROUP BY u.rid, u.i, u.k
  UNION ALL SELECT rid, 'headings', length(regexp_extract(ltrim(x, ' '), '^#+')) || ':', regexp_replace(regexp_replace(x, '^ *#+ *', ''), '(?: +#+)? *$', '') FROM kind WHERE k = 'atx'),
ends AS (SELECT a.rid, a.i, coalesce(min(b.i), 1000000000) AS stop FROM seen a LEFT JOIN seen b ON b.rid = a.rid AND b.i > a.i AND b.k <> 'blank' AND NOT b.lazy AND b.ind < a.off
  WHERE a.k = 'item' GROUP BY a.rid, a.i),
items AS (SELECT e.rid, 'list_items' AS type, '' AS level, string_agg(regexp_replace(l.x, '^ *{mark} +', ''), chr(10) ORDER BY l.i) AS txt
  FROM ends e JOIN line l ON l.rid = e.rid AND l.i >= e.i AND l.i < e.stop GROUP BY e.rid, e.i),
block_rows AS (SELECT rid, type, level || {tok} AS token FROM (SELECT * FROM quotes UNION ALL SELECT * FROM heads UNION ALL SELECT * FROM items))"""


def block_elements_sql() -> str:
    """doc_id, type, token, cnt of headings, quotes and items of the FX13 texts."""
    return f"""WITH md AS ({block_markdown_sql()}), src AS (SELECT doc_id AS rid, md AS body FROM md),
{block_ctes('src')}
SELECT rid AS doc_id, type, token, count(*) AS cnt FROM block_rows GROUP BY ALL"""


def eval_ctes(model_a: str, model_b: str) -> str:
    """After chunks_ctes on the rich sections: refs, preds, pairs, normed, scores."""
    na, ct = NON_ASCII, CTRL
    return f""",
refs AS (SELECT lang, book_id AS book, printf('page_%04d.md', chunk_idx) AS page, section_pos, chunk_idx, md FROM chunks),
preds AS (
  SELECT '{model_a}' AS model, lang, book, page,
         replace(array_to_string(list_filter(string_split(md, chr(10)), lambda x, i: (i - 1) % 5 <> 4), chr(10)), 'tion', 't1on') AS md
  FROM refs WHERE section_pos NOT IN (SELECT doc_id FROM labels)
  UNION ALL
  SELECT '{model_b}', lang, book, page, replace(md, 'an', 'en') FROM refs
),
pairs AS (SELECT p.model, r.lang, r.book, r.page, r.md AS ref, p.md AS hyp FROM refs r JOIN preds p USING (lang, book, page)),
normed AS (SELECT *, {norm_sql('ref')} AS rn, {norm_sql('hyp')} AS hn FROM pairs),
neds AS (
  SELECT model, lang, book, page,
    CASE WHEN length(rn) = 0 AND length(hn) = 0 THEN 0.0 WHEN length(rn) = 0 OR length(hn) = 0 THEN 1.0
         ELSE round_even(CAST(levenshtein(translate(rn, '{na}', '{ct}'), translate(hn, '{na}', '{ct}')) AS DOUBLE)
                         / greatest(length(rn), length(hn)), 6) END AS ned
  FROM normed
),
toks AS (SELECT model, lang, book, page, {tok13a_sql('rn')} AS rt, {tok13a_sql('hn')} AS ht FROM normed),
grams AS (
  SELECT model, lang, book, page, n, array_to_string(rt[i:i + n - 1], ' ') AS g, 1 AS r, 0 AS h
  FROM toks, (VALUES (1), (2), (3), (4)) v(n), unnest(range(1, len(rt) - n + 2)) u(i)
  UNION ALL
  SELECT model, lang, book, page, n, array_to_string(ht[i:i + n - 1], ' ') AS g, 0, 1
  FROM toks, (VALUES (1), (2), (3), (4)) v(n), unnest(range(1, len(ht) - n + 2)) u(i)
),
gcount AS (SELECT model, lang, book, page, n, g, sum(r) AS rc, sum(h) AS hc FROM grams GROUP BY ALL),
gcorr AS (SELECT model, lang, book, page, n, sum(least(rc, hc)) AS c FROM gcount GROUP BY ALL),
bcounts AS (
  SELECT t.model, t.lang, t.book, t.page, len(t.rt) AS ref_len, len(t.ht) AS hyp_len,
    coalesce(max(c) FILTER (WHERE n = 1), 0) AS correct_1, coalesce(max(c) FILTER (WHERE n = 2), 0) AS correct_2,
    coalesce(max(c) FILTER (WHERE n = 3), 0) AS correct_3, coalesce(max(c) FILTER (WHERE n = 4), 0) AS correct_4
  FROM toks t LEFT JOIN gcorr g USING (model, lang, book, page) GROUP BY ALL
),
bz AS (
  SELECT *, greatest(hyp_len, 0) AS t1, greatest(hyp_len - 1, 0) AS t2, greatest(hyp_len - 2, 0) AS t3, greatest(hyp_len - 3, 0) AS t4,
    CAST(correct_1 = 0 AS INT) AS z1, CAST(correct_1 = 0 AS INT) + CAST(correct_2 = 0 AS INT) AS z2,
    CAST(correct_1 = 0 AS INT) + CAST(correct_2 = 0 AS INT) + CAST(correct_3 = 0 AS INT) AS z3,
    CAST(correct_1 = 0 AS INT) + CAST(correct_2 = 0 AS INT) + CAST(correct_3 = 0 AS INT) + CAST(correct_4 = 0 AS INT) AS z4,
    least(hyp_len, 4) AS eff
  FROM bcounts
),
bleus AS (
  SELECT model, lang, book, page,
    CASE WHEN greatest(correct_1, correct_2, correct_3, correct_4) > 0 THEN
      (CASE WHEN hyp_len >= ref_len THEN 1.0 WHEN hyp_len > 0 THEN exp(CAST(1.0 AS DOUBLE) - ref_len / greatest(hyp_len, 1)) ELSE 0.0 END)
      * exp(({" + ".join(f"(CASE WHEN {n} <= eff THEN ln(CASE WHEN correct_{n} = 0 THEN CAST(100.0 AS DOUBLE) / (pow(2.0, z{n}) * greatest(t{n}, 1)) ELSE CAST(100.0 AS DOUBLE) * correct_{n} / greatest(t{n}, 1) END) ELSE 0.0 END)" for n in range(1, 5))}) / greatest(eff, 1))
    ELSE 0.0 END AS bleu
  FROM bz
),
sided AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM (
  SELECT model, lang, book, page, 'ref' AS side, ref AS body FROM pairs UNION ALL SELECT model, lang, book, page, 'hyp', hyp FROM pairs)),
{block_ctes('sided')},
elems AS (
  SELECT model, lang, book, page, side, unnest({elements_sql('body')}, recursive := true) FROM sided
  UNION ALL
  SELECT model, lang, book, page, side, type, token FROM block_rows JOIN sided USING (rid)
),
ecount AS (SELECT model, lang, book, page, side, type, token, count(*) AS cnt FROM elems GROUP BY ALL),
etype AS (
  SELECT model, lang, book, page, type, sum(rc) AS rt, sum(hc) AS ht, sum(least(rc, hc)) AS tp FROM (
    SELECT model, lang, book, page, type, token,
           coalesce(sum(cnt) FILTER (WHERE side = 'ref'), 0) AS rc, coalesce(sum(cnt) FILTER (WHERE side = 'hyp'), 0) AS hc
    FROM ecount GROUP BY ALL) GROUP BY ALL
),
ef1 AS (
  SELECT *, CASE WHEN rt = 0 AND ht = 0 THEN 1.0 WHEN rt = 0 OR ht = 0 THEN 0.0
                 WHEN tp / greatest(ht, 1) + tp / greatest(rt, 1) = 0 THEN 0.0
                 ELSE round_even(CAST(2.0 AS DOUBLE) * (tp / greatest(ht, 1)) * (tp / greatest(rt, 1)) / ((tp / greatest(ht, 1)) + (tp / greatest(rt, 1))), 6) END AS f1
  FROM etype
),
sf1 AS (
  SELECT p.model, p.lang, p.book, p.page,
    CASE WHEN count(*) FILTER (WHERE rt > 0) > 0
         THEN round_even((0.0::DOUBLE + coalesce(max(f1) FILTER (WHERE type = 'headings' AND rt > 0), 0.0) + coalesce(max(f1) FILTER (WHERE type = 'tables' AND rt > 0), 0.0) + coalesce(max(f1) FILTER (WHERE type = 'math_block' AND rt > 0), 0.0) + coalesce(max(f1) FILTER (WHERE type = 'math_inline' AND rt > 0), 0.0) + coalesce(max(f1) FILTER (WHERE type = 'page_nums' AND rt > 0), 0.0) + coalesce(max(f1) FILTER (WHERE type = 'footnotes' AND rt > 0), 0.0) + coalesce(max(f1) FILTER (WHERE type = 'footnote_defs' AND rt > 0), 0.0) + coalesce(max(f1) FILTER (WHERE type = 'images' AND rt > 0), 0.0) + coalesce(max(f1) FILTER (WHERE type = 'list_items' AND rt > 0), 0.0) + coalesce(max(f1) FILTER (WHERE type = 'bold' AND rt > 0), 0.0) + coalesce(max(f1) FILTER (WHERE type = 'italic' AND rt > 0), 0.0) + coalesce(max(f1) FILTER (WHERE type = 'bold_italic' AND rt > 0), 0.0) + coalesce(max(f1) FILTER (WHERE type = 'blockquotes' AND rt > 0), 0.0)) / count(*) FILTER (WHERE rt > 0), 6) ELSE 1.0 END AS struct_f1
  FROM pairs p LEFT JOIN ef1 e USING (model, lang, book, page) GROUP BY ALL
),
scores AS (
  SELECT model, lang, book, page, n.ned, round_even(1.0 - n.ned, 6) AS similarity, b.bleu, s.struct_f1
  FROM neds n JOIN bleus b USING (model, lang, book, page) JOIN sf1 s USING (model, lang, book, page)
)"""


# ---------------------------------------------------------------- cleaning

def raw_markdown_sql() -> str:
    line = ("CASE (i - 1) % 12 WHEN 0 THEN '[' || x || ']{.c}' WHEN 1 THEN '[]{#a}' || x "
            "WHEN 2 THEN '[' || x || '](#a)' WHEN 3 THEN '[' || x || '](b.xhtml)' "
            "WHEN 4 THEN '[' || x || '](https://h/)' WHEN 5 THEN x || '^[[3]](n.html#f)^' "
            "WHEN 6 THEN x || '[[4]](n.html)' WHEN 7 THEN x || '^5^' WHEN 8 THEN '::: d' || chr(10) || x "
            "WHEN 9 THEN '| ' || x WHEN 10 THEN x || ' \\[pg!7\\]' "
            "ELSE '<span>' || x || '</span> ![fig](img/a.png) ![](img/b.png)' END")
    return ("SELECT doc_id, '---' || chr(10) || 'title: t' || chr(10) || '---' || chr(10) || "
            f"array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: {line}), chr(10)) AS md FROM documents")


def clean_rules_sql(x: str) -> list[tuple[str, str]]:
    """(rule id, expression after the rule) in order; RE2 forms (C4h via a sentinel)."""
    ws = WS_RE[1:-1]
    steps = []

    def rr(pat, rep, flags="g"):
        return lambda y: f"regexp_replace({y}, '{pat}', '{rep}', '{flags}')"

    rules = [
        ("C1", rr("(?s)\\A---\\n.*?\\n---\\n?", "", "")),
        ("C2", rr("(?m)^:{3,}[^\\n]*$", "")),
        ("C3", rr("(?m)^(#{1,6}[ \\t]+)\\[([^\\]]+)\\]\\([^)]*\\)([ \\t]*\\{[^}]*\\})*", "\\1\\2")),
        ("C4a", rr("\\[([^\\]]+)\\]\\{[^}\\n]{0,200}\\}", "\\1")),
        ("C4b", rr("\\[\\]\\{[^}]*\\}", "")),
        ("C4c", rr("\\[([^\\]\\n]+)\\]\\(#[^)]*\\)", "\\1")),
        ("C4d", rr("\\^\\[\\[([0-9]+)\\]\\]\\([^)]*\\)\\^", "[^\\1]")),
        ("C4e", rr("\\[\\[([0-9]+)\\]\\]\\([^)]*\\)", "[^\\1]")),
        ("C4f", rr("\\^\\[\\^([0-9]+)\\]\\^", "[^\\1]")),
        ("C4g", rr("\\^([0-9]+)\\^", "[^\\1]")),
        ("C4h", lambda y: ("replace(regexp_replace(regexp_replace(" + y + ", '\\]\\((https?://|mailto:)', ']' || chr(2) || '(\\1', 'g'), "
                           "'\\[([^\\]\\n]+)\\]\\([^)]+\\)', '\\1', 'g'), ']' || chr(2) || '(', '](')")),
        ("C4i", rr("\\[\\[([0-9]+)\\]\\]", "[^\\1]")),
        ("C4j", rr("\\[\\]", "")),
        ("C4k", rr("(?m)^\\| ([^|\\n]+)$", "\\1")),
        ("C5", rr("\\{[^}\\n]{0,200}\\}", "")),
        ("C6", rr("<[^>\\n]{0,200}>", "")),
        ("C7", rr("\\\\\\[[Pp]g[!." + ws + "]?([0-9]+)\\\\\\]", "[p. \\1]")),
        ("C8", lambda y: ("array_to_string(list_transform(string_split_regex(" + y + ", '!\\[([^\\]]*)\\]\\([^)]+\\)'), "
                          "lambda p, i: CASE WHEN i = 1 THEN p ELSE '![image_' || CAST(i - 1 AS VARCHAR) || "
                          "'](images/image_' || CAST(i - 1 AS VARCHAR) || '.png)' || p END), '')")),
        ("C9", rr("\\\\([!\"#$%&''()*+,\\-./:;<=>?@\\[\\\\\\]^_{|}~`])", "\\1")),
        ("C10", lambda y: f"regexp_replace({y}, '\\n{{3,}}', chr(10) || chr(10), 'g')"),
    ]
    cur = x
    for rid, fn in rules:
        cur = fn(cur)
        steps.append((rid, cur))
    return steps


# ---------------------------------------------------------------- HTML

def html_ctes(html_source: str) -> str:
    """CTEs hb (page_id, pos, tag, cls, text) and pm (+ promoted tag) from a (page_id, html) source."""
    # written out here, apart from the code under test; the pages hold no other tags and references
    block_tags = "p|div|h[1-6]|li|article|nav|footer|ul|body|html"
    entities = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
    heading_rules = ((r"title|book.?head|tit(o(lo)?)?|titel", 1), (r"h1|chap|chapter|parte|part[^i]|capit|kapitel", 2),
                     (r"h2|section|sezione|subchap|abschnitt|überschrift", 3), (r"h3|subsect|paragraph|paragrafo|absatz|unterab", 4), (r"h[45]", 5))
    x = "html"
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', '', 'g')"
    for t in ("head", "script", "style"):
        x = f"regexp_replace({x}, '(?is)<{t}\\b[^>]*>.*?</{t}\\s*>', '', 'g')"
    for pat, rep in ((r'(?is)<(b|strong)\b[^>]*>(.*?)</(?:b|strong)\s*>', r'**\2**'),
                     (r'(?is)<(i|em)\b[^>]*>(.*?)</(?:i|em)\s*>', r'*\2*'),
                     (r'(?is)<sup\b[^>]*>(.*?)</sup\s*>', r'^\1^'),
                     (r'(?is)<sub\b[^>]*>(.*?)</sub\s*>', r'~\1~'),
                     (r'(?is)<(del|s)\b[^>]*>(.*?)</(?:del|s)\s*>', r'~~\2~~'),
                     (r'(?is)<a\b[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>', r'[\2](\1)'),
                     (r'(?is)<img\b[^>]*?src\s*=\s*"([^"]*)"[^>]*?alt\s*=\s*"([^"]*)"[^>]*>', r'![\2](\1)'),
                     (r'(?is)<img\b[^>]*?src\s*=\s*"([^"]*)"[^>]*>', r'![](\1)')):
        x = f"regexp_replace({x}, '{pat}', '{rep}', 'g')"
    x = f"regexp_replace({x}, '(?i)<br\\s*/?>', chr(10), 'g')"
    x = f"regexp_replace({x}, '(?i)<({block_tags})\\b([^>]*)>', chr(1) || '\\1' || chr(2) || '\\2' || chr(2), 'g')"
    x = f"regexp_replace({x}, '(?i)</({block_tags})\\s*>', chr(1), 'g')"
    body = "regexp_replace(body, '<[^>]*>', '', 'g')"
    for ent, ch in entities:
        body = f"replace({body}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    text = strip(f"regexp_replace({body}, '{WS_RE}+', ' ', 'g')")
    lvl = "CASE " + " ".join(f"WHEN regexp_matches(cls, '(?i){pat}') THEN {n}" for pat, n in heading_rules) + " END"
    words = f"len(list_filter(string_split_regex({strip('text')}, '{WS_RE}+'), lambda w: w <> ''))"
    return f"""
src AS ({html_source}),
parts AS (
  SELECT page_id, u.k - 1 AS pos, u.p FROM src,
  LATERAL (SELECT unnest(string_split({x}, chr(1))) AS p, generate_subscripts(string_split({x}, chr(1)), 1) AS k) u
),
hraw AS (
  SELECT page_id, pos,
    CASE WHEN contains(p, chr(2)) THEN lower(string_split(p, chr(2))[1]) ELSE '' END AS tag,
    CASE WHEN contains(p, chr(2)) THEN regexp_extract(string_split(p, chr(2))[2], '(?i)class\\s*=\\s*"([^"]*)"', 1) ELSE '' END AS cls,
    CASE WHEN contains(p, chr(2)) THEN string_split(p, chr(2))[3] ELSE p END AS body
  FROM parts
),
hb AS (SELECT page_id, pos, tag, cls, {text} AS text FROM hraw),
pm AS (
  SELECT page_id, pos, cls, text,
    CASE WHEN tag IN ('p', 'div') AND cls <> '' AND ({lvl}) IS NOT NULL AND {words} <= 20
         THEN 'h' || CAST({lvl} AS VARCHAR) ELSE tag END AS tag
  FROM hb
),
pmd AS (
  SELECT s.page_id, coalesce(string_agg(CASE WHEN prev IS NULL THEN '' WHEN tag = 'li' AND prev = 'li' THEN chr(10) ELSE chr(10) || chr(10) END ||
      CASE WHEN regexp_matches(tag, '^h[1-6]$') THEN repeat('#', CAST(substr(tag, 2) AS INTEGER)) || ' ' || text
           WHEN tag = 'li' THEN '- ' || text ELSE text END,
      '' ORDER BY pos), '') AS md
  FROM src s LEFT JOIN (SELECT *, lag(tag) OVER (PARTITION BY page_id ORDER BY pos) AS prev FROM pm WHERE text <> '') b USING (page_id) GROUP BY s.page_id
),
pclean AS (SELECT page_id, {strip(clean_rules_sql('md')[-1][1])} || chr(10) AS md FROM pmd)"""


def classed_pages_sql() -> str:
    from folio.plans.fixtures import HEADING_CLASSES
    arr = "[" + ", ".join(f"'{c}'" for c in HEADING_CLASSES) + "]"
    return ("SELECT page_id, array_to_string(list_transform(string_split(html, '<p>'), lambda s, i: "
            f"CASE WHEN i = 1 THEN s ELSE '<p class=\"' || {arr}[((i - 2) % 6) + 1] || '\">' || s END), '') AS html FROM pages")
