"""Markdown structure elements of a text, as ``array<struct<type, token>>`` (in-row).

Eight element types come from targeted regular expressions (as in the metric's
definition); the five block types come from lines:

* fenced code (```/~~~, unclosed fence runs to the end) holds no block elements and parts the lines around it;
* headings (ATX and setext), block quotes with their lazy lines, list items with their nested items, and tables come
  from a line-state machine (``folio.functions.blocks``): a quote is one token and its lines hold no other block,
  a table gives one token per body cell (header cells are not counted), a heading is ``<level>:<text>``;
* image = alt text of ``![alt](src)`` outside quotes and tables.

Token text drops inline markup the way text-node extraction does: images and
links keep their text, code spans vanish, emphasis markers become spaces; then
white space is collapsed, the text stripped and lower-cased.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import blocks as B
from folio.functions.text import ODD_SPACE, WS_CLASS, col, normalise_token, stage

# The 13 element types, in report order.
ELEMENT_TYPES = (
    "headings", "tables", "math_block", "math_inline", "page_nums", "footnotes",
    "footnote_defs", "images", "list_items", "bold", "italic", "bold_italic", "blockquotes",
)

# The regex-extracted element patterns (Java dialect; (?d) keeps '.'/'^'/'$'
# to '\n' line ends and (?U) makes \w and \d Unicode aware, as in Python). What runs up to the next closing sign is written
# without a lazy loop, which would ask for that sign at every character.
RE_MATH_BLOCK = r"\$\$([^$]*+(?:\$(?!\$)[^$]*+)*+)\$\$"
RE_MATH_INLINE = r"\$([^\$\n]++)\$"
RE_PAGE_NUM = r"(?U)\[p\." + WS_CLASS + r"*(\d+)\]"
RE_FOOTNOTE_REF = r"(?U)\[\^(\w+)\](?!:)"
RE_FOOTNOTE_DEF = r"(?Umd)^\[\^(\w+)\]:" + WS_CLASS + r"*(.+)"
RE_BOLD_ITALIC = r"(?s)\*{3}(.[^*]*+(?:\*(?!\*\*)[^*]*+)*+)\*{3}"
RE_BOLD = r"(?s)\*{2}(.[^*]*+(?:\*(?!\*)[^*]*+)*+)\*{2}"
RE_ITALIC = r"\*([^*\n]++)\*"

# Fenced code. Java dialect; an unclosed fence runs to the end.
RE_FENCE = r"(?msd)^[ \t]*(```|~~~).*?(?:^[ \t]*\1[^\n]*(?:\n|\z)|\z)"
RE_IMAGE = r"!\[([^\]]*)\]\([^)]*\)"


def inline_text(x) -> Column:
    """Text content of inline Markdown (see module doc). ``x`` must be a column or a variable: it is read several times.
    A step needs signs that no earlier one makes, so the text itself says which are due."""
    plain = x = col(x)
    link = plain.contains("](")
    for due, pattern, by in ((link & plain.contains("!["), RE_IMAGE, " $1 "), (link, r"\[([^\]]*)\]\([^)]*\)", " $1 "),
                             (plain.contains("`"), r"`[^`]*`", " "), (plain.contains("*") | plain.contains("~~"), r"\*+|~~", " ")):
        x = F.when(due, F.regexp_replace(x, pattern, by)).otherwise(x)
    return x


def _no_text() -> Column:
    return F.array().cast("array<string>")


def _all(text: Column, sign: str, pattern: str, group: int = 1) -> Column:
    """All matches of a pattern that needs ``sign``; texts without it are only searched for that."""
    return F.when(text.contains(sign), F.regexp_extract_all(text, F.lit(pattern), group)).otherwise(_no_text())


def _without(text: Column, sign: str, pattern: str, by: str) -> Column:
    return F.when(text.contains(sign), F.regexp_replace(text, pattern, by)).otherwise(text)


def _typed(arr: Column, kind: str) -> Column:
    return F.transform(arr, lambda t: F.struct(F.lit(kind).alias("type"), t.alias("token")))


def _norm_all(arr: Column, odd: Column, inline: bool = False) -> Column:
    # an array of its own: the token is read several times
    return F.transform(F.transform(arr, inline_text) if inline else arr, lambda t: normalise_token(t, odd))


def _table_cells(bodies: Column) -> Column:
    rows = F.filter(F.flatten(F.transform(bodies, lambda b: F.split(b, "\n"))), lambda r: F.trim(r) != "")

    def cells(r):
        r = F.regexp_replace(F.regexp_replace(r, r"^[ \t]*\|", ""), r"\|[ \t]*$", "")
        return F.split(r, r"\|")

    return F.flatten(F.transform(rows, cells))


def with_elements(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with column ``out``: all 13 element types of one Markdown text as ``array<struct<type, token>>``.
    What is read several times is staged, so each is made once a row."""
    lines, info, blocks, rest, bi, odd = names = [f"_{out}_{x}" for x in ("lines", "info", "blocks", "rest", "bi", "odd")]
    whole = F.coalesce(F.col(text), F.lit(""))
    code_free = F.when(whole.contains("```") | whole.contains("~~~"), F.regexp_replace(whole, RE_FENCE, "\n")).otherwise(whole)
    made = stage(df, df.columns, **{lines: F.split(code_free, "\n", -1), bi: _without(F.col(text), "***", RE_BOLD_ITALIC, " "),
                                     odd: whole.rlike(ODD_SPACE)})
    made = stage(made, made.columns, **{info: B.line_info(F.col(lines))})
    made = stage(made, made.columns, **{blocks: B.found_blocks(info)})
    made = stage(made, made.columns, **{rest: F.array_join(B.outside(F.col(blocks), F.col(lines)), "\n")})
    return made.withColumn(out, _collect(*map(F.col, (text, blocks, lines, info, rest, bi, odd)))).drop(*names)


def _collect(t: Column, blocks: Column, lines: Column, info: Column, rest: Column, no_bi: Column, odd: Column) -> Column:
    no_block = _without(t, "$$", RE_MATH_BLOCK, "")
    no_bold = _without(no_bi, "**", RE_BOLD, " ")
    headings = F.transform(F.transform(B.headings_of(blocks, lines), lambda h: F.struct(h["lv"].alias("lv"), inline_text(h["text"]).alias("text"))),
                           lambda h: F.concat(h["lv"].cast("string"), F.lit(":"), normalise_token(h["text"], odd)))

    return F.concat(
        _typed(headings, "headings"),
        _typed(_norm_all(_table_cells(B.texts_of(blocks, lines, info, B.TABLE_BODY)), odd, inline=True), "tables"),
        _typed(_norm_all(_all(t, "$$", RE_MATH_BLOCK), odd), "math_block"),
        _typed(_norm_all(_all(no_block, "$", RE_MATH_INLINE), odd), "math_inline"),
        _typed(_all(t, "[p.", RE_PAGE_NUM), "page_nums"),
        _typed(_all(t, "[^", RE_FOOTNOTE_REF), "footnotes"),
        _typed(_norm_all(F.when(t.contains("]:"), _all(t, "[^", RE_FOOTNOTE_DEF, 2)).otherwise(_no_text()), odd), "footnote_defs"),
        _typed(_norm_all(_all(rest, "![", RE_IMAGE), odd, inline=True), "images"),
        _typed(_norm_all(B.texts_of(blocks, lines, info, B.LIST_ITEM), odd, inline=True), "list_items"),
        _typed(_norm_all(_all(no_bi, "**", RE_BOLD), odd), "bold"),
        _typed(_norm_all(_all(no_bold, "*", RE_ITALIC), odd), "italic"),
        _typed(_norm_all(_all(t, "***", RE_BOLD_ITALIC), odd), "bold_italic"),
        _typed(_norm_all(B.texts_of(blocks, lines, info, B.BLOCKQUOTE), odd, inline=True), "blockquotes"),
    )
