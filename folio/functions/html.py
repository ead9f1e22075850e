"""HTML -> Markdown sections without a DOM (flat block model).

1. drop comments and the bodies of head/script/style (optionally nav/footer);
2. inline tags to Markdown (bold, italic, sup/sub, strike, links, images, line breaks);
3. block tags become a sentinel carrying tag name and class, the text is split on it,
   so an unclosed ``<p>`` simply ends at the next block tag;
4. remaining tags go, character references are decoded, white space is collapsed;
5. styled p/div/span blocks with a heading-like class and at most 20 words become headings;
6. blocks render as Markdown (headings, lists, quotes, tables, definitions);
   the cleaning chain and the 50-character section gate follow.

Steps 1-5 are Catalyst expressions but for the references; step 6 walks the blocks of one page.
``pre`` blocks are plain blocks: their white space is collapsed like any other.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from folio.functions.text import WS_CLASS, col, py_split, py_strip

# Class patterns -> heading level, first matching rule wins.
HEADING_RULES = (
    (r"title|book.?head|tit(o(lo)?)?|titel", 1),
    (r"h1|chap|chapter|parte|part[^i]|capit|kapitel", 2),
    (r"h2|section|sezione|subchap|abschnitt|überschrift", 3),
    (r"h3|subsect|paragraph|paragrafo|absatz|unterab", 4),
    (r"h[45]", 5),
)
BLOCK_TAGS = ("p|div|h[1-6]|li|blockquote|tr|td|th|article|section|nav|footer|header|ul|ol|table|body|html|main|"
              "dl|dt|dd|pre|figure|figcaption|aside|form")
SOH, STX, ETX = "\u0001", "\u0002", "\u0003"
_CLASS = r"(?is)\bclass\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
_ANY_RULE = "|".join(pat for pat, _ in HEADING_RULES)


def strip_noise(html, drop_nav: bool = False) -> Column:
    x = F.regexp_replace(col(html), r"(?s)<!--.*?-->", "")
    tags = "head|script|style" + ("|nav|footer" if drop_nav else "")
    return F.regexp_replace(x, rf"(?is)<({tags})\b[^>]*>.*?</\1\s*>", "")


def inline_to_md(x) -> Column:
    x = col(x)
    x = F.regexp_replace(x, r"(?is)<(b|strong)\b[^>]*>(.*?)</(?:b|strong)\s*>", "**$2**")
    x = F.regexp_replace(x, r"(?is)<(i|em)\b[^>]*>(.*?)</(?:i|em)\s*>", "*$2*")
    x = F.regexp_replace(x, r"(?is)<sup\b[^>]*>(.*?)</sup\s*>", "^$1^")
    x = F.regexp_replace(x, r"(?is)<sub\b[^>]*>(.*?)</sub\s*>", "~$1~")
    x = F.regexp_replace(x, r"(?is)<(del|s)\b[^>]*>(.*?)</(?:del|s)\s*>", "~~$2~~")
    for quote in ('\"', "'"):
        x = F.regexp_replace(x, rf"(?is)<a\b[^>]*?href\s*=\s*{quote}([^{quote}]*){quote}[^>]*>(.*?)</a\s*>", "[$2]($1)")
    # src and alt in either order and with either quote
    value = r"(?:\"([^\"]*)\"|'([^']*)')"
    x = F.regexp_replace(x, rf"(?is)<img\b(?=[^>]*?\bsrc\s*=\s*{value})(?:(?=[^>]*?\balt\s*=\s*{value})|)[^>]*>", "![$3$4]($1$2)")
    return F.regexp_replace(x, r"(?i)<br\s*/?>", "\n")


def mark_blocks(x) -> Column:
    """Opening block tags -> SOH tag STX attrs STX; closing block tags -> SOH ETX tag STX.

    A span with a heading-like class counts as a block. A <p> that opens a styled div or
    an item, quote or cell belongs to it, so its class or marker holds for the text."""
    x = F.regexp_replace(col(x), r"(?is)(<(?:li|blockquote|dd|td|th)\b[^>]*>|<div\b[^>]*\bclass\b[^>]*>)\s*<p\s*>", "$1")
    x = F.regexp_replace(x, rf"(?isu)<span\b([^>]*\bclass\s*=\s*[\"'][^\"']*(?:{_ANY_RULE})[^\"']*[\"'][^>]*)>(.*?)</span\s*>",
                         SOH + "span" + STX + "$1" + STX + "$" + str(2 + _ANY_RULE.count("(")) + SOH + ETX + "span" + STX)
    x = F.regexp_replace(x, rf"(?i)<({BLOCK_TAGS})\b([^>]*)>", SOH + "$1" + STX + "$2" + STX)
    return F.regexp_replace(x, rf"(?i)</({BLOCK_TAGS})\s*>", SOH + ETX + "$1" + STX)


@F.pandas_udf(StringType())
def decode_entities(x: pd.Series) -> pd.Series:
    """All named and numeric character references (Arrow-batched)."""
    return x.map(lambda s: s if s is None or "&" not in s else html.unescape(s))


def block_text(raw) -> Column:
    """Text of a block: white space collapsed, ends stripped."""
    return py_strip(F.regexp_replace(col(raw), WS_CLASS + "+", " "))


def heading_level(cls) -> Column:
    """Level of the first class rule that matches (NULL: none)."""
    out = None
    for pat, lvl in HEADING_RULES:
        cond = col(cls).rlike("(?iu)" + pat)
        out = F.when(cond, F.lit(lvl)) if out is None else out.when(cond, F.lit(lvl))
    return out


def split_blocks(df: DataFrame, html: str = "html", out: str = "blocks", drop_nav: bool = False) -> DataFrame:
    """Adds ``out``: array<struct<tag, cls, text, close>> in document order (empty blocks kept).
    ``close`` names the block tag that ended before the text, if any."""
    marked = F.regexp_replace(mark_blocks(inline_to_md(strip_noise(html, drop_nav))), r"<[^>]*>", "")
    staged = df.withColumn("_parts", F.split(decode_entities(marked), SOH, -1))

    def one(p):
        opens, ends = p.contains(STX) & ~p.startswith(ETX), p.startswith(ETX)
        head = F.split(p, STX, 3)
        tag = F.when(opens, F.lower(F.element_at(head, 1))).otherwise(F.lit(""))
        attrs = F.when(opens, F.element_at(head, 2)).otherwise(F.lit(""))
        body = F.when(opens, F.element_at(head, 3)).when(ends, F.element_at(head, 2)).otherwise(p)
        cls = F.concat(*[F.regexp_extract(attrs, _CLASS, k) for k in (1, 2, 3)])
        close = F.when(ends, F.lower(F.substring(F.element_at(head, 1), 2, 20))).otherwise(F.lit(""))
        return F.struct(tag.alias("tag"), cls.alias("cls"), block_text(body).alias("text"), close.alias("close"))

    return staged.withColumn(out, F.transform("_parts", one)).drop("_parts")


def promote(blocks, max_words: int = 20) -> Column:
    """p/div blocks with a heading-like class and at most ``max_words`` words -> h<level>."""
    def one(b):
        lvl = heading_level(b["cls"])
        words = F.size(py_split(b["text"]))
        promo = b["tag"].isin("p", "div", "span") & (b["cls"] != "") & lvl.isNotNull() & (words <= max_words)
        tag = F.when(promo, F.concat(F.lit("h"), lvl.cast("string"))).otherwise(b["tag"])
        return F.struct(tag.alias("tag"), b["cls"].alias("cls"), b["text"].alias("text"), b["close"].alias("close"))
    return F.transform(col(blocks), one)


def render(blocks) -> str:
    """Markdown of one page's blocks: ``#`` headings, tight ``-`` and numbered items (nested ones
    indented), ``>`` on every block of a quote, pipe tables, everything else by a blank line."""
    out: list[tuple[str, str]] = []                  # (what joins to the next, text)
    lists: list[list] = []                           # open lists: [kind, number of the last item]
    quote, marker, rows, cell, n_lists = 0, None, None, None, 0

    def add(kind: str, text: str) -> None:
        out.append((kind, "> " * quote + text))

    def table() -> None:
        nonlocal rows, cell
        width = max((len(r) for r in rows or []), default=0)
        if width:
            lines = ["| " + " | ".join(c.replace("|", "\\|") for c in [*r, *[""] * (width - len(r))]) + " |" for r in rows if r]
            add("table", "\n".join([lines[0], "|" + " --- |" * width, *lines[1:]]))
        rows = cell = None

    for b in blocks:
        tag, text, close = b["tag"], b["text"], b["close"]
        if close in ("ul", "ol") and lists:
            lists.pop()
            marker = None
        elif close == "blockquote":
            quote = max(0, quote - 1)
        elif close == "table":
            table()
        elif close in ("td", "th", "tr"):
            cell = None
        if tag in ("ul", "ol"):
            n_lists += not lists
            lists.append([tag, 0])
        elif tag == "blockquote":
            quote += 1
        elif tag == "table":
            if rows:
                table()
            rows = []
        elif tag == "tr" and rows is not None:
            rows.append([])
            cell = None
        elif tag in ("td", "th") and rows is not None:
            if not rows:
                rows.append([])
            rows[-1].append("")
            cell = len(rows[-1]) - 1
        elif tag == "li":
            if lists:
                lists[-1][1] += 1
            marker = f"{lists[-1][1]}. " if lists and lists[-1][0] == "ol" else "- "
        if not text:
            continue
        if rows is not None and cell is not None:
            rows[-1][cell] = f"{rows[-1][cell]} {text}".strip()
            continue
        if len(tag) == 2 and tag[0] == "h" and tag[1] in "123456":
            text = "#" * int(tag[1]) + " " + text
        if marker is not None:
            add(f"li{n_lists}", "   " * max(0, len(lists) - 1) + marker + text)
            marker = None
        elif tag == "dd":
            add("dd", ":   " + text)
        else:
            add("quote" if quote else "block", text)
    if rows is not None:
        table()
    md = ""
    for k, (kind, text) in enumerate(out):
        before = out[k - 1][0] if k else ""
        tight = kind == before and kind[:2] == "li" or kind == "dd"
        md += ("" if not k else "\n" if tight else "\n>\n" if kind == before == "quote" else "\n\n") + text
    return md


@F.pandas_udf(StringType())
def _render_udf(blocks: pd.Series) -> pd.Series:
    return blocks.map(lambda b: "" if b is None else render(b))


def blocks_to_markdown(blocks) -> Column:
    """Blocks of a page as Markdown, in order (Arrow-batched)."""
    return _render_udf(col(blocks))
