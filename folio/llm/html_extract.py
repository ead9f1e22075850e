"""Main text of HTML pages by the distribution of line blocks.

Markup is stripped into lines, one for every block element; scripts, styles, menus,
page headers and footers, asides and forms leave empty lines. Elements whose class or
id is a boilerplate name (sidebar, advert, notice, comments) do so by their text: if links make up half of
it, or if every part of the name is such a word and the page has other text (a surge of it, outside of all such
elements) - whatever the element's length. On a page without, they go if they hold little text of their own (under
``LITTLE`` characters; outside of <article> and <main> also if it isn't the page's most text). Headings never
go by name. A name that is boilerplate only in its first or last part takes the length, not the text, of
short elements outside of <article> and <main>. The lengths of the lines (without link text) are summed over
sliding windows of ``window`` lines: the text surges where a window passes ``surge``
characters and the next one isn't empty, and dives where a whole window is empty.
Everything between a surge and its dive is kept, short lines and lines of links included. If the
<article> elements hold as much text as the largest run outside of them, lines outside count as empty and any
text is a surge; else the same holds for <main>; else the whole page counts. An <article> or <main>
inside of a dropped element counts only if it holds more than half of the page's text.

Defined results: null html is empty; character references are decoded; white space
inside a block becomes one space; blocks are joined in page order by one newline; a page
without text gives an empty string; pages below one surge yield their fullest window's run; equal rows stay; empty tables stay empty.
"""

from __future__ import annotations

import html as H
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import prepare

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# HTML element names by their part in a page.
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul caption".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template svg math iframe object canvas textarea select title head audio video datalist map noembed noframes applet".split())
ASIDE = set("nav footer aside form menu dialog button label input fieldset".split())
CLOSED_BY_BLOCK = {"p"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar note".split())
NAMES = set("""nav navbar navigation menu submenu sidebar footer masthead banner ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion
cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup share sharing social related recommended recommendations
breadcrumb breadcrumbs pagination pager comments comment commentlist respond reply replies disqus widget widgets toolbar skip skiplink copyright legal disclaimer search searchbox login
alert teaser teasers discussion discussions topbar bottombar tags tagcloud toc paywall survey feedback rating ratings topnav sidenav subnav
adsense adslot adbox adcontainer sidebox aside trending outbrain taboola header""".split())
HOLDS = re.compile(r"^(?:has|with|no|without|is|not)[-_]|[-_]with[-_]")
RESET = {"article", "main"}
LITTLE = 240                             # characters without links


def _named(attrs: str) -> tuple[set[str], str]:
    """Boilerplate roles and hints that need no look at the text; and whether class or id is a
    boilerplate name: "whole", "part" (first or last part only), "header" or ""."""
    sure, kind = set(), ""
    for m in ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id"):
            for name in value.split():
                if HOLDS.search(name):
                    continue
                parts = [x for x in re.split(r"[-_:]+", name) if x]
                if name == "header" or parts and "header" in (parts[0], parts[-1]):
                    sure.add("header")
                    parts = [x for x in parts if x != "header"]
                if parts and (name in NAMES or all(x in NAMES for x in parts)):
                    # id=comment names one section of a text (a commentary); readers' comments come in the plural or as a class
                    kind = kind or "part" if key == "id" and name == "comment" else "whole"
                elif parts and (parts[0] in NAMES or parts[-1] in NAMES):
                    kind = kind or "part"
        elif key == "role" and value in ROLES:
            sure.add(value)
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            sure.add("hidden")
    return sure, kind


class Line:
    __slots__ = ("text", "plain", "article", "main", "region", "again")

    def __init__(self, text, plain, article, main, region, again):
        self.text, self.plain, self.article, self.main, self.region, self.again = text, plain, article, main, region, again


def lines_of(page: str) -> tuple[list[Line], list[tuple[str, int, bool]]]:
    """Lines of the page (dropped elements leave an empty one), and the elements with a boilerplate
    name: (kind, enclosing one or -1, whether it stands in an article or main)."""
    out: list[Line] = []
    text: list[str] = []
    linked = 0
    anchor = articles = mains = 0
    regions: list[tuple[str, int, bool]] = []
    named: list[list] = []                # open elements with a boilerplate name: [name, depth, region]
    inline: list[list] = []               # the same inside of a line: [name, depth, place in text, linked, lines, kind]
    dropped = None                        # element that is being left out: [name, depth]
    again: list[tuple] = []               # dropped elements that an article or main inside interrupts: (dropped, name, depth)
    heads: list[str] = []                 # <header> elements inside an article: only headings stay
    heading = None

    def flush(gap=False):
        nonlocal text, linked
        line = " ".join("".join(text).split())
        if line or gap:
            out.append(Line(line, max(0, len(line) - linked), articles > 0, mains > 0, named[-1][2] if named else -1, bool(again)))
        text, linked = [], 0

    def say(raw: str):
        nonlocal linked
        if dropped is not None or (heads and heading is None):
            return
        s = H.unescape(raw)
        text.append(s)
        if anchor:
            linked += len(" ".join(s.split()))

    def close_named(name):
        """The end tag of the innermost open named element of that name, and of those inside."""
        for k in range(len(named) - 1, -1, -1):
            if named[k][0] == name:
                named[k][1] -= 1
                if named[k][1] == 0:
                    del named[k:]
                return

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if m[1] is not None:
            say(m[1])
            continue
        name = m[3] or m[6]
        if name is None:
            continue
        name, closing, attrs = name.lower(), bool(m[2] or m[5]), m[4] or m[7] or ""
        if not closing and name in RAW and not attrs.rstrip().endswith("/"):
            if name in ("svg", "math", "object", "head", "map", "audio", "video", "noscript", "template"):
                stop = re.compile(rf"</{name}\s*>" + (r"|(?=<body[\s>])" if name == "head" else ""), re.I).search(page, at)
            else:
                stop = re.compile(rf"</{name}[\s>/][^>]*>?|</{name}>", re.I).search(page, at)
            at = stop.end() if stop else (end if name not in ("head", "map") else at)
            if name != "title":
                text.append(" ")
            continue
        block = name in BLOCKS
        if block or name == "br":
            if name == "br":
                text.append(" ")
            else:
                flush()
        if closing:
            if dropped is not None:
                if name == dropped[0]:
                    dropped[1] -= 1
                    if dropped[1] == 0:
                        dropped = None
                        flush(gap=True)
                    continue
                if not (dropped[0] in CLOSED_BY_BLOCK and block):
                    continue
                dropped = None
                flush(gap=True)
            if name == "a":
                anchor = max(0, anchor - 1)
            elif name == "article":
                articles = max(0, articles - 1)
            elif name == "main":
                mains = max(0, mains - 1)
            elif name == "header" and heads:
                heads.pop()
            elif name == heading:
                heading = None
            if block and named and named[-1][0] in CLOSED_BY_BLOCK and name != named[-1][0]:
                named.pop()
            close_named(name)
            for k in range(len(inline) - 1, -1, -1):
                if inline[k][0] == name:
                    inline[k][1] -= 1
                    if inline[k][1] == 0:
                        _, _, place, before, lines, kind = inline[k]
                        del inline[k:]
                        said = len(" ".join("".join(text[place:]).split())) if lines == len(out) else 0
                        links = linked - before
                        if said and (2 * links >= said or kind == "whole" and said - links < LITTLE):
                            del text[place:]
                            text.append(" ")
                            linked = before
                    break
            if again and name == again[-1][1] and (articles if name == "article" else mains) <= again[-1][2]:
                dropped = again.pop()[0]
            elif again and name == again[-1][0][0]:     # the dropped element ends before the one inside of it
                again[-1][0][1] -= 1
                if again[-1][0][1] == 0:
                    again.pop()
            continue
        sure, kind = _named(attrs) if attrs else (set(), "")
        if dropped is not None:
            own = name in RESET and not sure and not kind
            if own and dropped[0] not in ("article", "aside"):
                again.append((dropped, name, articles if name == "article" else mains))
                dropped = None
                flush(gap=True)
            elif dropped[0] in CLOSED_BY_BLOCK and block:
                dropped = None
                flush(gap=True)
            else:
                if name == dropped[0] and name not in VOID:
                    dropped[1] += 1
                continue
        if name in VOID:
            continue
        inside = articles > 0 or mains > 0
        if name == "header" or "header" in sure and name not in ("article", "main", "body", "html"):
            sure.discard("header")
            if inside and name == "header":
                heads.append(name)
                continue
            if not inside and name not in HEADINGS:
                dropped = [name, 1]
                continue
        sure.discard("header")
        if name in ASIDE or sure and name not in ("html", "body", "main"):
            dropped = [name, 1]
            continue
        if again and name == again[-1][0][0]:
            again[-1][0][1] += 1
        if block and named and named[-1][0] in CLOSED_BY_BLOCK:
            named.pop()
        for x in reversed(named):
            if x[0] == name:
                x[1] += 1
                break
        if name == "a":
            anchor = 1
        elif name == "article":
            articles += 1
        elif name == "main":
            mains += 1
        elif name in HEADINGS:
            heading = name
        if block:
            anchor = anchor if name == "a" else 0
        if kind and name not in HEADINGS and name not in ("html", "body", "main"):
            if block:
                for x in reversed(named):       # counted above; now it is the new one's
                    if x[0] == name:
                        x[1] -= 1
                        break
                regions.append((kind, named[-1][2] if named else -1, inside))
                named.append([name, 1, len(regions) - 1])
            else:
                inline.append([name, 1, len(text), linked, len(out), kind])
        elif not block:
            for x in reversed(inline):
                if x[0] == name:
                    x[1] += 1
                    break
    flush()
    return out, regions


def runs_of(n: np.ndarray, window: int, need: int | None, surge: int) -> list[tuple[int, int]]:
    """Runs (first line, line after the last) from a surge to its dive, from and up to lines that count."""
    run = np.r_[0, np.cumsum(n)]
    block = run[np.minimum(np.arange(len(n)) + window, len(n))] - run[:-1]       # characters in lines i .. i+window-1
    need = need or max(1, min(surge, int(block.max(initial=0))))
    out, on = [], -1
    for i in range(len(n)):
        if on < 0 and block[i] >= need:
            on = i
        if on >= 0 and (block[i] == 0 or i == len(n) - 1):
            some = on + np.flatnonzero(n[on : i + 1])
            out.append((int(some[0]), int(some[-1]) + 1))
            on = -1
    return out


def main_text(page: str | None, window: int = 3, surge: int = 60) -> str:
    """The text between surge and dive points, blocks joined by newlines."""
    lines, regions = lines_of(page or "")
    if not lines:
        return ""
    # what an article inside of a dropped element says counts if it is most of the page
    mass = [len(x.text) for x in lines]
    if 2 * sum(m for m, x in zip(mass, lines) if x.again) <= sum(mass):
        lines = [x for x in lines if not x.again]
    whole = sum(x.plain for x in lines)
    own, size, links = np.zeros(len(regions), np.int64), np.zeros(len(regions), np.int64), np.zeros(len(regions), np.int64)
    for x in lines:
        if x.region >= 0:
            own[x.region] += x.plain
            size[x.region] += len(x.text)
            links[x.region] += len(x.text) - x.plain
    for r in range(len(regions) - 1, -1, -1):            # an element inside has a higher number
        up = regions[r][1]
        if up >= 0:
            size[up] += size[r]
            links[up] += links[r]
    outer: list[bool] = []                # whether the element or one around it has a wholly boilerplate name
    for kind, up, _ in regions:
        outer.append(kind == "whole" or up >= 0 and outer[up])
    rest = sum(x.plain for x in lines if x.region < 0 or not outer[x.region])
    top: list[int] = []                   # the outermost element that goes, or -1
    for r, (kind, up, inside) in enumerate(regions):
        gone = 2 * links[r] >= size[r] or kind == "whole" and (rest >= surge or own[r] < LITTLE or not inside and 2 * (size[r] - links[r]) < whole)
        top.append(top[up] if up >= 0 and top[up] >= 0 else r if gone else -1)
    left, before = [], -1
    for x in lines:
        gone = top[x.region] if x.region >= 0 else -1
        if gone < 0:
            left.append(x)
        elif gone != before:
            left.append(Line("", 0, x.article, x.main, -1, False))
        before = gone
    lines = left

    def weight(x):
        light = x.region >= 0 and regions[x.region][0] == "part" and not regions[x.region][2] and size[x.region] < LITTLE
        return 0 if light else x.plain

    def largest(n):
        return max((int(n[a:b].sum()) for a, b in runs_of(n, window, None, surge)), default=0)

    full = np.array([len(x.text) for x in lines], np.int64)
    n, need = np.array([weight(x) for x in lines], np.int64), None
    for inside in ([x.article for x in lines], [x.main for x in lines]):
        inside = np.array(inside, bool)
        held = np.where(inside, full, 0)
        if held.any() and held.sum() >= largest(np.where(inside, 0, n)):
            n, need = held, 1
            break
    return "\n".join(x.text for a, b in runs_of(n, window, need, surge) for x, k in zip(lines[a:b], n[a:b]) if x.text and (need is None or k > 0))


def extract(pages: DataFrame, id_col="page_id", html_col="html", window: int = 3, surge: int = 60) -> DataFrame:
    """pages with the html replaced by text and n_chars (code points)."""
    prepare(pages.sparkSession)
    keep = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    page = "_html"
    while page in keep:
        page += "_"
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(html_col).cast("string").alias(page))

    def run(batches):
        for b in batches:
            t = [main_text(x, window, surge) for x in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(t, pa.string()), pa.array([len(x) for x in t], pa.int64())], [*keep, "text", "n_chars"])

    schema = rows.drop(page).schema.add("text", "string").add("n_chars", "long")
    return rows.mapInArrow(run, schema)
