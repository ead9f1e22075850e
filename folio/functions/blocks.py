"""Block structure of Markdown lines by a line-state machine, folded over the lines with ``aggregate``.

Every line is first classified by itself (blank, quote, ATX heading, rule, ``===``, ``---``, list marker, text).
The fold carries what is open: nothing, a paragraph, a quote, a quote whose last line is a paragraph, or a table;
the line it began at; and the stack of open list items, each with the column its content begins at.

* A text line behind an open paragraph continues it whatever its indent (a lazy line), also inside a quote or an item.
* ``===`` or ``---`` under an open paragraph of the same container makes the whole paragraph a heading of level 1 or 2;
  elsewhere ``===`` is text and dashes are a rule.
* A line that isn't indented to an item's content closes the item, unless it is lazy; blank lines close paragraph, quote
  and table, but no item. An item holds its nested items and counts them as its own text, too.
* A quote begins at ``>`` and goes on over ``>`` lines and lazy ones; its lines hold no other block.
* A delimiter row under a paragraph's line with ``|`` begins a table, whose body goes on over text lines with ``|``.
* Numbers other than 1 and empty markers don't interrupt a paragraph.

Markers are looked for up to 3 columns behind the content of the innermost item. Not modelled: indented code, blocks
inside of quotes, several markers on one line (the line counts as one item).

The fold runs over segments of SEGMENT lines: what a segment closes is gathered in a small array and appended
to the rest at its end, so a text of very many lines costs in proportion to them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEGMENT = 128
BLANK, QUOTE, ATX, RULE, EQUALS, DASHES, ITEM, TEXT = range(8)
NONE, PARA, QUOTED, QUOTED_PARA, TABLE = range(5)
# kinds of found blocks
HEADING, BLOCKQUOTE, TABLE_BODY, LIST_ITEM = range(4)

RE_RULE = r"^[ \t]*(?:(?:-[ \t]*+){3,}+|(?:\*[ \t]*+){3,}+|(?:_[ \t]*+){3,}+)$"
RE_EQUALS = r"^[ \t]*=++[ \t]*$"
RE_DASHES = r"^[ \t]*-++[ \t]*$"
RE_ATX = r"^[ \t]*(#{1,6})(?:[ \t]|$)"
RE_MARK = r"^[ \t]*([-*+]|[0-9]{1,9}[.)])([ \t]+|$)(.?)"
RE_QUOTE = r"^[ \t]*>"
RE_QUOTE_HEAD = r"^(?:[ \t]*> ?)++"
RE_DELIMITER = r"^[ \t]*\|?(?:[ \t]*+:?-++:?[ \t]*+\|)++(?:[ \t]*:?-+:?[ \t]*)?$"
RE_ITEM_HEAD = r"^[ \t]*(?:(?:[-*+]|[0-9]{1,9}[.)])(?:[ \t]+|$)|>[ \t]?)*(?:#{1,6}[ \t]+)?"
RE_ATX_TEXT = r"^[ \t]*#{1,6}(?:[ \t]+(.*?))?(?:[ \t]+#+)?[ \t]*$"

BLOCKS = "array<struct<t:int,lv:int,a:int,b:int>>"


def _line(k, ind=None, off=None, lv=None, soft=None, weak=None, empty=None, pipe=None, delim=None) -> Column:
    no, zero = F.lit(False), F.lit(0)
    return F.struct((F.lit(k) if isinstance(k, int) else k).alias("k"), (zero if ind is None else ind).alias("ind"), (zero if off is None else off).alias("off"),
                    (zero if lv is None else lv).alias("lv"), (no if soft is None else soft).alias("soft"), (no if weak is None else weak).alias("weak"),
                    (no if empty is None else empty).alias("empty"), (no if pipe is None else pipe).alias("pipe"), (no if delim is None else delim).alias("delim"))


def line_info(lines) -> Column:
    """What each line is by itself. Most lines are blank or plain text; only the others meet the patterns."""
    def marked(x, lead, pipe):
        mark, pad, first = (F.regexp_extract(x, RE_MARK, g) for g in (1, 2, 3))
        inner = F.regexp_replace(x, RE_QUOTE_HEAD, "")
        off = lead + F.length(mark) + F.when((first == "") | (F.length(pad) >= 5), 1).otherwise(F.length(pad))
        weak = (first == "") | (mark.rlike("^[0-9]") & ~mark.rlike("^1[.)]"))
        # a quote line's content goes on as a paragraph unless it is blank, a heading or a rule
        soft = ~(inner.rlike(r"^[ \t]*$") | inner.rlike(RE_ATX) | inner.rlike(RE_RULE))
        return (F.when(x.rlike(RE_QUOTE), _line(QUOTE, lead, soft=soft, pipe=pipe))
                .when(x.rlike(RE_ATX), _line(ATX, lead, lv=F.length(F.regexp_extract(x, RE_ATX, 1)), pipe=pipe))
                .when(x.rlike(RE_DASHES), _line(DASHES, lead)).when(x.rlike(RE_RULE), _line(RULE, lead)).when(x.rlike(RE_EQUALS), _line(EQUALS, lead))
                .when(x.rlike(RE_MARK), _line(ITEM, lead, off, weak=weak, empty=first == "", pipe=pipe))
                .otherwise(_line(TEXT, lead, pipe=pipe)))

    def info(x):
        lead = F.when(x.startswith(" ") | x.startswith("\t"), F.length(F.replace(F.regexp_extract(x, r"^[ \t]*", 0), F.lit("\t"), F.lit("    ")))).otherwise(0)
        pipe = x.contains("|")
        return (F.when(F.btrim(x, F.lit(" \t")) == "", _line(BLANK))
                .when(pipe & x.rlike(RE_DELIMITER), _line(TEXT, lead, pipe=pipe, delim=F.lit(True)))
                .when(F.substring(F.ltrim(x, F.lit(" \t")), 1, 1).isin(*">#=-*_+0123456789"), marked(x, lead, pipe))
                .otherwise(_line(TEXT, lead, pipe=pipe)))
    return F.transform(lines, info)


def _block(t: int, lv, a, b) -> Column:
    return F.struct(F.lit(t).alias("t"), (F.lit(lv) if isinstance(lv, int) else lv).alias("lv"), a.alias("a"), b.alias("b"))


def _none() -> Column:
    return F.array().cast(BLOCKS)


def _closed(s, to) -> Column:
    """The quote or table that ends at line ``to``."""
    return (F.when(s["mode"].isin(QUOTED, QUOTED_PARA), F.array(_block(BLOCKQUOTE, 0, s["frm"], to)))
            .when(s["mode"] == TABLE, F.array(_block(TABLE_BODY, 0, s["frm"], to))).otherwise(_none()))


def _items(stack, to) -> Column:
    return F.transform(stack, lambda e: _block(LIST_ITEM, 0, e["a"], to))


def _state(i, mode, frm, pipe, stack, out) -> Column:
    return F.struct(i.alias("i"), (F.lit(mode) if isinstance(mode, int) else mode).alias("mode"), frm.alias("frm"), pipe.alias("pipe"),
                    stack.alias("stack"), out.alias("out"))


def _step(s, x) -> Column:
    i = s["i"] + 1
    kept = F.filter(s["stack"], lambda e: e["off"] <= x["ind"])
    lowered = F.size(kept) < F.size(s["stack"])
    near = x["ind"] - F.when(F.size(kept) > 0, F.element_at(kept, -1)["off"]).otherwise(0) <= 3
    is_ = {k: (x["k"] == k) & near for k in (QUOTE, ATX, RULE, EQUALS, DASHES)}
    held = (s["mode"] == PARA) & ~lowered                        # a paragraph of the line's own container
    item = (x["k"] == ITEM) & near & ~(held & x["weak"])
    setext = x["k"].isin(EQUALS, DASHES) & held & near
    table = x["delim"] & held & s["pipe"]
    row = (s["mode"] == TABLE) & (x["k"] == TEXT) & x["pipe"]
    plain = ~(is_[QUOTE] | is_[ATX] | is_[RULE] | is_[DASHES] | item)
    lazy = s["mode"].isin(PARA, QUOTED_PARA) & plain
    joined = s["mode"].isin(QUOTED, QUOTED_PARA) & is_[QUOTE] & ~lowered
    mode = (F.when(is_[QUOTE], F.when(x["soft"], QUOTED_PARA).otherwise(QUOTED)).when(is_[ATX] | is_[RULE] | is_[DASHES], NONE)
            .when(item, F.when(x["empty"], NONE).otherwise(PARA)).otherwise(PARA))
    ends = F.concat(F.when(joined, _none()).otherwise(_closed(s, s["i"])), _items(F.filter(s["stack"], lambda e: e["off"] > x["ind"]), s["i"]),
                    F.when(is_[ATX], F.array(_block(HEADING, x["lv"], i, i))).otherwise(_none()))
    level = F.when(x["k"] == EQUALS, 1).otherwise(2)
    return (F.when(x["k"] == BLANK, _state(i, NONE, i, F.lit(False), s["stack"],
                                         F.when(s["mode"] > PARA, F.concat(s["out"], _closed(s, s["i"]))).otherwise(s["out"])))
            .when(table, _state(i, TABLE, i + 1, F.lit(False), s["stack"], s["out"]))
            .when(row, _state(i, TABLE, s["frm"], F.lit(False), s["stack"], s["out"]))
            .when(setext, _state(i, NONE, i, F.lit(False), s["stack"], F.array_append(s["out"], _block(HEADING, level, s["frm"], s["i"]))))
            .when(lazy, _state(i, s["mode"], s["frm"], x["pipe"], s["stack"], s["out"]))
            .otherwise(_state(i, mode, F.when(joined, s["frm"]).otherwise(i), x["pipe"],
                              F.when(item, F.array_append(kept, F.struct(i.alias("a"), x["off"].alias("off")))).otherwise(kept),
                              F.concat(s["out"], ends))))


def found_blocks(info) -> Column:
    """The blocks of the classified lines: kind, heading level, first and last line (from 1). ``info`` must be a column reference."""
    info = F.col(info) if isinstance(info, str) else info
    start = _state(F.lit(0), NONE, F.lit(0), F.lit(False), F.array().cast("array<struct<a:int,off:int>>"), _none())

    def segment(acc, k):
        # aggregate copies its state at every line, so what earlier segments closed stays out of the inner one's
        end = F.aggregate(F.slice(info, k * SEGMENT + 1, F.lit(SEGMENT)), acc["s"], _step, lambda s: s)
        return F.transform(F.array(end), lambda s: F.struct(
            _state(s["i"], s["mode"], s["frm"], s["pipe"], s["stack"], _none()).alias("s"), F.concat(acc["done"], s["out"]).alias("done")))[0]

    def rest(acc):
        return F.concat(acc["done"], _closed(acc["s"], acc["s"]["i"]), _items(acc["s"]["stack"], acc["s"]["i"]))

    segments = F.sequence(F.lit(0), F.floor((F.size(info) - 1) / SEGMENT).cast("int"))
    return F.aggregate(segments, F.struct(start.alias("s"), _none().alias("done")), segment, rest)


def texts_of(blocks, lines, info, kind: int) -> Column:
    """The text of each block of a kind, markers removed."""
    def text(b):
        part = F.slice(lines, b["a"], b["b"] - b["a"] + 1)
        if kind == BLOCKQUOTE:
            return F.array_join(F.transform(part, lambda x: F.regexp_replace(x, RE_QUOTE_HEAD, "")), "\n")
        if kind == LIST_ITEM:
            marks = F.slice(info, b["a"], b["b"] - b["a"] + 1)
            clean = F.zip_with(part, marks, lambda x, m: F.when(m["k"].isin(RULE, EQUALS, DASHES) | m["delim"], "").otherwise(F.regexp_replace(x, RE_ITEM_HEAD, "")))
            return F.array_join(clean, "\n")
        return F.array_join(part, "\n")
    return F.transform(F.filter(blocks, lambda b: b["t"] == kind), text)


def headings_of(blocks, lines) -> Column:
    """(level, text) of each heading."""
    def one(b):
        line = F.element_at(lines, b["a"])
        atx = F.regexp_extract(line, RE_ATX_TEXT, 1)
        under = F.array_join(F.transform(F.slice(lines, b["a"], b["b"] - b["a"] + 1), lambda x: F.regexp_replace(x, RE_ITEM_HEAD, "")), "\n")
        return F.struct(b["lv"].alias("lv"), F.when((b["a"] == b["b"]) & line.rlike(RE_ATX), atx).otherwise(under).alias("text"))
    return F.transform(F.filter(blocks, lambda b: b["t"] == HEADING), one)


def outside(blocks, lines) -> Column:
    """The lines that lie in no quote and no table, as one text."""
    inside = F.flatten(F.transform(F.filter(blocks, lambda b: b["t"].isin(BLOCKQUOTE, TABLE_BODY)),
                                   lambda b: F.sequence(F.when(b["t"] == TABLE_BODY, b["a"] - 2).otherwise(b["a"]), F.greatest(b["b"], b["a"] - 1))))
    return F.transform(F.array_except(F.sequence(F.lit(1), F.size(lines)), inside), lambda i: F.element_at(lines, i))
