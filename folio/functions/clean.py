"""Cleaning chain for converter Markdown (rules applied in this order, one projection).

Patterns are the written rules in Java regex form: ``(?md)`` where the rule is
per line, ``\\A`` for "start of text", ``(?U)`` where ``\\d`` must be Unicode
aware, and Python white space for ``\\s``.

By default the chain keeps the written order, which is also what the rules do
in practice: relative links (C4h) and empty brackets (C4j) run before image
numbering (C8), so ``![alt](rel.png)`` turns into ``!alt``. ``number_images_first``
moves C8 before C4c and protects images from C4c/C4h, giving the documented
``![image_N](images/image_N.png)`` output instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import WS_CLASS, col, py_strip

# The cleaning rules (id, pattern, replacement), in order.
RULES = (
    ("C1", r"(?s)\A---\n.*?\n---\n?", ""),
    ("C2", r"(?md)^:{3,}[^\n]*$", ""),
    ("C3", r"(?md)^(#{1,6}[ \t]+)\[([^\]]+)\]\([^)]*\)([ \t]*\{[^}]*\})*", "$1$2"),
    ("C4a", r"\[([^\]]+)\]\{[^}\n]{0,200}\}", "$1"),
    ("C4b", r"\[\]\{[^}]*\}", ""),
    ("C4c", r"\[([^\]\n]+)\]\(#[^)]*\)", "$1"),
    ("C4d", r"(?U)\^\[\[(\d+)\]\]\([^)]*\)\^", "[^$1]"),
    ("C4e", r"(?U)\[\[(\d+)\]\]\([^)]*\)", "[^$1]"),
    ("C4f", r"(?U)\^\[\^(\d+)\]\^", "[^$1]"),
    ("C4g", r"(?U)\^(\d+)\^", "[^$1]"),
    ("C4h", r"\[([^\]\n]+)\]\((?!https?://|mailto:)[^)]+\)", "$1"),
    ("C4i", r"(?U)\[\[(\d+)\]\]", "[^$1]"),
    ("C4j", r"\[\]", ""),
    ("C4k", r"(?md)^\| ([^|\n]+)$", "$1"),
    ("C5", r"\{[^}\n]{0,200}\}", ""),
    ("C6", r"<[^>\n]{0,200}>", ""),
    ("C7", r"(?U)\\\[[Pp]g[!." + WS_CLASS[1:-1] + r"]?(\d+)\\\]", "[p. $1]"),
    ("C8", None, None),                       # image numbering, see number_images
    ("C9", r"\\([!\"#$%&'()*+,\-./:;<=>?@\[\\\]^_{|}~`])", "$1"),
    ("C10", r"\n{3,}", "\n\n"),
)
IMAGE = r"!\[([^\]]*)\]\([^)]+\)"
# Image syntax is shielded from link rules when images are numbered first.
_SHIELDED = {"C4c": r"(?<!!)\[([^\]\n]+)\]\(#[^)]*\)",
             "C4h": r"(?<!!)\[([^\]\n]+)\]\((?!https?://|mailto:)[^)]+\)"}


def number_images(text) -> Column:
    """n-th image of the text -> ``![image_n](images/image_n.png)`` (counter per text).

    ``text`` should be a column reference (it is split once, then rebuilt)."""
    parts = F.split(col(text), IMAGE, -1)
    return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(
        F.concat(F.lit("![image_"), i.cast("string"), F.lit("](images/image_"), i.cast("string"),
                 F.lit(".png)"), p))), "")


def rule_order(number_images_first: bool = False) -> list[str]:
    ids = [r[0] for r in RULES]
    if number_images_first:
        ids.remove("C8")
        ids.insert(ids.index("C4c"), "C8")
    return ids


def clean_steps(df: DataFrame, text: str, number_images_first: bool = False, prefix: str = "_c") -> tuple[DataFrame, list[str]]:
    """Adds one column per rule (``_c<id>``: text after that rule); returns the columns."""
    by_id = {r[0]: r for r in RULES}
    cur, names = text, []
    for rid in rule_order(number_images_first):
        _, pat, rep = by_id[rid]
        name = f"{prefix}{rid}"
        if rid == "C8":
            expr = number_images(cur)
        else:
            if number_images_first and rid in _SHIELDED:
                pat = _SHIELDED[rid]
            expr = F.regexp_replace(F.col(cur), pat, rep)
        df = df.withColumn(name, expr)
        cur = name
        names.append(name)
    return df, names


def clean_markdown(df: DataFrame, text: str = "md", out: str = "clean", number_images_first: bool = False) -> DataFrame:
    """Adds ``out``: the cleaned text, stripped and ending with one newline."""
    staged, names = clean_steps(df, text, number_images_first)
    return staged.withColumn(out, F.concat(py_strip(names[-1]), F.lit("\n"))).drop(*names)


def strip_images(md) -> Column:
    """Remove image references before rendering."""
    return F.regexp_replace(col(md), r"!\[[^\]]*\]\([^)]+\)", "")
