"""Text helpers as Column expressions (JVM side), plus one Arrow UDF for NFC.

Python string semantics are reproduced with built-ins: ``str.strip()`` and
``str.split()`` use Python's notion of white space, which differs from both
Spark's ``trim`` (spaces only) and Java's ``\\s``; the exact character set is
derived from ``str.isspace`` below.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Every code point Python's str.isspace() accepts (all lie below U+3001).
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())



def _ranges(chars: str) -> str:
    """Runs of consecutive code points as a-b."""
    points = [ord(c) for c in chars]
    firsts = [p for p in points if p - 1 not in points]
    lasts = [p for p in points if p + 1 not in points]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" if a < b else f"\\u{a:04x}" for a, b in zip(firsts, lasts))


# The same set as a Java regex character class, e.g. for "\s+" replacements. Java looks up single characters below U+0100 in
# one table, but asks ranges and all others one after the other; most text stops at the table and one range.
WS_CLASS = "[" + "".join(f"\\u{ord(c):04x}" for c in PY_WHITESPACE if c < "\u0100") + \
    "[\\u1680-\\u3000&&[" + _ranges("".join(c for c in PY_WHITESPACE if c >= "\u0100")) + "]]]"
# White space other than the space and the line break.
ODD_SPACE = "[" + "".join(f"\\u{ord(c):04x}" for c in PY_WHITESPACE if c < "\u0100" and c not in " \n") + WS_CLASS[WS_CLASS.index("[\\u1680"):]


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove white space of both ends."""
    return F.btrim(col(c), F.lit(PY_WHITESPACE))


def py_rstrip(c) -> Column:
    return F.rtrim(col(c), F.lit(PY_WHITESPACE))


def py_split(c) -> Column:
    """Python ``str.split()`` with no argument: white-space runs, no empty items."""
    return F.filter(F.split(col(c), WS_CLASS + "+"), lambda x: x != "")


def nfc(c) -> Column:
    """Unicode NFC; Spark has no built-in for it. Text below U+0300 is composed already (no combining mark, nothing that
    changes), so only other text goes to Python."""
    x = col(c)
    return F.coalesce(_nfc(F.when((F.octet_length(x) != F.length(x)) & x.rlike(r"[^\x00-\u02ff]"), x)), x)


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    def one(x):
        if x is None or unicodedata.is_normalized("NFC", x):
            return x
        return unicodedata.normalize("NFC", x)

    return s.map(one)


def normalise(c) -> Column:
    """Metric text normalisation of an NFC text (see ``nfc``; the scorers compose their
    texts first): CR/CRLF to LF, tabs/space runs to one space, 3+ newlines to 2, strip."""
    x = F.replace(F.replace(col(c), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    # a single space stays as it is; most texts need neither pattern
    raw = col(c)
    x = F.when(raw.contains("\t") | raw.contains("  "), F.regexp_replace(x, r"[ \t]{2,}|\t", " ")).otherwise(x)
    x = F.when(raw.contains("\r") | raw.contains("\n\n\n"), F.regexp_replace(x, r"\n{3,}", "\n\n")).otherwise(x)
    return py_strip(x)


def normalise_token(c, odd=None) -> Column:
    """Element-token normalisation: white-space runs to one space, strip, lower case. ``odd`` says whether the text that the
    token comes from matches ``ODD_SPACE``; without that, only line breaks and runs of spaces need the pattern."""
    plain = col(c)
    x = F.regexp_replace(plain, WS_CLASS + "+", " ")
    if odd is not None:
        x = F.when(odd | plain.contains("\n") | plain.contains("  "), x).otherwise(plain)
    return F.lower(F.trim(x))                                # spaces are all that is left of white space


def title_slug(title, max_len: int = 60) -> Column:
    """Folder slug: non-word characters (Unicode aware) to '_', first 60, '_' trimmed."""
    x = F.regexp_replace(col(title), r"(?U)[^\w\-]", "_")
    return F.btrim(F.substring(x, 1, max_len), F.lit("_"))


def model_slug(model_id) -> Column:
    """Short model name: the part after the last '/'."""
    return F.element_at(F.split(col(model_id), "/"), -1)


def page_name(idx, ext: str) -> Column:
    """``page_0007.<ext>`` style file name."""
    return F.format_string(f"page_%04d.{ext}", col(idx))


def posexplode_rows(df, keep, arr, pos: str, val: str):
    """Rows of array ``arr`` with their 0-based position; empty arrays give no row.

    The *_outer generator is used on purpose: a plain explode makes the optimizer
    infer ``size(arr) > 0`` and push that filter (with the whole array expression
    inlined) below the projection that computes the array, so the array would be
    computed twice.
    """
    return (df.select(*keep, F.posexplode_outer(arr).alias(pos, val))
              .filter(F.col(pos).isNotNull()))


def stage(df, keep, **made):
    """``keep`` and the ``made`` columns, worked out once a row. The one-row generator is a barrier:
    the optimizer would else copy each expression to every place that reads its column."""
    return df.select(*keep, F.inline_outer(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))
