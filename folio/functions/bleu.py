"""13a tokenisation as Column expressions and clipped n-gram matches (public sacreBLEU definition)."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from folio.functions.text import col, py_rstrip, py_split

# Fixed values of the 13a tokeniser: entity decoding order and the four rewrite rules.
ENTITIES = (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))
# Classes are written out: Java looks up listed characters in one table, but asks ranges one after the other.
PUNCTUATION = "".join("\\" + chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in "',-.")
DIGITS = "0123456789"
RULES_13A = (
    (rf"([{PUNCTUATION}])", " $1 "),                # punctuation and symbols (not the space: a wider one splits no further)
    (rf"([^{DIGITS}])([\.,])", "$1 $2 "),           # period/comma unless after a digit
    (rf"([\.,])([^{DIGITS}])", " $1 $2"),           # period/comma unless before a digit
    (rf"([{DIGITS}])(-)", "$1 $2 "),                # dash after a digit
)
MAX_ORDER = 4


def spaced_13a(text) -> Column:
    """One line of text (already metric-normalised), right-stripped first, with white space between its tokens."""
    x = py_rstrip(col(text))
    x = F.replace(x, F.lit("<skipped>"), F.lit(""))
    x = F.replace(x, F.lit("-\n"), F.lit(""))
    x = F.replace(x, F.lit("\n"), F.lit(" "))
    for ent, ch in ENTITIES:
        x = F.replace(x, F.lit(ent), F.lit(ch))
    x = F.concat(F.lit(" "), x, F.lit(" "))
    for pat, rep in RULES_13A:
        x = F.regexp_replace(x, pat, rep)
    return x


def tokenize_13a(text) -> Column:
    """Tokens of one line of text (see ``spaced_13a``)."""
    return py_split(spaced_13a(text))


def _clipped(ref_tokens, hyp_tokens) -> list[int]:
    from collections import Counter

    out = []
    for n in range(1, MAX_ORDER + 1):
        ref, hyp = (Counter(zip(*[side[k:] for k in range(n)])) for side in (ref_tokens, hyp_tokens))
        out.append(sum(min(c, ref[g]) for g, c in hyp.items() if g in ref))
    return out


def clipped_matches(ref_tokens, hyp_tokens) -> Column:
    """Clipped n-gram matches, orders 1..4, then both lengths, as array<bigint> (Arrow-batched, per pair).

    Same counts as exploding the n-grams of both sides and aggregating them on the
    pair key, without materialising ~4 rows per token."""
    return _clipped_udf(col(ref_tokens), col(hyp_tokens))


def spaced_matches(ref, hyp) -> Column:
    """``clipped_matches`` of two texts as ``spaced_13a`` gives them: a text is one value on its way to Python, where
    ``str.split`` makes its tokens (the white space of ``py_split``)."""
    return _spaced_udf(col(ref), col(hyp))


def text_matches(ref, hyp) -> Column:
    """``clipped_matches`` of the tokens of two lines of text (already metric-normalised). A text is one value on its way to
    Python, which makes its tokens by the same rules."""
    return _text_udf(col(ref), col(hyp))


_RULES = [(re.compile(pat), rep.replace("$", "\\")) for pat, rep in RULES_13A]


class _Words(dict):
    """Tokens of a word. The rules look at neighbouring characters only and white space parts no digits, so a word
    has the same tokens wherever it stands; each is worked out once."""

    def __missing__(self, word: str) -> tuple[str, ...]:
        if word.isalnum():
            self[word] = tokens = (word,)
            return tokens
        x = f" {word} "
        for rule, rep in _RULES:
            x = rule.sub(rep, x)
        self[word] = tokens = tuple(x.split())
        return tokens


def tokens_of(text: str, words: dict) -> list[str]:
    """``tokenize_13a`` of a value."""
    x = text.rstrip().replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
    for ent, ch in ENTITIES:
        x = x.replace(ent, ch)
    return list(chain.from_iterable(map(words.__getitem__, x.split())))


def _matches(a, b) -> list[int]:
    if a == b:
        return [*[max(len(a) - n, 0) for n in range(MAX_ORDER)], len(a), len(b)]
    return [*_clipped(a, b), len(a), len(b)]


SLICE_PAIRS, SLICE_TOKENS = 1 << 11, 1 << 15    # of the pairs that are counted at once; a longer pair is a slice of its own
TOKEN_BITS = 13                                 # a pair with more distinct tokens is counted by itself


def _sliced(pairs: list[tuple[list, list]]) -> list[list[int]]:
    """``_matches`` of several pairs, counted together. An n-gram is one number (pair, up to four token numbers of the pair, side), so equal
    n-grams of a pair meet when the numbers are sorted."""
    numbers, sizes = [], []
    for a, b in pairs:
        both = a + b
        number = dict(zip(dict.fromkeys(both), range(len(both))))
        numbers.extend(map(number.__getitem__, both))
        sizes += (len(a), len(b))
    token = np.array(numbers, np.uint64)
    sizes = np.array(sizes)
    text = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(token))     # tokens from here to the end of the text
    shift, side = MAX_ORDER * TOKEN_BITS + 1, np.uint64(1)
    code = (text >> side << np.uint64(shift)) | (text & side)
    out = np.zeros((len(pairs), MAX_ORDER), np.int64)
    for n in range(MAX_ORDER):
        whole = left > n
        code, left = code[whole], left[whole]
        at = np.flatnonzero(whole) if n == 0 else at[whole]
        if not len(at):
            break
        code |= token[at + n] << np.uint64(1 + TOKEN_BITS * (MAX_ORDER - 1 - n))
        grams = np.sort(code)
        of = grams >> side
        first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        count = np.diff(first, append=len(of))
        hyp = np.add.reduceat((grams & side).astype(np.int64), first)
        out[:, n] = np.bincount((of[first] >> np.uint64(shift - 1)).astype(np.int64), np.minimum(hyp, count - hyp), len(pairs))
    return [[*map(int, x), len(a), len(b)] for x, (a, b) in zip(out, pairs)]


def matches_of(pairs) -> list[list[int]]:
    """Clipped n-gram matches, orders 1..4, and both lengths of every pair of token lists."""
    out: list[list[int] | None] = []
    held: dict[int, tuple[list, list]] = {}
    size = 0

    def count_held():
        for i, x in zip(held, _sliced(list(held.values()))):
            out[i] = x
        held.clear()

    for i, (a, b) in enumerate(pairs):
        out.append(None)
        if a == b or not a or not b or len(a) + len(b) > 1 << TOKEN_BITS and len({*a, *b}) > 1 << TOKEN_BITS:
            out[i] = _matches(a, b)
            continue
        if held and (len(held) == SLICE_PAIRS or size + len(a) + len(b) > SLICE_TOKENS):
            count_held()
            size = 0
        held[i] = a, b
        size += len(a) + len(b)
    if held:
        count_held()
    return out


@F.pandas_udf(ArrayType(LongType()))
def _clipped_udf(r: pd.Series, h: pd.Series) -> pd.Series:
    return pd.Series(matches_of((list(a), list(b)) for a, b in zip(r, h)))


@F.pandas_udf(ArrayType(LongType()))
def _spaced_udf(r: pd.Series, h: pd.Series) -> pd.Series:
    return pd.Series(matches_of((a.split(), b.split()) for a, b in zip(r, h)))


@F.pandas_udf(ArrayType(LongType()))
def _text_udf(r: pd.Series, h: pd.Series) -> pd.Series:
    words = _Words()
    return pd.Series(matches_of((tokens_of(a, words), tokens_of(b, words)) for a, b in zip(r, h)))
