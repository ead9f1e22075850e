"""Edit distance as an Arrow-batched UDF.

Spark's built-in ``levenshtein`` fills the full dynamic-programming table one
cell at a time. The bit-parallel form (Myers 1999, in Hyyrö's formulation for
global distance) advances 64 cells per machine word; Python integers make the
bit vectors any length, so a page pair costs a few milliseconds. Common prefix
and suffix are cut first (this keeps the distance exact).

Long texts only work on a band of the table (Ukkonen's cut-off): a distance of at most k
never leaves the 2k + 1 diagonals around the main one. k doubles until the distance fits, so
the cost grows with distance times length; a band is given up at once when its lower edge says that
k is too small. Texts that differ in more than about half of their characters fall back to the whole table.

The pairs of a batch go through a band together (``edit_distances``), so the interpreter's cost is shared: a column at a time, those of
nearly equal length in a machine word each, others in as many as each needs; few pairs of like size an antidiagonal at a time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType


def _common_prefix(a: str, b: str) -> int:
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


BAND_FROM = 4096        # shorter texts: the whole table is a few machine words wide already
BAND_START = 256
BAND_COLUMNS = 4096


def banded_distance(a: str, b: str, k: int) -> int:
    """The distance of a and b if it is at most ``k``, else k + 1; needs 0 <= len(a) - len(b) <= k < len(b).

    Bit r of a vector stands for row c - k + r of column c (rows along b, columns along a): the
    window slides down one row a column. ``edge`` is the value at the window's lower end; it goes down the
    diagonal until the last row, then along it. It can't fall on the diagonal, and by one a column at most
    on the row, so above ``lost`` the distance is more than k."""
    n, m, width = len(a), len(b), 2 * k + 1
    mask, low = (1 << width) - 1, 1 << (width - 1)
    vp, vn, edge = mask ^ ((1 << k) - 1), 0, k
    lost = k + (n - (m - k))
    for first in range(0, n, BAND_COLUMNS):
        last = min(n, first + BAND_COLUMNS)
        begin = first - k                       # row of b at bit 0 of this stretch of columns
        peq: dict[str, int] = {}
        for i in range(max(begin, 0), min(m, last + k)):
            ch = b[i]
            peq[ch] = peq.get(ch, 0) | (1 << (i - begin))
        for c in range(first, last):
            eq = (peq.get(a[c], 0) >> (c - first)) & mask
            d0 = ((((eq & vp) + vp) ^ vp) | eq | vn) & mask
            hp = vn | (mask & ~(d0 | vp))
            hn = d0 & vp
            if c < m - k:
                edge += not d0 & low
            else:
                at = low >> (c - (m - k) + 1)
                edge += bool(hp & at) - bool(hn & at)
            if edge > lost:
                return k + 1
            down = d0 >> 1
            vp = hn | (mask & ~(down | hp))
            vn = down & hp
    return edge if edge <= k else k + 1


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance over code points (unit costs)."""
    if a == b:
        return 0
    k = _common_prefix(a, b)
    a, b = a[k:], b[k:]
    k = _common_prefix(a[::-1], b[::-1])
    if k:
        a, b = a[:-k], b[:-k]
    if len(a) < len(b):
        a, b = b, a
    m = len(b)
    if m == 0:
        return len(a)
    if m > BAND_FROM:
        k = max(BAND_START, len(a) - m)
        while 2 * k < m:
            d = banded_distance(a, b, k)
            if d <= k:
                return d
            k *= 2
    peq: dict[str, int] = {}
    for i, ch in enumerate(b):
        peq[ch] = peq.get(ch, 0) | (1 << i)
    mask = (1 << m) - 1
    top = 1 << (m - 1)
    pv, mv, score = mask, 0, m
    for ch in a:
        eq = peq.get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) | 1
        mh = mh << 1
        pv = (mh | ~(xv | ph)) & mask
        mv = ph & xv & mask
    return score


LANES = 128             # pairs that go through the band together
LANE_LIMIT = 16000      # characters of a pair whose distances fit 16 bits
LANE_MARGINS = (32, 128)


def lane_distances(pairs: list[tuple[str, str]], margin: int) -> list[int | None]:
    """Distances of several pairs (a, b) with len(a) >= len(b) > 0, all at once; None where the band was too narrow.

    With e = len(a) - len(b) the band holds the diagonals -margin..e + margin (e of the widest pair). A path that leaves it
    costs at least e + 2 * (margin + 1), so a smaller result is exact. Antidiagonals are worked out one by one, for all pairs in
    the same step; a pair's result is read at the step of its last cell, what comes behind it is not used."""
    k = len(pairs)
    n, m = np.array([len(a) for a, _ in pairs]), np.array([len(b) for _, b in pairs])
    extra, total = n - m, n + m
    wide = int(extra.max()) + 2 * margin + 1
    steps = int(total.max())
    size = steps // 2 + wide + 2                       # room for every index that a step can reach
    points = [np.frombuffer("".join(side).encode("utf-32-le", "surrogatepass"), np.uint32) for side in zip(*pairs)]
    kind = np.uint16 if max(int(x.max()) for x in points) < 0xFFFE else np.uint32
    # row of cell (i, j): i in down, size - j in across; outside of the texts nothing is equal
    down, across = (np.full((2 * size, k), np.iinfo(kind).max - x, kind) for x in (0, 1))
    ends = [np.cumsum(x) for x in (n, m)]
    for p in range(k):
        down[size + 1 : size + 1 + n[p], p] = points[0][ends[0][p] - n[p] : ends[0][p]]
        across[size - m[p] : size, p] = points[1][ends[1][p] - m[p] : ends[1][p]][::-1]
    # q = i - j + margin: even and odd diagonals apart, each with a border on both sides
    half = (wide + 1) // 2, wide // 2
    even, odd = (np.full((h + 2, k), LANE_LIMIT, np.int16) for h in half)
    (odd if margin % 2 else even)[margin // 2 + 1] = 0
    differ, least = np.empty((half[0], k), bool), np.empty((half[0], k), np.int16)
    last = {}
    for p, s in enumerate(total.tolist()):
        last.setdefault(s, []).append(p)
    out: list[int | None] = [None] * k
    for s in range(1, steps + 1):
        q = (s + margin) % 2
        h = half[q]
        own, other = (odd, even) if q else (even, odd)
        i = (s + q - margin) // 2
        x, y = differ[:h], least[:h]
        np.not_equal(down[size + i : size + i + h], across[size - s + i : size - s + i + h], out=x)
        np.minimum(other[q : q + h], other[q + 1 : q + 1 + h], out=y)
        y += 1
        mine = own[1 : h + 1]
        mine += x
        np.minimum(mine, y, out=mine)
        for p in last.get(s, ()):
            d = int(own[(int(extra[p]) + margin) // 2 + 1, p])
            if d <= extra[p] + 2 * margin + 1:
                out[p] = d
    return out


WORD_LANES = 512        # pairs of nearly equal length that go through a band of one word each
WORD_FEW = 16           # fewer gain nothing from that
WORD_EXTRA = 24         # their greatest difference of lengths
WORD_BYTES = 16 << 20   # for their table of equal characters


def _codes(a: str, b: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Characters of both texts in the narrowest type that has a value left, and that value."""
    x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (a, b))
    high = max(int(x.max()), int(y.max()))
    kind = np.uint8 if high < 0xFF else np.uint16 if high < 0xFFFF else np.uint32
    return x.astype(kind), y.astype(kind), np.iinfo(kind).max


def word_distances(pairs: list[tuple[str, str]]) -> list[int | None]:
    """Distances of several pairs (a, b) with len(a) >= len(b) > 0, all at once; None where a band of 64 diagonals was too narrow.

    ``banded_distance`` with a machine word a pair: bit r stands for row c - reach + r of column c. ``equal`` holds a word of equal characters for
    every column and pair, made for a whole pair at once; a step puts the diagonal's zeros in its place, and a
    pair's distance is the number of other steps on the diagonal that ends in the last cell. A path that leaves the band costs at
    least len(a) - len(b) + 2 * (margin + 1), where margin is the number of diagonals beside the two corners', so a smaller result is exact."""
    k = len(pairs)
    sizes = [(len(a), len(b)) for a, b in pairs]
    columns = max(n for n, _ in sizes)
    reach = (63 + max(n - m for n, m in sizes)) // 2
    equal = np.zeros((columns, k), np.uint64)
    for p, (a, b) in enumerate(pairs):
        x, y, none = _codes(a, b)
        n, m = sizes[p]
        rows = np.full(n + 63, none, x.dtype)
        end = min(m, n + 63 - reach)
        rows[reach : reach + end] = y[:end]
        for at in range(0, n, 4096):
            same = np.lib.stride_tricks.sliding_window_view(rows[at : at + 4096 + 63], 64) == x[at : at + 4096, None]
            equal[at : at + 4096, p][: len(same)] = np.packbits(same, axis=1, bitorder="little").view("<u8")[:, 0]
    one = np.uint64(1)
    vp, vn = np.full(k, ~np.uint64(0) << np.uint64(reach)), np.zeros(k, np.uint64)
    hp, down = np.empty(k, np.uint64), np.empty(k, np.uint64)
    both, either, add, xor, invert, shift = np.bitwise_and, np.bitwise_or, np.add, np.bitwise_xor, np.invert, np.right_shift
    for d0 in equal:
        both(d0, vp, down)
        add(down, vp, down)
        xor(down, vp, down)
        either(d0, down, d0)
        either(d0, vn, d0)
        either(d0, vp, hp)
        invert(hp, hp)
        either(hp, vn, hp)
        shift(d0, one, down)
        both(down, hp, vn)
        either(down, hp, down)
        invert(down, down)
        both(d0, vp, vp)
        either(vp, down, vp)
    out: list[int | None] = []
    for p, (n, m) in enumerate(sizes):
        extra = n - m
        zeros = int(np.count_nonzero(equal[extra:n, p] & (one << np.uint64(reach - extra))))
        margin = min(63 - reach, reach - extra)
        out.append(n - zeros if n - zeros <= extra + 2 * margin + 1 else None)
    return out


BAND_MARGINS = (32, 128, 384)
BAND_WORDS = 32         # most words of a pair's band
BAND_CHARS = 1 << 20    # of the pairs in one step
BAND_TABLE = 1 << 21    # words of their tables of characters


def _points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def band_distances(pairs: list[tuple[str, str]], words: list[int]) -> list[int | None]:
    """Distances of several pairs (a, b) with len(a) >= len(b) > 0, all at once; None where a band of so many machine words was too narrow.

    ``banded_distance`` with ``words`` machine words a pair (64 * words > len(a) - len(b)), all in one row: bit r of a pair's band stands for row
    c - reach + r of column c. Sums carry from a word to the next one of its pair. A pair's table has the rows of b where a
    character stands as bits, from which a column's equal characters are cut out. The distance is the number of steps other than zero on the diagonal that
    ends in the last cell. A path that leaves the band costs at least len(a) - len(b) + 2 * (margin + 1), where margin is the
    number of diagonals beside the two corners', so a smaller result is exact."""
    k = len(pairs)
    order = sorted(range(k), key=lambda p: -len(pairs[p][0]))           # a pair that has ended leaves the end of the row
    n, m = (np.array([len(pairs[p][side]) for p in order]) for side in (0, 1))
    wide = np.array([words[p] for p in order])
    extra = n - m
    reach = (64 * wide - 1 + extra) // 2
    x, y = (_points([pairs[p][side] for p in order]) for side in (0, 1))
    seen = np.zeros(int(max(x.max(), y.max())) + 1, bool)
    seen[y] = True
    code = np.where(seen, np.cumsum(seen) - 1, np.count_nonzero(seen))
    of_x, of_y = np.repeat(np.arange(k), n), np.repeat(np.arange(k), m)
    x, y = code[x], code[y]
    has = np.zeros((k, np.count_nonzero(seen) + 1), bool)               # the last code: characters that no b has
    has[of_y, y] = True
    has[:, -1] = False
    room = (n - 1) // 64 + wide + 1                                      # words of a character's bits
    size = (np.count_nonzero(has, axis=1) + 1) * room
    if k > 1 and size.sum() > BAND_TABLE:
        half = k // 2
        out = dict(zip(order, [d for part in (order[:half], order[half:]) for d in band_distances([pairs[p] for p in part], [words[p] for p in part])]))
        return [out[p] for p in range(k)]
    # a pair's first row of bits stays empty, for the characters of a that b doesn't have
    first = (np.cumsum(size) - size)[:, None] + np.where(has, np.cumsum(has, axis=1), 0) * room[:, None]
    bits = np.zeros(int(size.sum()) + 1, np.uint64)
    at = np.arange(len(y)) - np.repeat(np.cumsum(m) - m - reach, m)
    inside = at < 64 * room[of_y]
    at, of_y, y = at[inside], of_y[inside], y[inside]
    np.add.at(bits, first[of_y, y] + (at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    rows = first[of_x, x]
    del of_x, of_y, x, y, at, inside, first

    lanes = int(wide.sum())
    ends = np.cumsum(wide)
    of = np.repeat(np.arange(k), wide)
    word = np.arange(lanes) - np.repeat(ends - wide, wide)
    inner = np.ones(lanes, bool)
    inner[ends - 1] = False                                              # the last word of a pair carries nothing on
    several = bool(inner.any())
    one, top, full = np.uint64(1), np.uint64(63), ~np.uint64(0)
    kept = np.where(inner, full, np.uint64(0))
    low = np.clip(reach[of] - 64 * word, 0, 64)
    vp = np.where(low > 63, np.uint64(0), full << np.minimum(low, 63).astype(np.uint64))
    vn = np.zeros(lanes, np.uint64)
    diagonal = reach - extra
    mine, bit = ends - wide + diagonal // 64, (diagonal % 64).astype(np.uint64)
    place = np.cumsum(n) - n
    steps = np.zeros(k, np.int64)
    work = [np.empty(lanes, np.uint64) for _ in range(3)]
    both, either, add, xor, invert, right, left = (np.bitwise_and, np.bitwise_or, np.add, np.bitwise_xor, np.invert, np.right_shift, np.left_shift)
    shift = np.arange(64, dtype=np.uint64)[:, None]
    for begin in range(0, int(n[0]), 64):
        live = int(np.searchsorted(-n, -begin))
        size = int(ends[live - 1])
        hp, down, over = (v[:size] for v in work)
        vp, vn, carries, below = vp[:size], vn[:size], inner[:size], kept[: size - 1]
        # equal characters of 64 columns; what lies behind a pair's end is not used
        where = rows.take(place[:live] + np.arange(begin, begin + 64)[:, None], mode="clip").take(of[:size], axis=1)
        where += word[:size] + begin // 64
        equal = bits.take(where, mode="clip")
        equal >>= shift
        where += 1
        equal |= bits.take(where, mode="clip") << one << (top - shift)
        for d0 in equal:
            both(d0, vp, over)
            add(over, vp, down)
            if several:
                gone = int.from_bytes(np.packbits((down < over) & carries, bitorder="little").tobytes(), "little")
                if gone:
                    through = int.from_bytes(np.packbits((down == full) & carries, bitorder="little").tobytes(), "little")
                    gone = ((gone | through) + gone) ^ through
                    add(down, np.unpackbits(np.frombuffer(gone.to_bytes(size // 8 + 1, "little"), np.uint8), count=size, bitorder="little"), down)
            xor(down, vp, down)
            either(d0, down, d0)
            either(d0, vn, d0)
            either(d0, vp, hp)
            invert(hp, hp)
            either(hp, vn, hp)
            right(d0, one, down)
            if several:
                left(d0[1:], top, over[:-1])
                both(over[:-1], below, over[:-1])
                either(down[:-1], over[:-1], down[:-1])
            both(down, hp, vn)
            either(down, hp, down)
            invert(down, down)
            both(d0, vp, vp)
            either(vp, down, vp)
        column = np.arange(begin, begin + 64)[:, None]
        zero = (equal.take(mine[:live], axis=1) >> bit[:live] & one).astype(bool)
        steps[:live] += np.count_nonzero(zero & (column >= extra[:live]) & (column < n[:live]), axis=0)
    found = n - steps
    exact = found <= extra + 2 * np.minimum(64 * wide - 1 - reach, reach - extra) + 1
    out = dict(zip(order, (int(d) if sure else None for d, sure in zip(found, exact))))
    return [out[p] for p in range(k)]


def _trimmed(a: str, b: str) -> tuple[str, str]:
    """The longer and the shorter text without their common prefix and suffix."""
    k = _common_prefix(a, b)
    a, b = a[k:], b[k:]
    k = _common_prefix(a[::-1], b[::-1])
    if k:
        a, b = a[:-k], b[:-k]
    return (b, a) if len(a) < len(b) else (a, b)


def edit_distances(pairs: list[tuple[str, str]]) -> list[int]:
    """Levenshtein distance of every pair. Pairs of nearly equal length go through a band of one machine word together, other pairs
    and those that it can't hold through as many words as they need, few pairs of like size antidiagonal by antidiagonal, and the rest one by one."""
    out: list[int | None] = [None] * len(pairs)
    rest = []
    for i, (x, y) in enumerate(pairs):
        a, b = ("", "") if x == y else _trimmed(x, y)
        pairs[i] = a, b
        if not b:
            out[i] = len(a)
        else:
            rest.append(i)
    near = sorted((i for i in rest if len(pairs[i][0]) - len(pairs[i][1]) <= WORD_EXTRA), key=lambda i: len(pairs[i][0]))
    while near:
        # the longest first: the table has a word for each of its characters and each pair
        longest = len(pairs[near[-1]][0])
        fit = near[-max(1, min(WORD_LANES, WORD_BYTES // (8 * longest))):]
        fit = [i for i in fit if 2 * len(pairs[i][0]) + 256 >= longest]
        del near[-len(fit):]
        if len(fit) >= WORD_FEW:
            for i, d in zip(fit, word_distances([pairs[i] for i in fit])):
                out[i] = d
    rest = [i for i in rest if out[i] is None]
    for margin in BAND_MARGINS:
        words = {i: (len(pairs[i][0]) - len(pairs[i][1]) + 2 * margin) // 64 + 1 for i in rest}
        near = sorted((i for i in rest if words[i] <= BAND_WORDS), key=lambda i: len(pairs[i][0]))
        while len(near) >= WORD_FEW:
            # the longest first; those that would be left alone with the rest of their columns stay out
            if len(pairs[near[-1]][0]) > 2 * len(pairs[near[-WORD_FEW]][0]) + 256:
                near.pop()
                continue
            ends = np.cumsum([len(pairs[i][0]) + len(pairs[i][1]) for i in reversed(near)])
            fit = near[-max(WORD_FEW, int(np.searchsorted(ends, BAND_CHARS))):]
            del near[-len(fit):]
            for i, d in zip(fit, band_distances([pairs[i] for i in fit], [words[i] for i in fit])):
                out[i] = d
        rest = [i for i in rest if out[i] is None]
    for margin in LANE_MARGINS:
        # a band that is no narrower than the table gains nothing
        fit = [i for i in rest if len(pairs[i][0]) + len(pairs[i][1]) <= LANE_LIMIT and 2 * margin < len(pairs[i][1])]
        fit.sort(key=lambda i: ((len(pairs[i][0]) - len(pairs[i][1])) // 128, len(pairs[i][0]) + len(pairs[i][1])))
        at = 0
        while at < len(fit):
            cls = (len(pairs[fit[at]][0]) - len(pairs[fit[at]][1])) // 128
            end = at + 1
            # a step's cost hardly follows the pairs as long as they are few: then those of a wider class join in
            while end < len(fit) and end - at < LANES and (len(pairs[fit[end]][0]) - len(pairs[fit[end]][1])) // 128 <= (
                    cls if end - at >= LANES // 2 else 2 * cls + 2):
                end += 1
            if end - at >= 8:
                for i, d in zip(fit[at:end], lane_distances([pairs[i] for i in fit[at:end]], margin)):
                    out[i] = d
            at = end
        rest = [i for i in rest if out[i] is None]
    for i in rest:
        out[i] = edit_distance(*pairs[i])
    return out


@F.pandas_udf(ArrayType(LongType()))
def distance_and_lengths(a: pd.Series, b: pd.Series) -> pd.Series:
    """Edit distance and both lengths, so that the texts are read in one place only."""
    there = [i for i, (x, y) in enumerate(zip(a, b)) if x is not None and y is not None]
    out = [None] * len(a)
    for i, d in zip(there, edit_distances([(a.iloc[i], b.iloc[i]) for i in there])):
        out[i] = [d, len(a.iloc[i]), len(b.iloc[i])]
    return pd.Series(out)
