"""Words of a batch of texts as numpy arrays: positions and 64-bit hashes, made
without a Python loop over words. Batches are cut into bounded pieces."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from folio.llm.common import WHITE

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
PIECE = 1 << 20
LONG = 256      # bytes; sums modulo 2^64 of longer spans can be equal by construction (Thue-Morse words)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i < n."""
    size = 1 << max(10, int(n - 1).bit_length())
    if size not in _POWERS:
        if size > 2 * PIECE:
            return tuple(np.cumprod(np.r_[np.uint64(1), np.full(size - 1, x, np.uint64)], dtype=np.uint64) for x in (BASE, INVERSE))
        _POWERS[size] = tuple(np.cumprod(np.r_[np.uint64(1), np.full(size - 1, x, np.uint64)], dtype=np.uint64) for x in (BASE, INVERSE))
    return _POWERS[size]


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and the offset of each text (one more at the end)."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    return buf, np.r_[0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]


def lower(buf: np.ndarray) -> np.ndarray:
    return np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the text that holds it."""
    if not len(buf):
        return (np.zeros(0, np.int64),) * 3
    ink = ~WHITE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    begins = ink.copy()
    begins[1:] &= ~ink[:-1] | edge[1:-1]
    ends = ink.copy()
    ends[:-1] &= ~ink[1:] | edge[1:-1]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(offsets, s, side="right") - 1


def span_hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans in order of their starts. Spans of more than LONG bytes get XXH3."""
    out = np.zeros(len(s), np.uint64)
    at = 0
    while at < len(s):
        to = max(at + 1, int(np.searchsorted(s, s[at] + PIECE)))
        while to > at + 1 and e[to - 1] - s[at] > 2 * PIECE:
            to = at + (to - at + 1) // 2
        lo, hi = int(s[at]), int(e[at:to].max())
        up, down = powers(hi - lo + 1)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((buf[lo:hi].astype(np.uint64) + np.uint64(1)) * up[: hi - lo], out=total[1:])
        out[at:to] = mix64((total[e[at:to] - lo] - total[s[at:to] - lo]) * down[s[at:to] - lo])
        at = to
    for i in np.flatnonzero(e - s > LONG):
        out[i] = xxhash.xxh3_64_intdigest(buf[s[i]:e[i]].tobytes(), seed=42)
    return out


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k words in a row (by word hashes), ignoring text borders."""
    n = len(words) - k + 1
    h = np.zeros(max(n, 0), np.uint64)
    for i in range(k):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[i : i + len(h)]
    return mix64(h)


def pass_rows(batch: pa.RecordBatch, keep: np.ndarray) -> pa.RecordBatch:
    return batch.filter(pa.array(keep))
