"""Quality rules on tokeniser fertility.

Two public vocabularies measure a text: a byte-level BPE and a piece BPE with byte
fallback. Per text: characters of words per token (both), share of byte-fallback
tokens, and entropy of the token distribution as a share of the highest possible. Each script has bands
for these; a text outside of a band is rejected. Every distinct word of a batch is
encoded once (neither vocabulary joins words across white space).

Besides, plain counts of the text: words, their characters, symbols, repeated lines
and words in repeated 5-word windows.

Defined results: null and empty texts have no words and fail the base rule; words
are [^\\x20\\x09-\\x0D]+; texts below ``min_tokens`` tokens pass the bands; equal rows get equal rows; empty tables stay empty;
further columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import textvec as V
from folio.llm.common import WHITE, prepare, text_bytes

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
SYMBOLS = b"#*$%&|<>"

#: script -> (least and most characters per piece token, least per byte-BPE token,
#:            most byte fallback, least share of the highest entropy)
BANDS = {
    "latin": (1.4, 7.0, 1.6, 0.20, 0.30),
    "cyrillic": (0.9, 7.0, 0.5, 0.30, 0.30),
    "greek": (0.5, 6.0, 0.4, 0.60, 0.30),
    "cjk": (0.25, 3.0, 0.2, 0.90, 0.25),
    "other": (0.2, 7.0, 0.2, 1.00, 0.25),
}
SCRIPTS = list(BANDS)
_LOADED: dict[tuple[str, str], tuple] = {}


def vocabularies(pieces: str, ranks: str):
    if (pieces, ranks) not in _LOADED:
        import public_tokenizers
        import sentencepiece
        import tiktoken

        sp = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        enc = tiktoken.Encoding("rules", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        fallback = np.array([sp.is_byte(i) for i in range(sp.get_piece_size())])
        _LOADED[pieces, ranks] = (sp, enc, fallback)
    return _LOADED[pieces, ranks]


def script_table() -> np.ndarray:
    """Lead byte of a UTF-8 character -> script index, -1 for none."""
    t = np.full(256, -1, np.int64)
    t[[*range(65, 91), *range(97, 123), *range(0xC3, 0xCB)]] = 0
    t[0xD0:0xD4] = 1
    t[0xCD:0xD0] = 2
    t[0xE3:0xEE] = 3
    t[[*range(0xD4, 0xE3), *range(0xEE, 0xF5)]] = 4
    return t


def base_counts(texts: list[bytes]):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and what the words are."""
    n = len(texts)
    buf, off = V.flat(texts)
    s, e, doc = V.word_spans(buf, off)
    n_words = np.bincount(doc, minlength=n)
    total = lambda mask: (lambda r: r[off[1:]] - r[off[:-1]])(np.r_[0, np.cumsum(mask, dtype=np.int64)])
    chars = total(((buf & 0xC0) != 0x80) & ~WHITE[buf])
    marks = np.zeros(256, bool)
    marks[list(SYMBOLS)] = True
    symbols = total(marks[buf])
    dup = np.zeros(n, np.int64)
    for i, t in enumerate(texts):
        seen = set()
        for line in t.split(b"\n"):
            if line.strip(b" \t\n\r\x0b\f"):
                dup[i] += line in seen
                seen.add(line)
    h = V.span_hashes(buf, s, e)
    covered = np.zeros(len(h) + 1, np.int64)
    if len(h) >= 5:
        g = V.gram_hashes(h, 5)
        at = np.flatnonzero(doc[: len(g)] == doc[4:])
        _, inv, count = np.unique(g[at] ^ V.mix64(doc[at].astype(np.uint64) + np.uint64(1)), return_inverse=True, return_counts=True)
        again = at[count[inv] > 1]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + 5, -1)
    repeat = np.bincount(doc[np.cumsum(covered[:-1]) > 0], minlength=n)
    return n_words, chars, symbols, dup, repeat, (buf, off, s, e, doc, h)


def token_measures(spans, n: int, pieces: str, ranks: str):
    """Tokens in either vocabulary, byte-fallback tokens, and entropy over its highest value."""
    sp, enc, fallback = vocabularies(pieces, ranks)
    buf, off, s, e, doc, h = spans
    _, first, inv = np.unique(h, return_index=True, return_inverse=True)
    raw = buf.tobytes()
    words = [raw[a:b].decode("utf-8", "replace") for a, b in zip(s[first].tolist(), e[first].tolist())]
    ids = sp.encode(words, num_threads=1) if words else []
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    tokens = np.concatenate([np.asarray(x, np.int64) for x in ids]) if len(ids) else np.zeros(0, np.int64)
    begin = np.r_[0, np.cumsum(size)]
    run = np.r_[0, np.cumsum(fallback[tokens])]
    back = run[begin[1:]] - run[begin[:-1]]
    byte_size = np.array([len(enc.encode_ordinary(" " + w)) for w in words], np.int64) if words else size
    per = lambda x: np.bincount(doc, weights=x[inv], minlength=n).astype(np.int64)
    n_piece, n_byte, n_back = per(size), per(byte_size), per(back)
    entropy = np.zeros(n)
    width = len(fallback)
    for lo in range(0, n, 64):
        a, b = np.searchsorted(doc, [lo, lo + 64])
        w = inv[a:b]
        spread = np.repeat(doc[a:b] - lo, size[w])
        at = np.repeat(begin[w], size[w]) + np.arange(int(size[w].sum())) - np.repeat(np.cumsum(size[w]) - size[w], size[w])
        count = np.bincount(spread * width + tokens[at], minlength=1)
        hit = np.flatnonzero(count)
        of, c = hit // width + lo, count[hit].astype(np.float64)
        p = c / np.maximum(n_piece[of], 1)
        entropy += np.bincount(of, weights=-p * np.log2(p), minlength=n)
    top = np.log2(np.maximum(np.minimum(n_piece, width), 2))
    return n_piece, n_byte, n_back, entropy / top


def measure(texts: list[bytes], pieces: str = PIECES, ranks: str = RANKS, bands: dict | None = None, min_tokens: int = 20) -> dict:
    n, bands = len(texts), bands or BANDS
    n_words, chars, symbols, dup, repeat, spans = base_counts(texts)
    n_piece, n_byte, n_back, entropy = token_measures(spans, n, pieces, ranks)
    buf, off = spans[0], spans[1]
    kind = script_table()[buf]
    tally = np.stack([(lambda r: r[off[1:]] - r[off[:-1]])(np.r_[0, np.cumsum(kind == k, dtype=np.int64)]) for k in range(len(SCRIPTS))], axis=1)
    script = np.where(tally.sum(1) > 0, tally.argmax(1), SCRIPTS.index("other"))
    low, high, low_byte, most_back, least = np.array([bands[x] for x in SCRIPTS])[script].T
    per_piece, per_byte, share = chars / np.maximum(n_piece, 1), chars / np.maximum(n_byte, 1), n_back / np.maximum(n_piece, 1)
    inside = (per_piece >= low) & (per_piece <= high) & (per_byte >= low_byte) & (share <= most_back) & (entropy >= least) | (n_piece < min_tokens)
    failed = (n_words < 10) | (100 * repeat > 20 * n_words)
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeat, "base_failed": failed,
            "kept": ~failed & inside, "script": [SCRIPTS[x] for x in script], "n_tokens": n_piece, "chars_per_token": per_piece,
            "chars_per_byte_token": per_byte, "fallback_share": share, "entropy_share": entropy}


FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, script string, "
          "n_tokens long, chars_per_token double, chars_per_byte_token double, fallback_share double, entropy_share double")


def rules(docs: DataFrame, id_col="doc_id", text_col="text", pieces: str = PIECES, ranks: str = RANKS, bands: dict | None = None, min_tokens: int = 20) -> DataFrame:
    """One row a document: its counts, measures and verdict (kept)."""
    prepare(docs.sparkSession)
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "double": pa.float64()}
    fields = [x.split() for x in FIELDS.split(", ")]

    def run(batches):
        for b in batches:
            got = measure(text_bytes(b.column(1)), pieces, ranks, bands, min_tokens)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(got[name], kinds[kind]) for name, kind in fields]], ["doc_id", *[f[0] for f in fields]])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id long, {FIELDS}")
