"""Chat formatting by token-level assembly.

A turn is [start] role newline, its text, [end] newline. Header and text are encoded
separately and spliced between reserved ids above the vocabulary, so a control
string inside a text can never become a control token; besides, "<|" inside texts is
escaped reversibly (one backslash more between "<" and "|"). The loss mask of a turn is the prefix
sum of +1 and -1 at the borders of its segments: 1 on the tokens of assistant
texts. ``token_start`` is the prefix sum of the turns' lengths in a conversation.

Conversations are never gathered: a turn is a row, and the digests read sorted rows
as a stream.

Defined results: null role or text is empty; turns of equal number are ordered by
a 64-bit hash of role and text; repeated rows are turns of their own; a null conv_id is a
conversation; empty tables stay empty; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import prepare

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
START, END = "<|im_start|>", "<|im_end|>"
_LOADED: dict[str, tuple] = {}


def tokenizer(path: str):
    """(encoding, start id, end id) of a vocabulary file of ranks; loaded once a worker."""
    if path not in _LOADED:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        top = max(ranks.values()) + 1
        _LOADED[path] = (tiktoken.Encoding("turns", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), top + 1, top + 2)
    return _LOADED[path]


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def encode_turn(role: str, text: str, path: str, train_role: str = "assistant") -> tuple[np.ndarray, np.ndarray]:
    """Token ids and loss mask of one turn."""
    enc, start, end = tokenizer(path)
    parts = [[start], enc.encode_ordinary(_role(role) + "\n"), enc.encode_ordinary(escape(text)), [end], enc.encode_ordinary("\n")]
    border = np.cumsum([0, *map(len, parts)])
    step = np.zeros(border[-1] + 1, np.int8)
    if role == train_role:
        step[border[2]] += 1
        step[border[3]] -= 1
    return np.concatenate([np.array(p, np.int32) for p in parts]), np.cumsum(step, dtype=np.int8)[:-1]


def format_turns(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text",
                 vocabulary: str = VOCABULARY, train_role: str = "assistant") -> DataFrame:
    """One row a turn, in order inside its conversation: conv_id, turn, input_ids,
    loss_mask, n_tokens and token_start (its place among the conversation's tokens)."""
    prepare(turns.sparkSession)
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("role", "text"))

    def run(batches):
        for b in batches:
            got = [encode_turn(r, t, vocabulary, train_role) for r, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(4), pa.array([x for x, _ in got], pa.list_(pa.int32())),
                 pa.array([x for _, x in got], pa.list_(pa.int8())), pa.array([len(x) for x, _ in got], pa.int64())],
                ["conv_id", "turn", "tie", "input_ids", "loss_mask", "n_tokens"])

    out = rows.mapInArrow(run, "conv_id long, turn long, tie long, input_ids array<int>, loss_mask array<tinyint>, n_tokens long")
    out = out.repartition("conv_id")            # also when the prefix sum is pruned away
    w = Window.partitionBy("conv_id").orderBy("turn", "tie").rowsBetween(Window.unboundedPreceding, -1)
    return out.withColumn("token_start", F.coalesce(F.sum("n_tokens").over(w), F.lit(0)))


def read_turn(ids: np.ndarray, mask: np.ndarray, path: str) -> tuple[str, str, str, int]:
    """Role, text, text under the mask and number of formatted characters, from the tokens alone."""
    enc, start, end = tokenizer(path)
    a, z = int(np.flatnonzero(ids == start)[0]), int(np.flatnonzero(ids == end)[-1])
    said = enc.decode_bytes(ids[a + 1 : z].tolist()).decode()
    tail = enc.decode_bytes(ids[z + 1 :].tolist()).decode()
    role, _, text = said.partition("\n")
    loss = enc.decode_bytes(ids[mask == 1].tolist()).decode() if mask.any() else ""
    return _unrole(role), unescape(text), unescape(loss), len(START) + len(said) + len(END) + len(tail)


def digests(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row a conversation, read back from the tokens of format_turns(): number of
    turns, SHA-256 of its turns and of its text under the loss mask, and sizes."""
    fields = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"

    def run(batches):
        now, done, first = None, [], True

        def close():
            if now is not None:
                done.append((now["id"], now["n"], now["turns"].hexdigest(), now["chars"], now["loss"].hexdigest(), now["all"], now["tokens"]))

        for b in batches:
            ids, masks = b.column(1), b.column(2)
            for k, conv in enumerate(b.column(0).to_pylist()):
                if first or conv != now["id"]:
                    close()
                    now, first = {"id": conv, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "chars": 0, "all": 0, "tokens": 0}, False
                t, m = ids[k].values.to_numpy(zero_copy_only=False), masks[k].values.to_numpy(zero_copy_only=False)
                role, text, loss, size = read_turn(t, m, vocabulary)
                now["n"] += 1
                now["turns"].update(f"{role}\n{text}\n".encode())
                now["loss"].update(loss.encode())
                now["chars"] += len(loss)
                now["all"] += size
                now["tokens"] += len(t)
            if len(done) >= 1000:
                yield _batch(done)
                done.clear()
        close()
        yield _batch(done)

    def _batch(rows):
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        cols = list(zip(*rows)) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], [f.split()[0] for f in fields.split(", ")])

    # format_turns() has left each conversation whole in one partition
    return formatted.sortWithinPartitions("conv_id", "turn", "tie").select("conv_id", "input_ids", "loss_mask").mapInArrow(run, fields)
