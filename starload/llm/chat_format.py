"""Chat formatting by token-level assembly (operator 2).

A turn is ``[INST]role[/INST]text</s>``; a conversation starts with ``<s>``.
Role and text are encoded apart, and the control marks are spliced in as
reserved ids that no text can produce.  So that the text form is unambiguous
too, a control string or backslash occurring in content is escaped: a
backslash is doubled, and one is put after the first character of a control
string.  The loss mask comes from the segment bounds by a prefix sum and covers
exactly the text of assistant turns.

The vocabulary is a lossless byte-level one, so everything is read back from
the ids alone.

Defined cases: null role or text is empty; turns are ordered by (turn, role,
text), nulls first, so ties and repeated rows have one order; a null conv_id is
a conversation of its own; no rows give no conversations.  A conversation of any length streams through
its task as running digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPE = re.compile(r"\\|" + _CONTROL.pattern)
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)

TURNS = "conv_id long, turn long, ids array<int>, loss array<boolean>"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


class Codec:
    """Ordinary ids of a rank file, and reserved ids after its last one."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.first = max(ranks.values()) + 1
        self.bos, self.end, self.open, self.close = range(self.first, self.first + len(CONTROL))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(x) for x in texts]

    def decode(self, ids) -> str:
        """Text of ids; reserved ids become their control strings."""
        out, run = [], []
        for i in ids:
            if i < self.first:
                run.append(i)
            else:
                out += [self.encoding.decode_bytes(run).decode(), CONTROL[i - self.first]]
                run = []
        return "".join([*out, self.encoding.decode_bytes(run).decode()])


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def assemble(c: Codec, roles: list[str], texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, loss, offsets) of a batch of turns, flat."""
    role_ids = c.encode([escape(x) for x in roles])
    text_ids = c.encode([escape(x) for x in texts])
    n = len(roles)
    lengths = np.ones((n, 5), dtype=np.int64)
    lengths[:, 1] = [len(x) for x in role_ids]
    lengths[:, 3] = [len(x) for x in text_ids]
    bounds = np.concatenate(([0], np.cumsum(lengths.ravel())))
    at = bounds[:-1].reshape(n, 5)
    total = int(bounds[-1])
    ids = np.empty(total, dtype=np.int32)
    ids[at[:, 0]], ids[at[:, 2]], ids[at[:, 4]] = c.open, c.close, c.end
    for column, pieces in ((1, role_ids), (3, text_ids)):
        flat = np.fromiter((i for p in pieces for i in p), dtype=np.int32, count=int(lengths[:, column].sum()))
        sizes = lengths[:, column]
        inner = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids[np.repeat(at[:, column], sizes) + inner] = flat
    steps = np.zeros(total + 1, dtype=np.int64)
    spoken = np.array([x == "assistant" for x in roles], dtype=bool)
    np.add.at(steps, at[spoken, 3], 1)
    np.add.at(steps, at[spoken, 4], -1)
    return ids, np.cumsum(steps)[:total] > 0, np.append(at[:, 0], total)


def format_turns(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """(conv_id, turn, ids, loss): the assembled tokens of every turn row.

    Concatenated by (conv_id, turn) after one ``<s>`` id they are the training
    sequence; rows are encoded where they lie, without a shuffle.
    """
    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            conv, turn, roles, texts = (batch.column(i) for i in range(4))
            ids, loss, off = assemble(c, [x or "" for x in roles.to_pylist()],
                                      [x or "" for x in texts.to_pylist()])
            off = pa.array(off, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [conv, turn, pa.ListArray.from_arrays(off, pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(off, pa.array(loss))], names=["conv_id", "turn", "ids", "loss"])

    cols = [F.col("conv_id").cast("long"), F.col("turn").cast("long"),
            F.col("role").cast("string"), F.col("text").cast("string")]
    return rows.select(*cols).mapInArrow(run, TURNS)


def read_back(turns: DataFrame, path: str, pattern: str) -> DataFrame:
    """(conv_id, turn, role, text, loss_text, chars) parsed from the ids alone."""
    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            out = {"role": [], "text": [], "loss_text": [], "chars": []}
            flat_ids = [batch.column(2).flatten().to_numpy(zero_copy_only=False),
                        batch.column(3).flatten().to_numpy(zero_copy_only=False)]
            sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            at = 0
            for size in sizes:
                ids, loss = flat_ids[0][at:at + size], flat_ids[1][at:at + size]
                at += size
                marks = np.flatnonzero(ids >= c.first)
                opened, closed, ended = marks
                out["role"].append(unescape(c.decode(ids[opened + 1:closed].tolist())))
                out["text"].append(unescape(c.decode(ids[closed + 1:ended].tolist())))
                out["loss_text"].append(unescape(c.decode(ids[loss].tolist())))
                out["chars"].append(len(c.decode(ids.tolist())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out["role"], pa.string()),
                 pa.array(out["text"], pa.string()), pa.array(out["loss_text"], pa.string()),
                 pa.array(out["chars"], pa.int64())],
                names=["conv_id", "turn", *out])

    return turns.mapInArrow(run, "conv_id long, turn long, role string, text string, loss_text string, chars long")


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
           "loss_sha256 string, formatted_chars long")


def digest(parsed: DataFrame) -> DataFrame:
    """One row per conversation: running digests over its turns in order."""
    def run(batches):
        state = None

        def close():
            conv, n, all_, loss_chars, loss, chars = state
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([n], pa.int64()), pa.array([all_.hexdigest()]),
                 pa.array([loss_chars], pa.int64()), pa.array([loss.hexdigest()]),
                 pa.array([chars], pa.int64())],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or state[0] != row["conv_id"]:
                    if state is not None:
                        yield close()
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), len(CONTROL[0])]
                state[1] += 1
                state[2].update(f"{row['role']}\n{row['text']}\n".encode())
                state[3] += len(row["loss_text"])
                state[4].update(row["loss_text"].encode())
                state[5] += row["chars"]
        if state is not None:
            yield close()

    return (parsed.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(run, DIGESTS))
