"""Chat formatting at token level (operator 2).

Every turn becomes ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line feed. Role and text are encoded
separately and the control marks are spliced in as reserved ids that no text can encode to. The loss
mask is the running sum of marks: +1 where an assistant's text begins, -1 behind its end.

Control strings inside texts are escaped reversibly: in every ``<``, any number of backslashes, ``|`` one
backslash is added, so that no ``<|`` is left; reading back removes one.

Turns are encoded, and read back, each by itself in the tasks that hold them. Only digests of a whole
conversation need its turns in order: they are streamed through one running hash per conversation,
sorted on disk, one Arrow batch in memory. A digest over a text is sequential by its nature, so a
conversation that holds much of a table keeps one task hashing for longer; nothing else waits for it.

Edge cases: NULL role or text is empty; NULL turns come first; turns with one number are ordered by their
tokens; NULL conv_id is a conversation of its own; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.tokens import DTYPE, VOCABULARY, encoder

# Reserved ids behind the vocabulary's, and how they read.
START, SEP, END = 50257, 50258, 50259
MARKS = {START: "<|im_start|>", SEP: "<|im_sep|>", END: "<|im_end|>"}
LEARNT = "assistant"

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def assemble(roles: list[str], texts: list[str], path: str) -> tuple[list[bytes], list[bytes]]:
    """Ids and loss masks (one byte a token) of turns."""
    code = encoder(path)
    mark = {k: np.array([k], DTYPE).tobytes() for k in MARKS}
    line = code.encode("\n")
    segments, lengths, learnt = [], [], []
    for role, text in zip(roles, texts, strict=True):
        a, b = code.encode(escape(role)), code.encode(escape(text))
        segments += [mark[START], a, mark[SEP], b, mark[END], line]
        lengths.append([1, len(a) // 2, 1, len(b) // 2, 1, len(line) // 2])
        learnt.append(role == LEARNT)
    if not segments:
        return [], []
    sizes = np.array(lengths, np.int64)
    ends = np.cumsum(sizes.ravel()).reshape(sizes.shape)
    change = np.zeros(ends[-1, -1] + 1, np.int64)
    on = np.array(learnt)
    np.add.at(change, ends[on, 2], 1)
    np.add.at(change, ends[on, 3], -1)
    mask = np.cumsum(change)[:-1].astype(np.uint8).tobytes()
    ids = b"".join(segments)
    borders = [0, *ends[:, -1].tolist()]
    spans = list(zip(borders[:-1], borders[1:], strict=True))
    return [ids[2 * i : 2 * j] for i, j in spans], [mask[i:j] for i, j in spans]


def formatted(turns: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """conv_id, turn, ids (16-bit little-endian) and loss (one byte a token) of every turn."""

    def run(batches):
        for batch in batches:
            roles, texts = ([x or "" for x in batch.column(c).to_pylist()] for c in ("role", "text"))
            ids, loss = assemble(roles, texts, path)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array(ids, pa.binary()), pa.array(loss, pa.binary())],
                ["conv_id", "turn", "ids", "loss"],
            )

    picked = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return picked.mapInArrow(run, "conv_id long, turn long, ids binary, loss binary")


def parse(ids: np.ndarray, loss: np.ndarray, path: str) -> tuple[str, str, str, int]:
    """Role, text, learnt text and number of characters of a formatted turn."""
    code = encoder(path)
    (start,), (sep,), (end,) = (np.flatnonzero(ids == k) for k in (START, SEP, END))
    role, text, tail = code.decode(ids[start + 1 : sep]), code.decode(ids[sep + 1 : end]), code.decode(ids[end + 1 :])
    learnt = code.decode(ids[loss == 1])
    return unescape(role), unescape(text), unescape(learnt), sum(map(len, (*MARKS.values(), role, text, tail)))


def read_back(tokens: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """conv_id, turn, role, text, learnt and chars of every formatted turn."""

    def run(batches):
        for batch in batches:
            rows = [
                parse(np.frombuffer(i, DTYPE), np.frombuffer(m, np.uint8), path)
                for i, m in zip(batch.column("ids").to_pylist(), batch.column("loss").to_pylist(), strict=True)
            ]
            role, text, learnt, chars = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), batch.column("ids")]
                + [pa.array(x, pa.string()) for x in (role, text, learnt)]
                + [pa.array(chars, pa.int64())],
                ["conv_id", "turn", "ids", "role", "text", "learnt", "chars"],
            )

    return tokens.mapInArrow(run, "conv_id long, turn long, ids binary, role string, text string, learnt string, chars long")


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, role, text, learnt, chars):
        self.turns += 1
        self.all.update(f"{role}\n{text}\n".encode())
        self.loss.update(learnt.encode())
        self.loss_chars += len(learnt)
        self.chars += chars

    def row(self):
        return (self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def digests(tokens: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Per conversation what its formatted turns say when they are read back in order."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.string() if "sha" in n else pa.int64() for n in names]

    def run(batches):
        now, done = None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "learnt", "chars"))
            for conv, *turn in zip(*columns, strict=True):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(*turn)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)
                done = []
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(now.row(), kinds, strict=True)], names)

    ordered = read_back(tokens, path).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids")
    return ordered.drop("ids", "turn").mapInArrow(run, schema)
