"""Alignment of two tokenizations of every text (operator 13).

A text is encoded by a byte-level vocabulary (A) and by a piece vocabulary (B), and both sequences of tokens become
arrays of byte offsets at which tokens end. Offsets where both end cut the tokens into groups. They are found by
diagonal run skipping: at the current shift between the two indexes, stretches of both arrays are compared as
wholes, twice as many entries after each success and half as many after a miss, so a one-to-one stretch is jumped
in a logarithmic number of steps; where it ends, the side that lies behind advances until both ends meet, which closes
an irregular group and sets the new shift.

Links are all pairs of occurrences within a group. How many documents hold a pair of ids is counted in two steps:
tasks work through slices of a bounded number of text bytes and give each slice's different pairs with their documents
once, and those are summed by pair. So a pair that every document holds comes as one row per slice. The
counts return by the same rows: each slice gets those of its own pairs, next to its documents' places in them. Neither
texts nor tokens are shuffled, and nothing that grows with the corpus is broadcast.

Words are encoded once per worker and remembered: a part of the text that begins at a single space between two
other characters starts new tokens in both vocabularies (``Pieces`` refuses a vocabulary with pieces that go on across a
space), so parts may be encoded apart.

Edge cases: NULL and empty texts, and texts that a vocabulary doesn't give back byte for byte, have no tokens: zeros
and an empty digest column. Very long texts are a slice of their own; groups of very many tokens are linked by
their different ids. Repeated rows and rows with one id are documents of their own and count as such; a NULL id
stays NULL. An empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import words
from ticklake.session import stored

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
REMEMBERED = 200_000  # parts; beyond that the memory starts anew
FIRST_STEP = 8  # entries that are compared first
WIDE = 4096  # links; larger groups are linked by their different ids
DTYPE = np.dtype("<u2")
SPACE = "▁"  # how B writes a space

# Fixed: how the byte-level vocabulary's file names its pretokens, and the pattern that stands for.
PRETOKENS = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SURE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class _Vocabulary(dict):
    """Ids of parts of texts, as bytes; ``pieces`` are the bytes of each id and ``lengths`` their numbers.

    Parts that aren't given back byte for byte are in ``lossy``.
    """

    def __init__(self, pieces: list[bytes]):
        super().__init__()
        if len(pieces) > 1 << 16:
            raise ValueError(f"Ids of 16 bits expected, got {len(pieces)} ids")
        self.pieces = pieces
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.lossy: set[str] = set()

    def ids(self, parts: list[str]) -> tuple[np.ndarray, list[int]]:
        """Ids of all parts, and where each part's ids end."""
        raise NotImplementedError

    def encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, and how many each has."""
        if len(self) > REMEMBERED:
            self.clear()
            self.lossy.clear()
        new = [p for p in parts if p not in self]
        if new:
            flat, ends = self.ids(new)
            body = flat.tobytes()
            self.update(zip(new, [body[2 * lo : 2 * hi] for lo, hi in zip([0, *ends[:-1]], ends, strict=True)], strict=True))
            if self.decode(flat) != b" " + " ".join(new).encode():
                self.lossy.update(p for p in new if self.decode(np.frombuffer(self[p], DTYPE)) != b" " + p.encode())
        found = list(map(self.__getitem__, parts))
        return np.frombuffer(b"".join(found), DTYPE), np.fromiter(map(len, found), np.int64, len(found)) // 2

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))


def _ends(found: list[list[int]]) -> tuple[np.ndarray, list[int]]:
    return np.fromiter(chain.from_iterable(found), DTYPE), np.cumsum(list(map(len, found))).tolist()


class Bytes(_Vocabulary):
    """A byte-level vocabulary: every byte is written as a printable character.

    Where merges are numbered in the order of their results' ids, as usual, those ids are the ranks that the quicker
    encoder wants; otherwise the vocabulary's own library encodes.
    """

    def __init__(self, path: str):
        # Bytes that are printable stand for themselves, the others follow from 256 on, in order.
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        others = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        special = {t["content"] for t in stated["added_tokens"] if t["special"]}
        model = stated["model"]
        ids = {piece: i for piece, i in model["vocab"].items() if piece not in special}
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ranked = [ids[m] for m in merged] == list(range(256, 256 + len(merged))) and len(ids) == 256 + len(merged)
        self._coder = None
        if ranked and stated["pre_tokenizer"] == PRETOKENS and stated["normalizer"] is None and not model.get("ignore_merges"):
            import tiktoken

            ranks = {bytes(byte[c] for c in piece): i for piece, i in ids.items()}
            self._quick = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        else:
            from tokenizers import Tokenizer

            self._coder = Tokenizer.from_file(path)
            self._coder.encode_special_tokens = True  # their strings in a text are plain text
        names = {i: piece for piece, i in ids.items()}
        super().__init__([bytes(byte[c] for c in names.get(i, "")) for i in range(max(names) + 1)])

    def ids(self, parts: list[str]) -> tuple[np.ndarray, list[int]]:
        if self._coder is not None:
            return _ends([self._coder.encode(" " + p, add_special_tokens=False).ids for p in parts])
        # All at once: each part's space starts a token, and bytes are kept, so offsets tell where parts end.
        flat = np.array(self._quick.encode_ordinary(" " + " ".join(parts)), DTYPE)
        upto = np.cumsum([len(p.encode()) + 1 for p in parts])
        return flat, (np.searchsorted(np.cumsum(self.lengths[flat]), upto) + 1).tolist()


class Pieces(_Vocabulary):
    """A piece vocabulary with byte fallback, which puts a space before every text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self._coder = SentencePieceProcessor(model_file=path)
        names = [self._coder.id_to_piece(i) for i in range(self._coder.get_piece_size())]
        if any(SPACE in name.lstrip(SPACE) for name in names):
            raise ValueError("Pieces that go on across a space: parts of texts can't be encoded apart")
        super().__init__([self._bytes(name) for name in names])

    @staticmethod
    def _bytes(name: str) -> bytes:
        byte = _BYTE_PIECE.fullmatch(name)
        return bytes([int(byte[1], 16)]) if byte else name.replace(SPACE, " ").encode()

    def ids(self, parts: list[str]) -> tuple[np.ndarray, list[int]]:
        return _ends(self._coder.encode(parts, num_threads=1))


_LOADED: dict[tuple[type, str], _Vocabulary] = {}


def _worker(kind: type, name: str):
    """The worker's vocabulary, from the file that came with the job."""
    if (kind, name) not in _LOADED:
        _LOADED[kind, name] = kind(SparkFiles.get(name))
    return _LOADED[kind, name]


def _sent(spark: SparkSession, path: str) -> str:
    """Send a vocabulary file along to the workers; its name there."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def parts(text: str) -> list[str]:
    """The text cut at single spaces between two characters that are none; the spaces themselves are left out."""
    return _SURE_SPACE.split(text) if text else []


def _spread(values: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Stretches of ``n`` values from ``first``, one after another."""
    return values[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())]


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _cut(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different parts of all texts, the occurrences' places among them, and how many each text has."""
    texts = pc.fill_null(texts, "")
    cut = pc.split_pattern(texts, " ")
    n = pc.list_value_length(cut).to_numpy().astype(np.int64)
    which = cut.flatten().dictionary_encode()
    at, first = which.indices.to_numpy(), np.cumsum(n) - n
    # Where a part is empty or begins or ends with white space, not every space of its text is a place to cut.
    unsure = np.array([not p or p != p.strip() for p in _strings(which.dictionary)], bool)
    again = np.unique(np.searchsorted(first, np.flatnonzero(unsure[at]), "right") - 1)
    if len(again):
        lists = [parts(texts[int(i)].as_py()) for i in again]
        sure = np.ones(len(n), bool)
        sure[again] = False
        usual = pa.array(_spread(np.arange(len(at)), first[sure], n[sure]))
        which = pa.concat_arrays([cut.flatten().take(usual), pa.array(chain.from_iterable(lists), cut.type.value_type)]).dictionary_encode()
        n[again] = list(map(len, lists))
        first = np.empty(len(n), np.int64)
        order = np.concatenate([np.flatnonzero(sure), again])
        first[order] = np.cumsum(n[order]) - n[order]
        at = _spread(which.indices.to_numpy(), first, n)
    return _strings(which.dictionary), at, n


def encoded(texts: pa.Array, a: Bytes, b: Pieces) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """For both vocabularies the ids of all texts, each with a space before it, and how many each text has."""
    different, at, size = _cut(texts)
    coded = [v.encode(different) for v in (a, b)]
    starts = [np.cumsum(n) - n for _, n in coded]
    empty = np.zeros(len(texts), bool)
    for v, (ids, n), start in zip((a, b), coded, starts, strict=True):
        lossy = np.array([p in v.lossy for p in different], bool)[at] if v.lossy else np.zeros(0, bool)
        for i in np.unique(np.searchsorted(np.cumsum(size), np.flatnonzero(lossy), "right")):
            # The whole decides: together, changed parts may still be the same.
            own = at[size[:i].sum() : size[: i + 1].sum()]
            empty[i] |= v.decode(_spread(ids, start[own], n[own])) != b" " + texts[int(i)].as_py().encode()
    at = at[~np.repeat(empty, size)]
    upto = np.cumsum(np.where(empty, 0, size))
    out = []
    for (ids, n), start in zip(coded, starts, strict=True):
        tokens = np.concatenate([[0], np.cumsum(n[at])])[np.concatenate([[0], upto])]
        out.append((_spread(ids, start[at], n[at]), np.diff(tokens)))
    return out[0], out[1]


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of common values of two ascending arrays that end alike: (from a, from b, how many).

    A run follows one diagonal: its entries are neighbours in both arrays.
    """
    # Unlike values behind the ends stop every stretch.
    list_a, list_b = a.tolist(), b.tolist()
    all_a, all_b, width = np.append(a, -1).tobytes(), np.append(b, -2).tobytes(), 8
    i = j = 0
    n = len(a)
    from_a, from_b, count = [], [], []
    while i < n:
        # An irregular group: the side that lies behind advances until both end.
        x, y = list_a[i], list_b[j]
        while x != y:
            if x < y:
                i += 1
                x = list_a[i]
            else:
                j += 1
                y = list_b[j]
        # The diagonal through this end: stretches grow while they agree, and shrink around the first that doesn't.
        at, other, step = (i + 1) * width, (j + 1) * width, FIRST_STEP * width
        while all_a[at : at + step] == all_b[other : other + step]:
            at += step
            other += step
            step *= 2
        while step > width:
            step >>= 1
            if all_a[at : at + step] == all_b[other : other + step]:
                at += step
                other += step
        at //= width
        from_a.append(i)
        from_b.append(j)
        count.append(at - i)
        j += at - i
        i = at
    return tuple(np.array(x, np.int64) for x in (from_a, from_b, count))


def _linked(ids_a: np.ndarray, ids_b: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document << 32 | a << 16 | b, number of links), ascending, of all links. ``group`` has (from a, a tokens, from b, b tokens)."""
    from_a, n_a, from_b, n_b = group
    times = n_a * n_b
    usual = np.flatnonzero(times <= WIDE)
    which = np.repeat(usual, times[usual])
    nth = np.arange(len(which)) - np.repeat(np.cumsum(times[usual]) - times[usual], times[usual])
    key = (doc[which] << 32) | (ids_a[from_a[which] + nth // n_b[which]].astype(np.int64) << 16) | ids_b[from_b[which] + nth % n_b[which]]
    key, count = np.unique(key, return_counts=True)
    for g in np.flatnonzero(times > WIDE):
        one, one_times = np.unique(ids_a[from_a[g] : from_a[g] + n_a[g]], return_counts=True)
        two, two_times = np.unique(ids_b[from_b[g] : from_b[g] + n_b[g]], return_counts=True)
        own = (doc[g] << 32) | (one.astype(np.int64)[:, None] << 16) | two[None, :]
        key, back = np.unique(np.concatenate([key, own.ravel()]), return_inverse=True)
        both = np.concatenate([count, np.outer(one_times, two_times).ravel()])
        count = np.zeros(len(key), np.int64)
        np.add.at(count, back, both)
    return key, count


_PLACES = 10 ** np.arange(4, -1, -1)
_NUMBERS = np.arange(1 << 16)
_DIGITS = np.zeros((1 << 16, 6), np.uint8)  # and a place for the character behind
_DIGITS[:, :5] = _NUMBERS[:, None] // _PLACES % 10 + 48
_SHOWN = np.ones((1 << 16, 6), bool)
_SHOWN[:, :4] = _NUMBERS[:, None] >= _PLACES[:4]
_WIDTH = _SHOWN.sum(1)


def _spelled(ids: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Decimal numbers of up to five digits, each with a character behind it, as bytes, and where each ends."""
    digits = _DIGITS[ids]
    digits[:, 5] = behind
    return digits[_SHOWN[ids]], np.cumsum(_WIDTH[ids])


def _digests(ids_a: np.ndarray, ids_b: np.ndarray, group: np.ndarray, doc: np.ndarray, docs: int) -> list[str]:
    """Of each document the digest of its groups, written as ``a1,a2|b1;a3|b2,b3``; an empty string without tokens."""
    from_a, n_a, from_b, n_b = group
    at = np.cumsum(n_a + n_b) - n_a - n_b  # groups follow each other, with a's ids before b's
    both = np.empty(len(ids_a) + len(ids_b), np.uint16)
    behind = np.full(len(both), ord(","), np.uint8)
    both[np.arange(len(ids_a)) + np.repeat(at - from_a, n_a)] = ids_a
    both[np.arange(len(ids_b)) + np.repeat(at + n_a - from_b, n_b)] = ids_b
    behind[at + n_a - 1] = ord("|")
    behind[at + n_a + n_b - 1] = ord(";")
    body, ends = _spelled(both, behind)
    body = body.tobytes()
    ends = np.concatenate([[0], ends])
    bounds = np.concatenate([at, [len(both)]])[np.searchsorted(doc, np.arange(docs + 1))]
    cut = ends[bounds].tolist()
    return [hashlib.sha256(body[lo : hi - 1]).hexdigest() if hi > lo else "" for lo, hi in zip(cut[:-1], cut[1:], strict=True)]


def _slice(piece: pa.RecordBatch, a: Bytes, b: Pieces) -> tuple[dict[str, list], tuple[np.ndarray, np.ndarray]]:
    """Rows of a slice's documents, and its different pairs with the number of its documents that hold them."""
    (ids_a, size_a), (ids_b, size_b) = encoded(piece.column("text"), a, b)
    docs = piece.num_rows
    # Texts follow each other in both arrays, and no group crosses their ends, since those are common.
    from_a, from_b, count = common_ends(np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b]))
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    edges = []
    for first in (from_a, from_b):
        upto = np.repeat(first, count) + nth + 1
        since = np.concatenate([[0], upto[:-1]]) if len(upto) else upto
        edges += [since, upto - since]
    group = np.array(edges)
    doc = np.searchsorted(np.cumsum(size_a), group[0], "right")
    key, times = _linked(ids_a, ids_b, group, doc)
    owner, pair = key >> 32, key & 0xFFFFFFFF
    pairs = np.unique(pair)
    place = np.searchsorted(pairs, pair)
    held = np.bincount(place, minlength=len(pairs))
    bounds = np.searchsorted(owner, np.arange(docs + 1))
    n_links = np.zeros(docs, np.int64)
    np.add.at(n_links, owner, times)
    place = place.astype(np.int32)
    rows = {
        "doc_id": piece.column("doc_id"),
        "n_a": size_a,
        "n_b": size_b,
        "n_groups": np.bincount(doc, minlength=docs).astype(np.int64),
        "n_links": n_links,
        "groups_sha256": _digests(ids_a, ids_b, group, doc, docs),
        "places": [place[lo:hi].tobytes() for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)],
        "times": [times[lo:hi].astype(np.int64).tobytes() for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)],
    }
    return rows, (pairs, held)


_DOCS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, times binary"
_MADE = f"slice long, {_DOCS}, pairs array<struct<a:int,b:int,docs:long>>"
_PAIRS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("docs", pa.int64())]))
_TYPES = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.binary()]


def _aligned(docs: DataFrame, name_a: str, name_b: str) -> DataFrame:
    """Documents, and for each slice a row with its pairs, whose places the documents name."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        a, b = _worker(Bytes, name_a), _worker(Pieces, name_b)
        slice_id = TaskContext.get().partitionId() << 32
        names = ["slice", *(c.split()[0] for c in _DOCS.split(", ")), "pairs"]
        for batch in batches:
            for piece in words.slices(batch):
                rows, (pairs, held) = _slice(piece, a, b)
                n = piece.num_rows
                made = [pa.array(v, t) for v, t in zip(rows.values(), _TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, slice_id)), *made, pa.nulls(n, _PAIRS)], names)
                if len(pairs):
                    fields = [pa.array((pairs >> 16).astype(np.int32)), pa.array((pairs & 0xFFFF).astype(np.int32)), pa.array(held)]
                    inner = pa.StructArray.from_arrays(fields, ["a", "b", "docs"])
                    lists = pa.ListArray.from_arrays(pa.array([0, len(inner)], pa.int32()), inner)
                    yield pa.RecordBatch.from_arrays([pa.array([slice_id]), *[pa.nulls(1, t) for t in _TYPES], lists.cast(_PAIRS)], names)
                slice_id += 1

    return docs.select("doc_id", "text").mapInArrow(run, _MADE)


def align(docs: DataFrame, vocabulary_a: str = BYTE_VOCABULARY, vocabulary_b: str = PIECE_VOCABULARY) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = stored(_aligned(docs, _sent(spark, vocabulary_a), _sent(spark, vocabulary_b)), "aligned")
    pairs = made.filter("pairs IS NOT NULL").select("slice", F.posexplode("pairs").alias("place", "pair")).select("slice", "place", "pair.*")
    counts = stored(pairs.groupBy("a", "b").agg(F.sum("docs").alias("count")), "counts")
    best = counts.groupBy("a").agg(F.max("count").alias("most"))
    judged = counts.join(best, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))
    asked = pairs.join(judged, ["a", "b"]).select(F.col("slice").alias("part"), "place", "count", "best")

    def summed(own: pa.Table, looked_up: pa.Table) -> pa.Table:
        count = np.zeros(looked_up.num_rows, np.int64)
        best = np.zeros(looked_up.num_rows, np.int64)
        place = looked_up.column("place").to_numpy()
        count[place] = looked_up.column("count").to_numpy()
        best[place] = looked_up.column("best").to_numpy()
        sums = [], []
        for at, n in zip(own.column("places"), own.column("times"), strict=True):
            at, n = np.frombuffer(at.as_buffer(), np.int32), np.frombuffer(n.as_buffer(), np.int64)
            sums[0].append(int(n @ best[at]))
            sums[1].append(int(n @ count[at]))
        given = own.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        given = given.append_column("n_best", pa.array(sums[0], pa.int64())).append_column("count_sum", pa.array(sums[1], pa.int64()))
        return given.append_column("groups_sha256", own.column("groups_sha256"))

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return made.filter("pairs IS NULL").drop("pairs").groupBy("slice").cogroup(asked.groupBy("part")).applyInArrow(summed, schema)
