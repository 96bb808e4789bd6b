"""Removal of repeated passages by counting blocks and windows (operator 3).

This stands in place of a relative Lempel-Ziv parse: no document is parsed, and no factor is grown or its length
tested. A block is content-defined: every window of ``width``
words is owned by its smallest ``seed``-gram hash, and windows that follow each other under one owner
form a block, so equal passages are cut into equal blocks wherever they stand. The index counts blocks.

All windows of a block that occurs more than once are repeated. Blocks with one seed that differ as wholes may
still share windows: where a seed has several kinds of blocks, one of them single, the windows of all its
kinds are hashed (128 bits) and counted, over one copy of each kind. These seeds are found by counts, not by
where factors end. Every window is hence judged exactly, however often and wherever its words stand.

Why no parse: whether a window is repeated depends on the window alone, not on the factor it lies in, and a window
has the same owner wherever it stands, so counting finds all that a parse would. Growing factors would need a
document's blocks in order beside a reference that holds all documents; counts need neither, and copies
meet as sums.

What moves: one hash per block (about two in 25 words) to find those that occur twice, blocks with a
repeated seed, windows of such kinds, and compressed texts twice, for those lookups. Counts are summed before they are
shuffled, so copies of a passage meet as one row per task; joins with common blocks are split by AQE.

Edge cases: NULL, empty and short texts have no window and lose nothing; a text of repeated words repeats
its own windows and loses them; of repeated rows each is a document, so all lose what they share; an id that
is NULL or not unique is told apart by its text's hash; an empty table gives an empty result; extra
columns are carried unless they have a name of the result's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm import words
from ticklake.session import stored

WIDTH = 35
SEED = 12
RESULT = ("n_words", "n_removed", "kept")
_OTHER = 0xA0761D6478BD642F


def _packed(df: DataFrame) -> DataFrame:
    """Texts compressed one by one, as they are shuffled (column ``z`` in place of ``text``)."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            at = b.schema.get_field_index("text")
            z = pa.array([None if t is None else pack(t) for t in b.column(at).cast(pa.binary()).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns) if i != at), z], [*(n for n in b.schema.names if n != "text"), "z"])

    return df.mapInArrow(run, df.drop("text").schema.add("z", "binary"))


def _unpacked(df: DataFrame, work, schema) -> DataFrame:
    """``work`` on slices of a bounded number of text bytes, of rows whose texts are packed."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            if not b.num_rows:
                continue
            at = b.schema.get_field_index("z")
            # Sizes are written in front of the texts, so that slices are cut before anything is unpacked.
            sizes = np.array([0 if z is None else zstandard.frame_content_size(z) for z in b.column(at).to_pylist()], np.int64)
            which = np.cumsum(sizes) // words.SLICE_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                part = b.slice(lo, hi - lo)
                texts = pa.array([None if z is None else unpack(z) for z in part.column(at).to_pylist()], pa.binary()).cast(pa.string())
                columns = [texts if i == at else part.column(i) for i in range(b.num_columns)]
                made = work(pa.RecordBatch.from_arrays(columns, ["text" if n == "z" else n for n in b.schema.names]))
                if made.num_rows:
                    yield made

    return df.mapInArrow(run, schema)


def _smallest(h: np.ndarray, span: int) -> np.ndarray:
    """Of every ``span`` values in a row the place of the first smallest one."""
    at = np.arange(len(h))
    have = 1
    while have < span:
        step = min(have, span - have)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(h[a] <= h[b], a, b)
        have += step
    return at


def blocks(w: words.Words, width: int, seed: int) -> dict[str, np.ndarray]:
    """Blocks of a slice: text, seed hash, hash of all words, first window's place in the text, windows."""
    count = len(w.hashes) - width + 1
    inside = words.within(w.first, width, count)
    if count <= 0 or not inside.any():
        return {k: np.zeros(0, np.int64) for k in ("doc", "seed", "block", "start", "windows")}
    h = words.rolling(w.hashes, seed)
    window = np.flatnonzero(inside)
    owner = _smallest(h, width - seed + 1)[window]
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(window) != 1)]))
    lo, last = window[cut], window[np.append(cut[1:], len(window)) - 1]
    hi = last + width
    up, down = words._tables(np.uint64(_OTHER), len(w.hashes) + 1)
    total = np.zeros(len(w.hashes) + 1, np.uint64)
    np.cumsum(words.mix(w.hashes ^ np.uint64(_OTHER)) * up[: len(w.hashes)], out=total[1:])
    body = words.mix((total[hi] - total[lo]) * down[lo]) ^ (hi - lo).astype(np.uint64) ^ ((owner[cut] - lo).astype(np.uint64) << np.uint64(32))
    doc = np.searchsorted(w.first, lo, "right") - 1
    return {"doc": doc, "seed": h[owner[cut]].view(np.int64), "block": words.mix(body).view(np.int64), "start": lo - w.first[doc], "windows": last - lo + 1}


def _lists(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row of each list element, and the elements' fields."""
    row = pa.compute.list_parent_indices(column).to_numpy()
    inner = column.flatten()
    return row, {f.name: inner.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(inner.type)}


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """``docs`` without text, with n_words, n_removed and ``kept``: the words that stay, joined by one space."""
    carried = [c for c in docs.columns if c not in (id_column, text_column, *RESULT)]
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(0)).alias("key"),
        F.coalesce(F.xxhash64(text_column), F.lit(0)).alias("digest"),
        F.col(text_column).cast("string").alias("text"),
        F.col(id_column).alias("id"),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)],
    )
    texts = rows.select("key", "digest", "text")

    def seeds(piece):
        found = blocks(words.split(piece.column("text")), width, seed)
        return pa.RecordBatch.from_arrays([pa.array(found["seed"])], ["seed"])

    def members(piece):
        b = blocks(words.split(piece.column("text")), width, seed)
        doc = pa.array(b["doc"])
        return pa.RecordBatch.from_arrays(
            [piece.column("key").take(doc), piece.column("digest").take(doc), pa.array(b["seed"]), pa.array(b["block"]), pa.array(b["start"], pa.int32()), pa.array(b["windows"], pa.int32())],
            ["key", "digest", "seed", "block", "start", "windows"],
        )

    # Written, so that the join's sides are plain shuffles, of which AQE splits hot partitions.
    twice = stored(words.by_slice(texts, seeds, "seed long").groupBy("seed").count().filter("count > 1").select("seed"), "seeds")
    found = stored(words.by_slice(texts, members, "key long, digest long, seed long, block long, start int, windows int").join(twice, "seed"), "blocks")

    # The index: how often each block occurs, and one of its places.
    place = F.xxhash64("key", "digest", "start")
    index = stored(found.groupBy("seed", "block").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("place")), "index")
    borders = index.groupBy("seed").agg(F.count(F.lit(1)).alias("kinds"), F.min("copies").alias("least")).filter("kinds > 1 AND least = 1").select("seed")
    asked = (
        found.join(index.join(borders, "seed", "left_semi"), ["seed", "block"])
        .filter(F.col("place") == place)
        .groupBy("key", "digest")
        .agg(F.collect_set(F.struct("start", "windows", "seed", "block", "copies")).alias("asked"))
    )

    def windows(piece):
        w = words.split(piece.column("text"))
        row, a = _lists(piece.column("asked"))
        at = np.repeat(w.first[row] + a["start"], a["windows"])
        nth = np.arange(len(at)) - np.repeat(np.cumsum(a["windows"]) - a["windows"], a["windows"])
        at += nth
        one = words.rolling(w.hashes, width)
        two = words.rolling(words.mix(w.hashes ^ np.uint64(_OTHER)), width, _OTHER | 1)
        again = {k: np.repeat(a[k], a["windows"]) for k in ("seed", "block", "copies")}
        return pa.RecordBatch.from_arrays(
            [pa.array(one[at].view(np.int64)), pa.array(two[at].view(np.int64)), *map(pa.array, again.values()), pa.array(nth, pa.int32())],
            ["one", "two", *again, "nth"],
        )

    border = stored(_unpacked(_packed(texts).join(asked, ["key", "digest"]), windows, "one long, two long, seed long, block long, copies long, nth int"), "borders")
    again = border.groupBy("one", "two").agg(F.sum("copies").alias("n")).filter("n > 1").select("one", "two")
    shared = (
        border.filter("copies = 1")
        .join(again, ["one", "two"])
        .groupBy("seed", "block")
        .agg(F.bit_or(F.expr("shiftleft(1L, nth)")).alias("mask"))
    )
    every = F.lit(-1).cast("long").alias("mask")
    verdict = index.filter("copies > 1").select("seed", "block", every).unionByName(shared.select("seed", "block", "mask"))
    factors = found.join(verdict, ["seed", "block"]).groupBy("key", "digest").agg(F.collect_set(F.struct("start", "windows", "mask")).alias("factors"))
    judged = _packed(rows).join(factors, ["key", "digest"], "left").drop("key", "digest")

    def cut(piece):
        w = words.split(piece.column("text"), hashed=False)
        row, f = _lists(piece.column("factors"))
        change = np.zeros(len(w.starts) + 1, np.int64)
        for nth in range(width - seed + 1):
            hit = (nth < f["windows"]) & ((f["mask"] >> nth) & 1 == 1)
            at = w.first[row[hit]] + f["start"][hit] + nth
            np.add.at(change, at, 1)
            np.add.at(change, at + width, -1)
        gone = np.cumsum(change)[:-1] > 0
        removed = np.concatenate([[0], np.cumsum(gone)])
        keep = [i for i, n in enumerate(piece.schema.names) if n not in ("text", "factors")]
        return pa.RecordBatch.from_arrays(
            [piece.column(i) for i in keep]
            + [pa.array(np.diff(w.first)), pa.array(removed[w.first[1:]] - removed[w.first[:-1]]), _joined(w, ~gone)],
            [piece.schema.names[i] for i in keep] + list(RESULT),
        )

    schema = judged.drop("z", "factors").schema.add("n_words", "long", False).add("n_removed", "long", False).add("kept", "string", False)
    out = _unpacked(judged, cut, schema)
    return out.select(F.col("id").alias(id_column), *RESULT, *[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)])


def _joined(w: words.Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    out = []
    for lo, hi in zip(w.first[:-1], w.first[1:], strict=True):
        s, e = w.starts[lo:hi][keep[lo:hi]], w.ends[lo:hi][keep[lo:hi]]
        if not len(s):
            out.append("")
            continue
        body = np.append(w.data[s[0] : e[-1]], np.uint8(32))
        take = np.zeros(len(body) + 1, np.int8)
        take[s - s[0]] += 1
        take[e + 1 - s[0]] -= 1
        body[e - s[0]] = 32
        out.append(body[np.cumsum(take[:-1], dtype=np.int8) > 0][:-1].tobytes().decode())
    return pa.array(out, pa.string())
