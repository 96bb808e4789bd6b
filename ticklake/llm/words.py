"""Words, word hashes and rolling hashes of text columns, computed on whole Arrow columns.

A word is a run of bytes other than ASCII white space (``[^\\x20\\x09-\\x0D]+``). Hashes are
polynomials modulo 2^64 over random byte values, finished by a mixing step; they depend on the bytes
of the word only, so they agree between tasks, runs and machines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

SLICE_BYTES = 2_000_000  # of text taken at once; bounds the memory of the arrays below
CHUNK_BYTES = 1 << 20
LONG_WORD = 1 << 16  # bytes; longer words are hashed one by one

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def inverse(base: int) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, at least n of each."""
    have = _POW.get(int(base))
    if have is None or len(have[0]) < n:
        n = max(n, CHUNK_BYTES + LONG_WORD + 1)
        have = _POW[int(base)] = (powers(base, n), powers(inverse(base), n))
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit (constants of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of a slice of texts. ``first`` has the index of each text's first word, and one more."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins (NULL: empty)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(column: pa.Array, lower: bool = False, hashed: bool = True) -> Words:
    data, off = texts_of(column)
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[off] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[off] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    first = np.searchsorted(starts, off)
    return Words(data, starts, ends, first, _hashes(data, starts, ends) if hashed else np.zeros(0, np.uint64))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    lengths = ends - starts
    long = np.flatnonzero(lengths > LONG_WORD)
    for i in long:
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    up, down = _tables(_BASE, 0)
    lo = 0
    while lo < len(starts):
        at = starts[lo]
        hi = int(np.searchsorted(starts, at + CHUNK_BYTES))
        s = starts[lo:hi] - at
        e = np.minimum(ends[lo:hi] - at, s + LONG_WORD)
        values = _BYTE[data[at : at + e[-1]]]
        values *= up[: len(values)]
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values, out=total[1:])
        part = (total[e] - total[s]) * down[s]
        short = lengths[lo:hi] <= LONG_WORD
        out[lo:hi][short] = part[short]
        lo = hi
    return mix(out ^ lengths.astype(np.uint64))


def rolling(values: np.ndarray, width: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hash of every run of ``width`` values, wherever it begins (runs may cross texts)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _tables(np.uint64(base), len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[width:] - total[:-width]) * down[:n])


def within(first: np.ndarray, width: int, n: int) -> np.ndarray:
    """Of n places where a run may begin: whether the run stays inside its text."""
    ok = np.ones(max(0, n), bool)
    if width > 1:
        edge = np.zeros(n + width + 1, np.int32)
        inner = first[1:-1]
        np.add.at(edge, np.clip(inner - width + 1, 0, n + width), 1)
        np.add.at(edge, np.clip(inner, 0, n + width), -1)
        ok = np.cumsum(edge[:n]) == 0
    return ok


def slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in pieces of a bounded number of text bytes, one row at least."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths)
    lo = 0
    while lo < batch.num_rows:
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + SLICE_BYTES, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def by_slice(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, text: str = "text") -> DataFrame:
    """``work`` on every slice of the rows, inside the tasks that read them."""

    def run(batches):
        for batch in batches:
            for piece in slices(batch, text):
                made = work(piece)
                if made is not None and made.num_rows:
                    yield made

    return df.mapInArrow(run, schema)
