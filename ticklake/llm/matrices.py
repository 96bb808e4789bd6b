"""Token ids packed into rows of one width, by best-fit decreasing (operator 10).

Whole texts become 16-bit ids, each ended by the separator id. Documents longer than a row are cut into pieces
without loss. Pieces are taken longest first; a segment tree over room sizes finds the row with the least
room that takes a piece. A result row is one row of the id matrix, padded, with the cumulative lengths of
its segments and positions that start at 0 in each.

Encoding and packing happen in the task that reads the documents, in chunks of at most ``CHUNK`` ids: ids are
never shuffled, memory is bounded, and no group exists that could grow. A retried task reads the same rows
and gives the same result.

Edge cases: NULL or empty text is the separator alone; repeated rows and ids are packed once each; NULL ids are
carried; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.packing import pieces
from ticklake.llm.tokens import DTYPE, VOCABULARY, encoder
from ticklake.llm.words import slices

WIDTH = 2048
SEPARATOR = 50256
CHUNK = 4_000_000

SCHEMA = (
    "matrix_row long, n_tokens int, ids binary, positions binary, cu_seqlens array<int>, "
    "doc_ids array<long>, pieces array<int>"
)


class RoomTree:
    """Segment tree over room sizes 0..width: how many rows have each; finds the smallest that suffices."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, change: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += change
            node >>= 1

    def smallest(self, least: int) -> int | None:
        node = least + self.leaves
        if self.count[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(sizes: list[int], width: int) -> list[int]:
    """Row of each piece; pieces are given longest first."""
    tree, held, where, rows = RoomTree(width), {}, [], 0
    for size in sizes:
        room = tree.smallest(size)
        if room is None:
            room, row, rows = width, rows, rows + 1
        else:
            row = held[room].pop()
            tree.add(room, -1)
        where.append(row)
        if room > size:
            held.setdefault(room - size, []).append(row)
            tree.add(room - size, 1)
    return where


def pack_chunk(ids: pa.Array, codes: list[bytes], width: int, first: int) -> tuple[pa.RecordBatch, int]:
    """Matrix rows of a chunk of encoded documents, and their number."""
    length = np.array([len(c) // 2 for c in codes], np.int64)
    row, number, begin, size = pieces(length, width)
    order = np.lexsort((number, row, -size))
    where = np.array(best_fit_decreasing(size[order].tolist(), width))
    order = order[np.argsort(where, kind="stable")]
    where = np.sort(where)
    flat = np.frombuffer(b"".join(codes), DTYPE)
    source = (np.cumsum(length) - length)[row] + begin
    lengths = size[order]
    step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    rows = int(where[-1]) + 1
    filled = np.bincount(where, lengths, rows).astype(np.int64)
    at = np.repeat(np.arange(rows) * width - (np.cumsum(filled) - filled), filled) + np.arange(filled.sum())
    matrix = np.full(rows * width, SEPARATOR, DTYPE)
    matrix[at] = flat[np.repeat(source[order], lengths) + step]
    positions = np.zeros(rows * width, DTYPE)
    positions[at] = step
    segments = np.bincount(where, minlength=rows)
    offsets = np.concatenate([[0], np.cumsum(segments)])
    bounds = np.zeros(len(where) + rows, np.int64)  # each row's list starts with 0
    bounds[np.arange(len(where)) + where + 1] = np.cumsum(lengths) - (np.cumsum(filled) - filled)[where]
    lists = pa.array(offsets, pa.int32())
    columns = [
        pa.array(first + np.arange(rows)),
        pa.array(filled, pa.int32()),
        pa.array([m.tobytes() for m in matrix.reshape(rows, width)], pa.binary()),
        pa.array([p.tobytes() for p in positions.reshape(rows, width)], pa.binary()),
        pa.ListArray.from_arrays(pa.array(offsets + np.arange(rows + 1), pa.int32()), pa.array(bounds, pa.int32())),
        pa.ListArray.from_arrays(lists, ids.take(pa.array(row[order]))),
        pa.ListArray.from_arrays(lists, pa.array(number[order], pa.int32())),
    ]
    return pa.RecordBatch.from_arrays(columns, ["matrix_row", "n_tokens", "ids", "positions", "cu_seqlens", "doc_ids", "pieces"]), rows


def packed_matrices(docs: DataFrame, width: int = WIDTH, path: str = VOCABULARY, chunk: int = CHUNK) -> DataFrame:
    """The id matrix of ``docs`` with (doc_id, text), one result row for each of its rows."""

    def run(batches):
        code = encoder(path)
        end = np.array([SEPARATOR], DTYPE).tobytes()
        first = TaskContext.get().partitionId() << 40
        ids, codes, held = [], [], 0
        for batch in batches:
            for piece in slices(batch):
                new = [code.encode(x or "") + end for x in piece.column("text").to_pylist()]
                ids.append(piece.column("doc_id"))
                codes += new
                held += sum(map(len, new)) // 2
                if held >= chunk:
                    made, n = pack_chunk(pa.chunked_array(ids).combine_chunks(), codes, width, first)
                    yield from _thin(made)
                    first, ids, codes, held = first + n, [], [], 0
        if codes:
            yield from _thin(pack_chunk(pa.chunked_array(ids).combine_chunks(), codes, width, first)[0])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, SCHEMA)


def _thin(batch: pa.RecordBatch, rows: int = 512):
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def write_matrices(docs: DataFrame, path: str, width: int = WIDTH, vocabulary: str = VOCABULARY) -> None:
    """Write the id matrix as Parquet, in parts by task."""
    packed_matrices(docs, width, vocabulary).write.mode("overwrite").parquet(path)
