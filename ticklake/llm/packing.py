"""Packing documents into sequences of several permitted lengths by best fit (operator 5).

Documents longer than the largest capacity are cut into pieces without loss. Pieces are taken longest first; each
goes to the open sequence with the least room that still takes it. Where none does, a new one is opened at
the capacity with the least cost per token that it is expected to hold: a sequence costs ``c + c * c /
QUADRATIC`` (attention grows with the square), and its free room is expected to fill as well as sequences
did so far. In the end every sequence shrinks to the smallest capacity that holds its contents.

Work is dealt out by a hash of the row and done in chunks of at most ``CHUNK`` pieces, so memory is bounded and no
group grows with the data; sequences never span chunks. Retried tasks give the same result: the hash
fixes what a partition holds, and chunks are sorted.

Edge cases: NULL or zero length needs no room: the row is returned with one piece of length 0 and a NULL sequence;
repeated rows and ids are packed once each; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.tokens import VOCABULARY, encoder
from ticklake.llm.words import by_slice

CAPACITIES = (512, 1024, 2048, 4096, 8192)
QUADRATIC = 16384
CHUNK = 100_000

SCHEMA = "doc_id long, piece int, begin long, length int, sequence long, capacity int, position int"


def token_lengths(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id and the number of tokens of each whole text (NULL: 0)."""

    def work(piece):
        code = encoder(path)
        n = [len(code.encode(x or "")) // 2 for x in piece.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(n, pa.int64())], ["doc_id", "length"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return by_slice(picked, work, "doc_id long, length long")


class Rooms:
    """Open sequences by the room they have left; the tightest that takes a piece is found by bits."""

    def __init__(self):
        self.bits = 0
        self.held: dict[int, list[int]] = {}

    def put(self, room: int, sequence: int) -> None:
        self.held.setdefault(room, []).append(sequence)
        self.bits |= 1 << room

    def take(self, size: int) -> tuple[int, int] | None:
        rest = self.bits >> size
        if not rest:
            return None
        room = size + (rest & -rest).bit_length() - 1
        found = self.held[room].pop()
        if not self.held[room]:
            self.bits ^= 1 << room
        return room, found


def best_fit(sizes: list[int], capacities: tuple[int, ...] = CAPACITIES) -> tuple[list[int], list[int], list[int]]:
    """Sequence and position of each piece (given longest first), and the sequences' final capacities."""
    capacities = tuple(sorted(capacities))
    cost = [c + c * c / QUADRATIC for c in capacities]
    rooms, opened, filled, where, place = Rooms(), [], [], [], []
    room_total = used_total = 0
    for size in sizes:
        found = rooms.take(size)
        if found is None:
            fill = used_total / room_total if room_total else 1.0
            best = min((i for i, c in enumerate(capacities) if c >= size), key=lambda i: cost[i] / (size + fill * (capacities[i] - size)))
            room, sequence = capacities[best], len(opened)
            opened.append(room)
            filled.append(0)
            room_total += room
        else:
            room, sequence = found
        where.append(sequence)
        place.append(filled[sequence])
        filled[sequence] += size
        used_total += size
        if room > size:
            rooms.put(room - size, sequence)
    return where, place, [next(c for c in capacities if c >= f) for f in filled]


def pieces(length: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, number, begin and length of the pieces of every document; all but a document's last are full."""
    count = np.maximum(1, -(-length // most))
    row = np.repeat(np.arange(len(length)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin = number * most
    return row, number, begin, np.minimum(most, length[row] - begin)


def packed(lengths: DataFrame, capacities: tuple[int, ...] = CAPACITIES, chunk: int = CHUNK) -> DataFrame:
    """Where each piece of each document lies. ``lengths`` has (doc_id, length)."""
    parts = int(lengths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(capacities)

    def place(ids: pa.Array, length: np.ndarray, first: int) -> tuple[pa.RecordBatch, int]:
        row, number, begin, size = pieces(length, most)
        order = np.lexsort((number, row, -size))
        order = order[size[order] > 0]
        where, at, final = best_fit(size[order].tolist(), capacities)
        sequence, capacity, position = np.full(len(row), -1), np.zeros(len(row), int), np.zeros(len(row), int)
        sequence[order] = where
        capacity[order] = np.array(final, int)[where] if where else 0
        position[order] = at
        none = sequence < 0
        columns = [
            ids.take(pa.array(row)), pa.array(number, pa.int32()), pa.array(begin), pa.array(size, pa.int32()),
            pa.array(first + sequence, pa.int64(), mask=none), pa.array(capacity, pa.int32(), mask=none), pa.array(position, pa.int32(), mask=none),
        ]
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SCHEMA.split(", ")]), len(final)

    def run(batches):
        first = TaskContext.get().partitionId() << 40
        waiting, rows = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, chunk):
                part = batch.slice(lo, chunk)
                if rows + part.num_rows > chunk and rows:
                    made, n = place(*_joined(waiting), first)
                    yield made
                    first, waiting, rows = first + n, [], 0
                waiting.append(part)
                rows += part.num_rows
        if rows:
            yield place(*_joined(waiting), first)[0]

    key = F.xxhash64("doc_id", "length")
    dealt = lengths.select("doc_id", F.coalesce("length", F.lit(0)).cast("long").alias("length"), key.alias("key"))
    return dealt.repartition(parts, "key").sortWithinPartitions("key", "doc_id", "length").drop("key").mapInArrow(run, SCHEMA)


def _joined(batches: list[pa.RecordBatch]) -> tuple[pa.Array, np.ndarray]:
    whole = pa.Table.from_batches(batches).combine_chunks()
    return whole.column("doc_id").combine_chunks(), np.maximum(0, whole.column("length").to_numpy())
