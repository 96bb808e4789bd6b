"""Near duplicates by SimHash, found in a byte-position inverted index with count filtering (operator 12).

A document's fingerprint has a bit for each place in which over half the hashes of its shingles (repeats included)
have one. Two fingerprints of 64 bits that differ in at most 3 bits share at least 5 of their 8 positional bytes: that
is the guaranteed minimum of matches. Lists of single bytes would each hold a 256th of all fingerprints, so the index
holds combinations of positional bytes: of any 5 shared bytes at least 3 lie in one half, so the 8 triples of bytes
within a half find every pair. Pairs that meet in a list have their shared positional bytes tallied; those that
reach the minimum are verified bit by bit.

Lists of more than ``LIST`` fingerprints are not compared. They are divided by one more positional byte, of those that
the count filter still asks for, until the minimum is shared. Lists that are still long then (many fingerprints around
one text) differ in 3 bytes only, and are resolved without pairs: each fingerprint is filed with every choice of 3
of these 24 bits blanked out, and what meets there, 8 fingerprints at most, is linked. So work grows with the number
of fingerprints, whatever they look like, and no list is ever held beyond its bound.

Copies are one fingerprint from the start. What leaves a list are links to its smallest connected member, not pairs.

Edge cases: NULL, empty and blank texts have fingerprint zero and are linked like any other; texts shorter than
a shingle are one shingle; very long texts are taken as wholes; rows that share an id are one node, and link the
fingerprints they have; rows with a NULL id get the component of their fingerprint's other rows, or NULL if there
are none; an empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm import groups, words
from ticklake.session import stored

SHINGLE = 3
SEED = 42
BITS = 3  # fingerprints that differ in at most this many bits are linked
BYTES = 8
LEAST = BYTES - BITS  # positional bytes that linked fingerprints share at least
LIST = 2048
HALVES = (range(4), range(4, 8))
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _mask(places: tuple[int, ...]) -> int:
    return sum(0xFF << 8 * p for p in places)


def fingerprints(column: pa.Array, width: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """One unsigned 64-bit fingerprint for each text."""
    w = words.split(column, lower=True, hashed=False)
    out = np.zeros(len(column), np.uint64)
    count = np.diff(w.first)
    full = np.flatnonzero(count)
    if not len(full):
        return out
    # All words with one space behind each, so that a shingle is a stretch of bytes.
    length = w.ends - w.starts
    end = np.cumsum(length + 1) - 1
    body = np.full(end[-1] + 1, 32, np.uint8)
    letters = np.ones(len(body), bool)
    letters[end] = False
    body[letters] = w.data[~words._SPACE[w.data]]
    start, data = end - length, body.tobytes()
    span = np.minimum(count, width)
    shingles = np.maximum(count - width + 1, np.minimum(count, 1))
    first = np.concatenate([[0], np.cumsum(shingles)])
    doc = np.repeat(np.arange(len(column)), shingles)
    head = w.first[doc] + np.arange(first[-1]) - first[doc]
    tail = head + span[doc] - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(data[a:b], seed) for a, b in zip(start[head].tolist(), end[tail].tolist(), strict=True)), np.uint64, len(head))
    ones = np.zeros((len(full), 64), np.int64)
    for byte in range(BYTES):  # by bytes, which bounds the memory of the bits
        bits = np.unpackbits((h >> np.uint64(8 * byte)).astype(np.uint8)[:, None], axis=1, bitorder="little")
        ones[:, 8 * byte : 8 * byte + 8] = np.add.reduceat(bits, first[full], axis=0, dtype=np.int64)
    out[full] = np.packbits(2 * ones > shingles[full, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def within(fps: np.ndarray, bits: int = BITS, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b), a < b, of fingerprints that share ``BYTES - bits`` positional bytes and differ in at most ``bits`` bits."""
    out = [], []
    for lo in range(0, len(fps), block):
        x = fps[lo : lo + block, None] ^ fps[None, lo:]
        unequal = ((x & _LOW) + _LOW | x) & ~_LOW  # one bit for each byte that differs
        a, b = np.nonzero(np.bitwise_count(unequal) <= bits)
        ok = (b > a) & (np.bitwise_count(x[a, b]) <= bits)
        out[0].append(a[ok] + lo)
        out[1].append(b[ok] + lo)
    return np.concatenate(out[0]), np.concatenate(out[1])


def _compared(lists: DataFrame) -> DataFrame:
    """Links (a, b) of (path, id): in each list every member that links connect, with the smallest it is connected with."""

    def work(table, cuts):
        ids, out = table.column("id").to_numpy(), ([], [])
        for lo, hi in zip(cuts, [*cuts[1:], table.num_rows], strict=True):
            own = ids[lo:hi]  # sorted
            least = own[groups.joined(hi - lo, *within(own.view(np.uint64)))]
            out[0].append(least[least != own])
            out[1].append(own[least != own])
        a, b = np.concatenate(out[0]), np.concatenate(out[1])
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return groups.by_group(lists, "path", work, "a long, b long")


def _blanked(lists: DataFrame) -> DataFrame:
    """Links (a, b) of (mask, id), where the mask covers ``LEAST`` shared bytes: what agrees but for ``BITS`` bits outside it."""

    def run(batches):
        for batch in batches:
            masks = batch.column("mask").to_numpy().view(np.uint64)
            ids = batch.column("id").to_numpy().view(np.uint64)
            for mask in np.unique(masks):
                free = [i for i in range(64) if not int(mask) >> i & 1]
                own = ids[masks == mask]
                for bits in combinations(free, BITS):
                    blank = np.uint64(sum(1 << i for i in bits))
                    rest = np.full(len(own), blank).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(rest), pa.array((own & ~blank).view(np.int64)), pa.array(own.view(np.int64))], ["blank", "rest", "id"])

    filed = lists.select("mask", "id").distinct().mapInArrow(run, "blank long, rest long, id long")
    # At most 2^BITS different fingerprints agree in all other bits.
    met = filed.groupBy("blank", "rest").agg(F.collect_set("id").alias("ids")).filter(F.size("ids") > 1)
    return met.select(F.array_min("ids").alias("a"), F.explode("ids").alias("b")).filter("a < b").distinct()


def links(ids: DataFrame, most: int = LIST) -> DataFrame:
    """Pairs (a, b), a < b, of the fingerprints in ``id`` that connect whatever is linked."""
    start = [F.lit(_signed(_mask(p))) for half in HALVES for p in combinations(half, 3)]
    lists = ids.select("id", F.explode(F.array(*start)).alias("mask"))
    short, shared = [], 3
    while True:
        lists = stored(lists.withColumn("key", F.col("id").bitwiseAND(F.col("mask"))), "lists")
        sizes = lists.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        met = stored(lists.join(sizes, ["mask", "key"]), "met")
        short.append(met.filter(F.col("n") <= most).select(F.xxhash64("mask", "key").alias("path"), "id"))
        long = met.filter(F.col("n") > most)
        if long.isEmpty():
            rest = None
            break
        if shared == LEAST:
            rest = _blanked(long)
            break
        # Of the bytes not shared yet LEAST - shared more must be; leaving out one less than that many misses none.
        free = F.filter(F.array(*[F.lit(p) for p in range(BYTES)]), lambda p: F.col("mask").bitwiseAND(_byte(1, p)) == 0)
        place = F.explode(F.slice(free, 1, BYTES - LEAST + 1)).alias("place")
        lists = long.select("id", "mask", place).select("id", F.col("mask").bitwiseOR(_byte(0xFF, F.col("place"))).alias("mask"))
        shared += 1
    found = _compared(reduce(DataFrame.unionByName, short))
    return found if rest is None else found.unionByName(rest)


def _byte(value: int, place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(value).cast("long"), place * 8)


def near_duplicates(docs: DataFrame, width: int = SHINGLE, most: int = LIST) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits) and component_id."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def work(piece):
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(fingerprints(piece.column("text"), width).view(np.int64))], ["doc_id", "id"])

    rows = stored(words.by_slice(docs, work, "doc_id long, id long"), "fingerprints")
    classes = stored(rows.groupBy("id").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "classes")
    found = links(classes.select("id"), most)
    # Rows that share an id connect their fingerprints.
    own = rows.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a < z")
    also = rows.join(own.select("doc_id", "a"), "doc_id").filter("a < id").select("a", F.col("id").alias("b"))
    reach = groups.components(found.unionByName(also.distinct()))
    named = classes.join(reach, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = stored(named.join(least, "component").select("id", "n", "component_id"), "labels")
    # Fingerprints of many rows, fewer than 4 a partition, are looked up where the rows are.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = labels.filter(F.col("n") * (4 * parts) > rows.count()).select("id", F.col("component_id").alias("hot_id"), F.lit(True).alias("hot"))
    marked = rows.join(F.broadcast(hot), "id", "left")
    at_once = marked.filter("hot").select("doc_id", "id", F.col("hot_id").alias("component_id"))
    others = marked.filter("hot IS NULL").select("doc_id", "id").join(labels.select("id", "component_id"), "id")
    both = at_once.unionByName(others.select("doc_id", "id", "component_id"))
    return both.select("doc_id", F.lower(F.lpad(F.hex("id"), 16, "0")).alias("fingerprint"), "component_id")
