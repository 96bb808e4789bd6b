"""Mixing and both kinds of packing."""

import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.llm import matrices, mixing, packing
from ticklake.llm.tokens import DTYPE, Encoder, VOCABULARY, encoder

from .data import SCHEMA, documents, words


def plain_targets(sizes, repeats=3):
    """By raising one level until all is given out."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    open_, target, left = set(names), {}, float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > repeats * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = float(repeats * sizes[s])
            left -= target[s]
        open_ -= full
    return target


def test_mix_against_plain_version(spark):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    sizes = collections.Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(words(t))
    target = plain_targets(sizes)
    queue = collections.defaultdict(list)
    for i, t, _, s, _ in rows:
        queue[s].append((hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest(), i if i is not None else -1, len(words(t))))
    expected = collections.Counter()
    for s, items in queue.items():
        before = 0
        for _, i, n in sorted(items):
            taken = sum(max(0, min(n, int(target[s]) - k * sizes[s] - before)) for k in range(3))
            expected[i, n, sizes[s], round(target[s], 6), taken] += 1
            before += n
    got = mixing.mix(df, buckets=4).select(F.coalesce("doc_id", F.lit(-1)), "size", "source_size", F.round("target", 6), "taken")
    assert collections.Counter(tuple(r) for r in got.collect()) == expected
    for s in sizes:
        taken = sum(k[4] * n for k, n in expected.items() if k[2] == sizes[s] and k[3] == round(target[s], 6))
        assert abs(taken - target[s]) <= 3


def test_word_count(spark):
    rows = documents()
    got = spark.createDataFrame(rows, SCHEMA).select("text", mixing.word_count(F.col("text")).alias("n")).collect()
    assert all(r.n == len(words(r.text)) for r in got)


def test_expanded_repeats_rows(spark):
    df = spark.createDataFrame(documents(), SCHEMA)
    got = mixing.expanded(df)
    assert got.columns == df.columns
    most = got.groupBy("doc_id", "text").count().agg(F.max("count")).first()[0]
    assert most <= 6  # three passes, and two rows of the table are the same
    assert mixing.expanded(df.limit(0)).count() == 0


def test_encoding_by_pieces_is_the_whole():
    code = Encoder(VOCABULARY)
    texts = ["", " ", "  a", "a  b", "a \n b", "a\n \nb", "x\n\n y", "tail ", "  x   y", "don't we'll", *(t for _, t, *_ in documents() if t)]
    rng = np.random.default_rng(2)
    texts += ["".join(rng.choice(list("ab \n\t 1.é' "), 12)) for _ in range(3000)]
    for t in texts:
        ids = np.frombuffer(code.encode(t), DTYPE)
        assert ids.tolist() == code._bpe.encode_ordinary(t), repr(t)
        assert code.decode(ids) == t


def test_best_fit_matches_a_plain_search():
    rng = np.random.default_rng(4)
    sizes = sorted(rng.integers(1, 40, 400).tolist(), reverse=True)
    where, place, final = packing.best_fit(sizes, (16, 32, 64))
    room, used = {}, {}
    for size, s, at in zip(sizes, where, place, strict=True):
        if s not in room:  # a new one only where no open one has room
            assert all(r < size for r in room.values())
            room[s], used[s] = None, 0
        else:
            assert room[s] == min(r for r in room.values() if r >= size)
        assert at == used[s]
        used[s] += size
        # The capacity it was opened at shows from the search; take the least that fits the rest of the run.
        room[s] = (room[s] if room[s] is not None else _opened(s, sizes, where)) - size
    assert [next(c for c in (16, 32, 64) if c >= used[s]) for s in range(len(final))] == final


def _opened(s, sizes, where):
    """The capacity a sequence was opened at, from the rule itself."""
    total = room = 0
    cost = {c: c + c * c / packing.QUADRATIC for c in (16, 32, 64)}
    seen = set()
    for size, w in zip(sizes, where, strict=True):
        if w not in seen:
            fill = total / room if room else 1.0
            c = min((c for c in cost if c >= size), key=lambda c: cost[c] / (size + fill * (c - size)))
            if w == s:
                return c
            seen.add(w)
            room += c
        total += size


def test_packed_is_lossless_and_fits(spark):
    rows = [(i, n) for i, n in enumerate([0, 1, 5, 5, 70, 64, 129, 30, 30, 2])] + [(None, 7), (3, 5), (11, None)]
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, length long"), (16, 32, 64), chunk=4).collect()
    total = collections.Counter()
    for i, n in rows:
        total[i] += n or 0
    have = collections.Counter()
    lanes = collections.defaultdict(list)
    for r in got:
        have[r.doc_id] += r.length
        if r.sequence is not None:
            lanes[r.sequence, r.capacity].append((r.position, r.length))
    assert +have == +total and {r.doc_id for r in got} == set(total)
    assert len({s for s, _ in lanes}) == len(lanes)
    for (_, capacity), parts in lanes.items():
        at = 0
        for position, length in sorted(parts):
            assert position == at
            at += length
        assert at <= capacity and capacity in (16, 32, 64) and (capacity == 16 or at > capacity // 2)


def test_room_tree():
    tree = matrices.RoomTree(100)
    for r in (3, 7, 7, 90):
        tree.add(r, 1)
    assert [tree.smallest(k) for k in (0, 3, 4, 7, 8, 90, 91)] == [3, 3, 7, 7, 90, 90, None]
    tree.add(90, -1)
    assert tree.smallest(8) is None


def test_best_fit_decreasing():
    rng = np.random.default_rng(5)
    sizes = sorted(rng.integers(1, 100, 300).tolist(), reverse=True)
    room = {}
    for size, row in zip(sizes, matrices.best_fit_decreasing(sizes, 100), strict=True):
        fitting = [r for r in room.values() if r >= size]
        if row in room:
            assert room[row] == min(fitting)
        else:
            assert not fitting
        room[row] = room.get(row, 100) - size
    assert all(r >= 0 for r in room.values())


@pytest.mark.parametrize("chunk", [200, 10**9])
def test_matrices_hold_every_token(spark, chunk):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("ids", F.lit("clash"))
    code = encoder(VOCABULARY)
    found = collections.defaultdict(list)
    made = matrices.packed_matrices(df, width=64, chunk=chunk).collect()
    assert len({r.matrix_row for r in made}) == len(made)
    for r in made:
        ids, positions = np.frombuffer(r.ids, DTYPE), np.frombuffer(r.positions, DTYPE)
        assert len(ids) == len(positions) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert (ids[r.n_tokens :] == matrices.SEPARATOR).all()
        for a, b, doc, piece in zip(r.cu_seqlens[:-1], r.cu_seqlens[1:], r.doc_ids, r.pieces, strict=True):
            assert positions[a:b].tolist() == list(range(b - a))
            found[doc, piece].append(ids[a:b].tolist())
    expected = collections.defaultdict(list)
    for doc, text, *_ in rows:
        ids = [*code._bpe.encode_ordinary(text or ""), matrices.SEPARATOR]
        for k in range(0, len(ids), 64):
            expected[doc, k // 64].append(ids[k : k + 64])
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}


def test_write_matrices(spark, tmp_path):
    df = spark.createDataFrame(documents()[:6], SCHEMA)
    matrices.write_matrices(df, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).agg(F.sum("n_tokens")).first()[0] > 10


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert packing.packed(packing.token_lengths(df)).count() == 0
    assert matrices.packed_matrices(df).count() == 0
    assert mixing.mix(df.select("doc_id", "source", F.lit(1).alias("size"))).count() == 0
