"""Aligned tokenizations against the vocabularies' own libraries and a plain alignment."""

import bisect
import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.llm import alignment
from ticklake.llm.queries import QUERIES

from .data import SCHEMA, documents

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(alignment.BYTE_VOCABULARY)
    a.encode_special_tokens = True  # their strings in texts are plain text
    return a, SentencePieceProcessor(model_file=alignment.PIECE_VOCABULARY)


def byte_of():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {}, 256
    for b in range(256):
        if b in plain:
            table[chr(b)] = b
        else:
            table[chr(extra)] = b
            extra += 1
    return table


table = byte_of()


def tokens(text, libraries):
    """[(id, bytes)] of both vocabularies, or nothing."""
    if not text:
        return [], []
    a, b = libraries
    one = [(t, bytes(table[c] for c in a.id_to_token(t))) for t in a.encode(" " + text, add_special_tokens=False).ids]
    two = []
    for t in b.encode(text):
        name = b.id_to_piece(t)
        raw = len(name) == 6 and name.startswith("<0x")
        two.append((t, bytes([int(name[3:5], 16)]) if raw else name.replace("▁", " ").encode()))
    body = (" " + text).encode()
    if any(b"".join(p for _, p in side) != body for side in (one, two)):
        return [], []
    return one, two


def groups_of(one, two):
    ends = []
    for side in (one, two):
        at = 0
        ends.append([at := at + len(p) for _, p in side])
    common = sorted(set(ends[0]) & set(ends[1]))
    groups = {e: ([], []) for e in common}
    for which, (side, es) in enumerate(zip((one, two), ends, strict=True)):
        for (t, _), e in zip(side, es, strict=True):
            groups[common[bisect.bisect_left(common, e)]][which].append(t)
    return list(groups.values())


def brute(rows, libraries):
    docs = []
    for doc_id, text in rows:
        one, two = tokens(text, libraries)
        groups = groups_of(one, two)
        docs.append((doc_id, one, two, groups, [(x, y) for g in groups for x in g[0] for y in g[1]]))
    count = collections.Counter(p for *_, links in docs for p in set(links))
    best = {}
    for (x, _), n in count.items():
        best[x] = max(n, best.get(x, 0))
    out = collections.Counter()
    for doc_id, one, two, groups, links in docs:
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[
            doc_id, len(one), len(two), len(groups), len(links),
            sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(spelled.encode()).hexdigest() if spelled else "",
        ] += 1
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def result(df):
    return collections.Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def odd_texts():
    rng = random.Random(5)
    letters = list("ab 'sé\n\t  ▁　中文😀0123\x1c\x85́ ﬁ  ") + ["<|endoftext|>", "<s>", "  ", "<0x41>"]
    return ["".join(rng.choices(letters, k=rng.randrange(1, 30))) for _ in range(150)]


def test_small_awkward_table(spark, libraries, monkeypatch):
    rows = documents() + [(500 + i, t, "en", "a", 0) for i, t in enumerate(odd_texts())]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("slice", F.lit(1)).withColumn("pairs", F.lit(2)).withColumn("n_a", F.lit(3))
    assert result(alignment.align(docs.repartition(5))) == brute([r[:2] for r in rows], libraries)
    assert alignment.align(docs.limit(0)).count() == 0


def test_query(spark, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert result(QUERIES["op13_token_alignment"](spark, SF_DIR)) == brute(rows, libraries)


def test_common_ends():
    rng = random.Random(2)
    for share in (0.02, 0.3, 0.9):
        last = 4000
        a, b = (sorted({*rng.sample(range(1, last), 1000)}) for _ in range(2))
        a = sorted({*a, *(x for x in b if rng.random() < share), last})
        b = sorted({*b, last})
        from_a, from_b, n = alignment.common_ends(np.array(a), np.array(b))
        got = [(i + k, j + k) for i, j, m in zip(from_a, from_b, n, strict=True) for k in range(m)]
        assert got == [(a.index(v), b.index(v)) for v in a if v in set(b)]
    assert [len(x) for x in alignment.common_ends(np.zeros(0, int), np.zeros(0, int))] == [0, 0, 0]


def test_wide_groups_and_forgotten_parts(monkeypatch, libraries):
    import pyarrow as pa

    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    monkeypatch.setattr(alignment, "WIDE", 2)
    a, b = alignment.Bytes(alignment.BYTE_VOCABULARY), alignment.Pieces(alignment.PIECE_VOCABULARY)
    texts = [*odd_texts(), "internationalization of tokenizations", None, ""]
    for _ in range(2):
        rows, (pairs, held) = alignment._slice(pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts}), a, b)
        for i, text in enumerate(texts):
            groups = groups_of(*tokens(text, libraries))
            links = collections.Counter((x, y) for g in groups for x in g[0] for y in g[1])
            place, times = np.frombuffer(rows["places"][i], np.int32), np.frombuffer(rows["times"][i], np.int64)
            assert dict(links) == {(int(pairs[p]) >> 16, int(pairs[p]) & 0xFFFF): n for p, n in zip(place, times, strict=True)}
        assert held.sum() == sum(len(np.frombuffer(p, np.int32)) for p in rows["places"])
