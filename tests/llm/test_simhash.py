"""Fingerprints and their components against brute force."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ticklake.llm import simhash
from ticklake.llm.queries import QUERIES

from .data import SCHEMA, documents, words

SF_DIR = "/root/testdata/sf0.001"


def fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    prints = [(r[0], fingerprint(r[1])) for r in rows]
    near = {(f, g) for f in {f for _, f in prints} for g in {g for _, g in prints} if (f ^ g).bit_count() <= 3}
    by_id = collections.defaultdict(set)
    for d, f in prints:
        if d is not None:
            by_id[d].add(f)
    near |= {(f, g) for fs in by_id.values() for f in fs for g in fs}
    of = components({f for _, f in prints}, near)
    least = {}
    for d, f in prints:
        if d is not None:
            least[of[f]] = min(d, least.get(of[f], d))
    return collections.Counter((d, f"{f:016x}", least.get(of[f])) for d, f in prints)


def result(df):
    return collections.Counter(tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect())


def test_small_awkward_table(spark):
    rows = documents()
    rows += [(200 + i, " ".join([*rows[11][1].split()[: 5000 + i]]), "en", "a", 0) for i in range(6)]  # near copies of a long text
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("fingerprint", F.lit(1)).withColumn("component_id", F.lit(2))
    assert result(simhash.near_duplicates(docs)) == brute(rows)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert result(QUERIES["op12_simhash_near_dedup"](spark, SF_DIR)) == brute(rows)


def test_spark_hashes_alike(spark):
    text = "Ab c  d\té"
    assert spark.range(1).select(F.xxhash64(F.lit("ab c d"))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(b"ab c d", 42)
    assert simhash.fingerprints(pa.array([text]))[0] == fingerprint(text)


@pytest.mark.parametrize("most", [16, simhash.LIST])
def test_links_of_dense_fingerprints(spark, most):
    """Many fingerprints around a few centres: short lists, divided ones and blanked ones give the same components."""
    rng = random.Random(3)
    ids = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(60):
            ids.add(centre ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(0, 7))))
    ids = sorted(np.array(list(ids), np.uint64).view(np.int64).tolist())
    links = simhash.links(spark.createDataFrame([(i,) for i in ids], "id long"), most).collect()
    wide = {i: i % (1 << 64) for i in ids}
    near = [(a, b) for a in ids for b in ids if a < b and (wide[a] ^ wide[b]).bit_count() <= 3]
    assert all(a < b and (a, b) for a, b in links)
    assert components(ids, links) == components(ids, near)


def test_within_counts_bytes_and_bits():
    fps = np.array([0, 0b111, 0b1111, 1 << 60 | 1 << 40 | 1 << 20, 1 << 60 | 1 << 40 | 1 << 20 | 1], np.uint64)
    got = set(zip(*(x.tolist() for x in simhash.within(fps)), strict=True))
    assert got == {(0, 1), (0, 3), (1, 2), (3, 4)}
