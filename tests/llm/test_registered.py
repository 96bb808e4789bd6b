"""Registered queries without SQL, on the given tables, against plain versions."""

import collections

import numpy as np

from ticklake.llm import packing
from ticklake.llm.queries import QUERIES

from .test_dedup import bag, digest, near_brute, passages

SF_DIR = "/root/testdata/sf0.001"


def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


def test_passages(spark):
    want = collections.Counter()
    for (doc_id, n, removed, kept), times in passages(texts(spark), 35).items():
        want[doc_id, n, removed, digest(kept)] += times
    assert bag(QUERIES["op3_substring_dedup"](spark, SF_DIR).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()) == want


def test_near_duplicates(spark):
    got = QUERIES["op6_minhash_near_dedup"](spark, SF_DIR).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert bag(got) == near_brute(texts(spark), 85)


def test_neighbours(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    got = collections.defaultdict(list)
    for r in QUERIES["op7_nearest_vectors"](spark, SF_DIR).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    found = wanted = 0
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((v - v[ids == q][0]) ** 2).sum(1))
        true = {int(i) for i in sorted(ids[ids != q], key=lambda i: (far[ids == i][0], i))[:10]}
        assert got[q] == sorted(got[q]) and np.allclose([s for s, _ in got[q]], [far[ids == i][0] for _, i in got[q]], rtol=1e-14)
        found += len(true & {i for _, i in got[q]})
        wanted += len(true)
    assert found >= 0.9 * wanted > 0


def test_packing_places_every_token(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: r.length for r in packing.token_lengths(docs).groupBy("doc_id").sum("length").toDF("doc_id", "length").collect()}
    have = collections.Counter()
    for r in QUERIES["op5_best_fit_packing"](spark, SF_DIR).collect():
        have[r.doc_id] += r.length
    assert {d: n for d, n in have.items() if n} == {d: n for d, n in want.items() if n}
