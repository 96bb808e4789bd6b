"""Registered queries against their SQL, and the pipeline against its stages done plainly."""

import collections
import os

import pytest

import corpus_pipeline
from ticklake.llm.queries import THRESHOLD, quality_labels
from ticklake.llm.registry import ORACLES, QUERIES
from ticklake.llm import mixing, packing, quality
from tests.oracle import compare, connect

from .data import SCHEMA, documents
from .test_dedup import near_brute

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_names():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name])


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = quality.train(docs, quality_labels(spark, SF_DIR))
    good = [r for r in quality.score(docs, model).collect() if r.score >= THRESHOLD]
    first = {}
    for r in sorted(good, key=lambda r: r.doc_id):
        first.setdefault(r.text, r)
    rows = [r for r in first.values()]
    kept = {k[0] for k in near_brute([(r.doc_id, r.text) for r in rows], 80) if k[3]}
    rest = spark.createDataFrame([tuple(r)[:5] for r in rows if r.doc_id in kept], docs.schema)
    want = packing.token_lengths(mixing.expanded(rest)).collect()
    total = collections.Counter()
    for r in want:
        total[r.doc_id] += r.length
    have = collections.Counter()
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        have[r.doc_id] += r.length
    assert have == total and len(have) > 50


def test_stages_keep_columns_and_edge_rows(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        assert out.count() > 0
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= docs.count()
