"""Whitened vectors against plain linear algebra with exact sums."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.llm import whitening
from ticklake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plain(vectors):
    """(n, x, V): whole numbers and their covariance in doubles."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n = len(x)
    sums = [sum(c) for c in zip(*x, strict=True)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums, strict=True)] for v in x])
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    return n, centred, deviation, centred.T @ centred / n


def check(rows, vectors, ids, components):
    n, centred, deviation, v = plain(vectors)
    values = np.sort(np.linalg.eigvalsh(v))[::-1]
    k = min(components, len(v))
    assert len(rows) == n * k
    table = np.zeros((n, k))
    place = {i: at for at, i in enumerate(ids)}
    for r in rows:
        at = place[r.vec_id]
        table[at, r.component - 1] = r.whitened
        assert r.n == n and int(r.deviation) == deviation[at]
        assert abs(r.explained - values[r.component - 1] / np.trace(v)) <= 1e-4 * r.explained + 1e-12
        assert r.identity_error <= 1e-4
    known = values[:k] > 1e-9 * values[0]
    assert (np.abs(table[:, ~known]) == 0).all()
    # Columns are the projections on unit eigenvectors: whitened'whitened is n times the identity, and V maps as it should.
    t = table[:, known]
    assert np.allclose(t.T @ t / n, np.eye(t.shape[1]), atol=1e-9)
    back = centred.T @ t / n / np.sqrt(values[:k][known])  # the eigenvectors, up to rounding
    assert np.allclose(v @ back, back * values[:k][known], atol=1e-9 * values[0])
    assert np.allclose((back * back).sum(0), 1, atol=1e-9)
    assert np.allclose(centred @ back / np.sqrt(values[:k][known]), t, atol=1e-7)


def test_query(spark):
    rows = QUERIES["op11_embedding_whitening"](spark, SF_DIR).collect()
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    check(rows, [r.embedding for r in table], [r.vec_id for r in table], 32)


def test_edge_rows(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(50, 5)) * [9, 3, 1, 1, 0]  # one constant entry
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    odd = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0]), (103, [math.nan] * 5), (104, [1.0, 1.0, math.inf, 1.0, 1.0])]
    other = [(200, [0.0, 0.0]), (200, [0.0, 0.0]), (None, [3.0, 1.0])]
    df = spark.createDataFrame(rows + odd + other, "vec_id long, embedding array<double>").withColumn("n", F.lit("x")).withColumn("component", F.lit(1))
    got = whitening.whiten(df.repartition(4), 32).collect()
    check([r for r in got if r.vec_id is not None and r.vec_id < 100], vectors, range(50), 32)
    rest = [r for r in got if r.vec_id is None or r.vec_id >= 100]
    assert len(rest) == 3 * 2 and {r.n for r in rest} == {3}
    # Two equal rows and a third: one component has variance, the other is whitened to zero.
    assert [r.whitened for r in rest if r.component == 2] == [0.0] * 3
    assert sorted(round(abs(r.whitened), 9) for r in rest if r.component == 1) == sorted(round(x, 9) for x in (0.5**0.5, 0.5**0.5, 2**0.5))
    assert whitening.whiten(df.limit(0)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [2.0, 3.0])], "vec_id long, embedding array<float>")).collect()
    assert [(r.whitened, r.explained, r.deviation) for r in one] == [(0.0, 0.0, 0)] * 2


def test_huge_entries_stay_exact(spark):
    vectors = [[2.0**39, 1.0], [-(2.0**39), 0.5], [3.0, 7.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(df).collect()}
    assert got == dict(enumerate(plain(vectors)[2]))
    with pytest.raises(Exception, match="whitened exactly"):
        whitening.whiten(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>")).collect()


@pytest.mark.parametrize(
    "values",
    [np.linspace(1, 1000, 48), [5.0] * 8 + [5 + 1e-9] * 8 + [1.0] * 8 + [0.0] * 8, np.logspace(0, -12, 24), [1.0, 1 + 1e-7, 1 + 2e-7, 1 - 1e-7, 3.0]],
)
def test_refined_eigenvectors(values):
    values = np.array(values)
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(len(values),) * 2))[0]
    a = (q * values) @ q.T
    a = ((a + a.T) / 2).astype(whitening.WIDE)
    w, x = whitening.eigen(a)
    assert (np.diff(w) <= 0).all()
    assert np.abs(a @ x - x * w).max() < 1e-17 * np.abs(a).max()
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17


def test_products_are_exact():
    for top in (100, 1 << 30, 1 << 45):
        y = np.random.default_rng(top).integers(-top, top, (300, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j], strict=True)) for j in range(3)] for i in range(3)]
        assert whitening.products(y).tolist() == want
