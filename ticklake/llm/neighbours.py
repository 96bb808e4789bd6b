"""Approximate nearest neighbours by cross-polytope hashing (operator 7).

A vector is scaled to unit length, padded to a power of two and turned by a fast pseudo-rotation: three rounds of
random signs and a Hadamard transform. Its hash is the nearest signed axis of the turned space. ``tables``
rotations give as many tables; every vector is filed in each. A query looks into the ``probes`` nearest
signed axes of each table (both numbers follow from the dimension, see ``looks``), and everything found there is compared by exact Euclidean distance.

Equal rows (id and vector) are collapsed first. A bucket is worked off in blocks of at most about ``BLOCK`` vectors
against ``QUERY_BLOCK`` queries, by hashes of ids and vectors; how many blocks it has follows from counts per bucket, a table of ``tables`` * 2 * padded dimension rows per
dimension. Nothing is capped: each block returns its own nearest ids, and these are merged per query. Queries that
found fewer than ``k`` (small tables, empty buckets) are compared with all vectors in the same kind of
blocks.

Recall of the true ten nearest, measured in a numpy model with these rotations, 20,000 vectors and 100 queries: on
uniform unit vectors 0.996 at 64 dimensions, 0.983 at 128, 0.985 at 256 and 0.984 at 768; 1.000 at all four on
vectors around 200 centres. That takes looking at 60, 62, 77 and 88 percent of the uniform vectors; a query
is sent to 16, 32, 64 and 341 buckets in each of 8, 8, 12 and 12 tables.

Edge cases: vectors that are NULL, empty, zero, or hold NULL or non-finite components take no part, nor do
rows with a NULL id; vectors of different length are never compared; rows with the query's own id are no
candidates for it; an id that occurs more than once is listed once, with its nearest vector; ties go to the
smaller id; fewer than k candidates give fewer rows; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.session import stored

TABLES = 8
PROBES = 16  # at least
BLOCK = 4096
QUERY_BLOCK = 1024


def hadamard(v: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row, scaled to keep lengths."""
    n, h = v.shape[1], 1
    while h < n:
        v = v.reshape(len(v), n // (2 * h), 2, h)
        v = np.stack([v[:, :, 0] + v[:, :, 1], v[:, :, 0] - v[:, :, 1]], 2).reshape(len(v), n)
        h *= 2
    return v / np.sqrt(n)


def rotated(unit: np.ndarray, table: int) -> np.ndarray:
    size = 1 << max(1, unit.shape[1] - 1).bit_length()
    v = np.zeros((len(unit), size))
    v[:, : unit.shape[1]] = unit
    signs = np.random.default_rng([7, table, size]).choice([-1.0, 1.0], (3, size))
    for s in signs:
        v = hadamard(v * s)
    return v


def looks(size: int) -> tuple[int, int]:
    """(tables, probes) for vectors padded to ``size``: a share of the signed axes, as neighbours spread over more of them."""
    return (TABLES if size <= 128 else 12), max(PROBES, 2 * size // (8 if size <= 256 else 6))


def _vectors(column: pa.Array, ids: pa.Array):
    """By dimension: rows that take part, and their vectors."""
    lists = column.cast(pa.large_list(pa.float64()))
    length = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    for size in np.unique(length[length > 0]):
        row = np.flatnonzero((length == size) & known)
        if len(row):
            flat = lists.take(pa.array(row)).flatten().to_numpy(zero_copy_only=False)
            v = flat.reshape(len(row), size).astype(np.float64)
            ok = np.isfinite(v).all(1) & (v != 0).any(1)
            yield int(size), row[ok], v[ok]


def _filed(vectors: DataFrame, tables: int | None, probes: int | None, with_vector: bool) -> DataFrame:
    """A row for each table a vector is filed in (probe false) and each bucket a query looks into (true)."""
    schema = "dim int, tab int, axis int, probe boolean, vec_id long" + (", v binary" if with_vector else "")

    def rows(ids, v, dim, tab, axis, probe):
        columns = [np.full(len(ids), dim, np.int32), np.full(len(ids), tab, np.int32), axis.astype(np.int32), np.full(len(ids), probe), ids]
        names = ["dim", "tab", "axis", "probe", "vec_id"]
        if with_vector:
            columns.append(pa.array([x.tobytes() for x in v], pa.binary()))
            names.append("v")
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    def run(batches):
        for batch in batches:
            asks = batch.column("q").fill_null(False).to_numpy(zero_copy_only=False)
            for dim, row, v in _vectors(batch.column("embedding"), batch.column("vec_id")):
                ids = batch.column("vec_id").take(pa.array(row)).to_numpy()
                ask = asks[row]
                scale = np.abs(v).max(1, keepdims=True)  # keeps squares of very large or small numbers finite
                unit = v / scale
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                usual = looks(1 << max(1, dim - 1).bit_length())
                for tab in range(tables or usual[0]):
                    turned = rotated(unit, tab)
                    axis = np.abs(turned).argmax(1)
                    yield rows(ids, v, dim, tab, axis * 2 + (turned[np.arange(len(v)), axis] < 0), False)
                    if ask.any():
                        both = np.concatenate([turned[ask], -turned[ask]], 1)
                        near = np.argsort(-both, axis=1, kind="stable")[:, : probes or usual[1]]
                        half = turned.shape[1]
                        code = (near % half) * 2 + near // half
                        times = code.shape[1]
                        some = max(1, (1 << 25) // (times * dim * 8))  # copies of vectors that are held at once
                        for lo in range(0, len(code), some):
                            part = slice(lo, lo + some)
                            yield rows(np.repeat(ids[ask][part], times), np.repeat(v[ask][part], times, 0), dim, tab, code[part].ravel(), True)

    return vectors.mapInArrow(run, schema)


def _ranked(filed: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """The k nearest ids of each query within each pair of blocks that it takes part in."""
    blocks = counts.groupBy("dim", "tab", "axis").agg(
        F.ceil(F.sum(F.when(~F.col("probe"), F.col("count")).otherwise(0)) / BLOCK).cast("int").alias("vs"),
        F.ceil(F.sum(F.when(F.col("probe"), F.col("count")).otherwise(0)) / QUERY_BLOCK).cast("int").alias("qs"),
    )
    # As many rows as there are buckets: tables * 2 * dimension for each dimension.
    sized = filed.join(F.broadcast(blocks.filter("vs > 0 AND qs > 0")), ["dim", "tab", "axis"])
    own = F.pmod(F.xxhash64("vec_id", "v"), F.when(F.col("probe"), F.col("qs")).otherwise(F.col("vs"))).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.when(F.col("probe"), F.col("vs")).otherwise(F.col("qs")) - 1))
    dealt = sized.withColumn("own", own).withColumn("other", others)
    dealt = dealt.withColumn("vb", F.when(F.col("probe"), F.col("other")).otherwise(F.col("own"))).withColumn(
        "qb", F.when(F.col("probe"), F.col("own")).otherwise(F.col("other"))
    )

    def nearest(t: pa.Table) -> pa.Table:
        probe = t.column("probe").to_numpy()
        ids = t.column("vec_id").to_numpy()
        v = np.frombuffer(b"".join(t.column("v").to_pylist()), np.float64).reshape(len(ids), -1)
        order = np.argsort(ids[~probe], kind="stable")
        base = v[~probe][order]
        # An id's rows lie side by side and count as one, with the smallest distance.
        names, first = np.unique(ids[~probe][order], return_index=True)
        out = [], [], []
        for q, query in zip(ids[probe], v[probe], strict=True):
            gap = base - query
            with np.errstate(over="ignore"):
                far = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            if len(names) < len(far):
                far = np.minimum.reduceat(far, first)
            far[names == q] = np.nan
            n = int((names != q).sum())
            if not n:
                continue
            if n > k:
                edge = np.partition(far, k - 1)[k - 1]  # NaN sorts last
                pick = np.flatnonzero(far <= edge)
            else:
                pick = np.flatnonzero(names != q)
            pick = pick[np.lexsort((names[pick], far[pick]))][:k]
            out[0].append(np.full(len(pick), q))
            out[1].append(names[pick])
            out[2].append(far[pick])
        made = [np.concatenate(x) if x else np.zeros(0, d) for x, d in zip(out, (np.int64, np.int64, np.float64), strict=True)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), made, strict=True)))

    return dealt.select("dim", "tab", "axis", "vb", "qb", "probe", "vec_id", "v").groupBy("dim", "tab", "axis", "vb", "qb").applyInArrow(nearest, "query_id long, vec_id long, score double")


def _top(pairs: DataFrame, k: int) -> DataFrame:
    best = pairs.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = 10, tables: int | None = None, probes: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: of every query its k nearest found. ``vectors`` has (vec_id, embedding)."""
    # Equal rows are one, however many there are.
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("q"))
    vectors = stored(rows.groupBy("vec_id", "embedding").agg(F.max("q").alias("q")), "vectors")
    counts = stored(_filed(vectors, tables, probes, False).groupBy("dim", "tab", "axis", "probe").count(), "buckets")
    found = stored(_top(_ranked(_filed(vectors, tables, probes, True), counts, k), k), "nearest")
    done = found.groupBy("query_id").count().filter(F.col("count") >= k).select("query_id")
    # One table, one bucket, for queries that are not served yet.
    everything = _filed(vectors, 1, 1, True).withColumn("axis", F.lit(0))
    asking = everything.filter("probe").join(done, F.col("vec_id") == F.col("query_id"), "left_anti")
    if asking.isEmpty():
        return found.select("query_id", "rank", "vec_id", "score")
    rest = everything.filter("NOT probe").unionByName(asking)
    exact = _ranked(rest, rest.groupBy("dim", "tab", "axis", "probe").count(), k)
    served = found.join(done, "query_id", "left_semi").select("query_id", "rank", "vec_id", "score")
    return served.unionByName(_top(exact, k).select("query_id", "rank", "vec_id", "score"))
