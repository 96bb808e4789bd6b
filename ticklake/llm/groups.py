"""Bounded groups streamed from sorted partitions, and connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.session import stored


def by_group(rows: DataFrame, key: str, work, schema: str) -> DataFrame:
    """``work`` on each group of neighbours with one key, streamed from sorted partitions.

    ``work`` gets a table of whole groups, sorted by key and ``id``, and the row each group begins at; it yields batches.
    """

    def run(batches):
        rest = None
        for batch in batches:
            whole = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
            keys = whole.column(key).to_numpy()
            cuts = np.flatnonzero(np.diff(keys)) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            if last:
                yield from work(whole.slice(0, last), np.concatenate([[0], cuts[:-1]]))
            rest = whole.slice(last)
        if rest is not None and rest.num_rows:
            yield from work(rest, np.array([0]))

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, key).sortWithinPartitions(key, "id").mapInArrow(run, schema)


def joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place that each of n places is connected with by pairs (a, b)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each end of a link reaches. ``links`` has (a, b), a < b."""
    edges = links.select("a", "b").distinct()
    mark = None
    while True:
        # Large star: what is larger than a node goes to the smallest of its neighbours and itself.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        edges = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        # Small star: what is smaller than a node, and the node, go to the smallest of them.
        down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        kept = least.select(F.col("m").alias("a"), F.col("u").alias("b"))
        edges = stored(moved.unionByName(kept).filter("a < b").distinct(), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == mark:
            return edges.select(F.col("b").alias("id"), F.col("a").alias("component"))
        mark = now
