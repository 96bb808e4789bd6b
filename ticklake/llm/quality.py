"""Quality classifier: logistic regression on hashed word n-grams (operator 1).

Texts become sparse vectors: n-grams of words are hashed to ``2**bits`` places, a place's value is the root
of its count, and the vector is scaled to one length (``scale``). The model is trained with follow-the-regularised-
leader updates (per-coordinate step sizes, L1 and L2), one pass after another over ``shards`` parts of
the training rows side by side; the parts' weights are averaged, and further rounds start from the average.
A score is a sparse dot product put through the logistic function.

Bounds: at most ``max_rows`` labelled rows are learnt from, those with the smallest hash of their id (ids and
labels only are chosen, so no text passes the driver); the model has at most ``2**bits`` weights, which
is what is collected and sent to the tasks.

Edge cases: NULL or empty text has only the constant feature and gets the score of it; rows with a NULL id
or label are not learnt from; repeated rows are scored each; without training rows every score is 0.5; an
empty table gives an empty result; columns other than id and text are never read for a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm import words


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    ngrams: int = 2
    max_rows: int = 20_000
    shards: int = 8
    rounds: int = 2
    epochs: int = 4
    scale: float = 4.0
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 1e-3
    l2: float = 1e-3


def vectors(column: pa.Array, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of texts: where each begins, places, values. Place 0 is the constant 1."""
    w = words.split(column)
    rows = len(column)
    doc = w.doc()
    keys = [np.arange(rows, dtype=np.uint64) << np.uint64(settings.bits)]
    for n in range(1, settings.ngrams + 1):
        h = words.rolling(w.hashes, n)
        inside = words.within(w.first, n, len(h))
        place = h[inside] >> np.uint64(64 - settings.bits)
        place[place == 0] = 1
        keys.append((doc[: len(h)][inside].astype(np.uint64) << np.uint64(settings.bits)) | place)
    sparse, counts = np.unique(np.concatenate(keys), return_counts=True)
    row = (sparse >> np.uint64(settings.bits)).astype(np.int64)
    place = (sparse & np.uint64((1 << settings.bits) - 1)).astype(np.int64)
    begin = np.searchsorted(row, np.arange(rows + 1))
    square = np.where(place == 0, 0, counts)
    length = np.sqrt(np.maximum(1, np.add.reduceat(square, begin[:-1]) if rows else square))
    value = np.where(place == 0, 1.0, settings.scale * np.sqrt(counts) / length[row])
    return begin, place, value


class Learner:
    """Follow-the-regularised-leader state: ``z`` and ``n`` by place."""

    def __init__(self, settings: Settings, weights: np.ndarray | None = None):
        self.s = settings
        self.n = np.zeros(1 << settings.bits)
        self.z = np.zeros(1 << settings.bits)
        if weights is not None:  # the state whose weights these are
            self.z = -weights * (settings.beta / settings.alpha + settings.l2) - np.sign(weights) * settings.l1

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        scale = (self.s.beta + np.sqrt(self.n[at])) / self.s.alpha + self.s.l2
        return np.where(np.abs(z) <= self.s.l1, 0.0, (np.sign(z) * self.s.l1 - z) / scale)

    def update(self, place: np.ndarray, value: np.ndarray, label: float) -> None:
        w = self.weights(place)
        g = (sigmoid(w @ value) - label) * value
        n = self.n[place]
        self.z[place] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.s.alpha * w
        self.n[place] = n + g * g


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """Weights by place, learnt from ``labels`` with (doc_id, label) and the texts of ``docs``."""
    chosen = (
        labels.select(F.col("doc_id").alias("_id"), F.col("label").cast("double").alias("label"))
        .filter("_id IS NOT NULL AND label IS NOT NULL")
        .orderBy(F.xxhash64("_id"), "_id", "label")
        .limit(settings.max_rows)
    )
    # At most max_rows pairs of numbers.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
        .select("text", "label", F.pmod(F.xxhash64("doc_id"), F.lit(settings.shards)).alias("shard"), F.xxhash64("text", "doc_id").alias("turn"))
        .repartition(settings.shards, "shard")
        .sortWithinPartitions("shard", "turn")
    )
    weights = np.zeros(1 << settings.bits)
    for _ in range(settings.rounds):
        made = rows.mapInArrow(_shards(settings, weights.astype(np.float32)), "place int, weight double")
        # Partial sums first; the result has a row for each place at most.
        average = made.groupBy("place").agg((F.sum("weight") / settings.shards).alias("weight")).toPandas()
        weights = np.zeros(1 << settings.bits)
        weights[average["place"].to_numpy(np.int64)] = average["weight"].to_numpy(np.float64)
    return weights


def _shards(settings: Settings, start: np.ndarray):
    def run(batches):
        pieces, shard = [], None
        for batch in batches:
            for piece in words.slices(batch):
                for value in piece.column("shard").unique().to_pylist():
                    if shard is not None and value != shard:
                        yield _learn(pieces, settings, start)
                        pieces = []
                    shard = value
                    own = piece.filter(pa.compute.equal(piece.column("shard"), value))
                    pieces.append((*vectors(own.column("text"), settings), own.column("label").to_numpy()))
        if pieces:
            yield _learn(pieces, settings, start)

    return run


def _learn(pieces, settings: Settings, start: np.ndarray) -> pa.RecordBatch:
    """One shard's weights after all epochs; its rows are at most max_rows in number."""
    learner = Learner(settings, start.astype(np.float64))
    for _ in range(settings.epochs):
        for begin, place, value, label in pieces:
            for i, y in enumerate(label):
                at = slice(begin[i], begin[i + 1])
                learner.update(place[at], value[at], y)
    found = learner.weights(slice(None))
    place = np.flatnonzero(found)
    return pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(found[place])], ["place", "weight"])


def score(docs: DataFrame, weights: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with a last column ``score``; all other columns as they are."""
    small = weights.astype(np.float32)
    schema = docs.drop("score").schema.add("score", "double", False)

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        begin, place, value = vectors(piece.column("text"), settings)
        made = sigmoid(np.add.reduceat(small[place] * value, begin[:-1]))
        return pa.RecordBatch.from_arrays([*piece.columns, pa.array(made, pa.float64())], [*piece.schema.names, "score"])

    return words.by_slice(docs.drop("score"), work, schema)
