"""From documents to packed sequences: filter, de-duplicate, mix, pack.

Each stage is a function of (spark, docs, sf_dir) that returns rows with the columns of ``documents``; the last one
returns where each piece of each document lies. Between stages rows are written as Parquet to the shared
folder and read again, so a lost executor costs at most its part of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ticklake.llm import exact_dedup, mixing, near_dedup, packing, quality
from ticklake.llm.queries import THRESHOLD, quality_labels
from ticklake.llm.registry import query, table
from ticklake.session import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels of four fifths, doesn't reject."""
    docs = docs.select(*COLUMNS)
    model = quality.train(docs, quality_labels(spark, sf_dir))
    return quality.score(docs, model).filter(f"score >= {THRESHOLD}").drop("score")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id."""
    return exact_dedup.deduplicated(docs, keep="smallest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at a similarity of 80 percent the one with the smallest id."""
    return near_dedup.deduplicated(docs, threshold=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 1, 2, 3, repeating, no document more than three times."""
    return mixing.expanded(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences of permitted lengths."""
    return packing.packed(packing.token_lengths(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", filter_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Scores, sketches and token counts can't be said in SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


@query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline over all documents."""
    return run(spark, sf_dir)
