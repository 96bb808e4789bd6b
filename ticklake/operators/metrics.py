"""Summaries of a load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def columns_text(df: DataFrame) -> str:
    return ", ".join(df.columns)


def batch_summary(df: DataFrame) -> DataFrame:
    """One row: rows, columns, and the column names as text."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.concat_ws(", ", *[F.lit(c) for c in df.columns]).alias("columns"),
    )


def observed(df: DataFrame, name: str = "batch") -> tuple[DataFrame, Observation]:
    """The frame, and its row counts as a by-product of whatever action runs on it."""
    seen = Observation(name)
    measured = df.observe(
        seen,
        F.count(F.lit(1)).alias("row_count"),
        F.count("ticker_timestamp_ms").alias("with_ticker_timestamp"),
        F.max("extraction_timestamp").alias("newest_ms"),
    )
    return measured, seen


def load_summary(rows: DataFrame, source: str = "source_path") -> DataFrame:
    """Files and records of a load. Files are made distinct in a step of their own, on the path."""
    per_file = rows.groupBy(source).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.count(source).alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("records")
    )


def latest_metadata(entries: DataFrame, order: Column | None = None) -> DataFrame:
    """Metadata of the newest snapshot of each venue; a missing instant counts as 0.

    ``order`` replaces the instant, for example by the file name; the instant then settles ties.
    """
    return latest_entries(entries, _entry=order).select("exchange_id", "_entry.*")


def latest_entries(entries: DataFrame, **orders: Column | None) -> DataFrame:
    """``latest_metadata`` by several orders in one aggregate: a struct of metadata for each, under its name."""
    instant = F.coalesce("extraction_timestamp", F.lit(0))
    entry = F.struct(*[c for c in entries.columns if c != "exchange_id"])
    ranks = {
        name: F.struct(instant, "run_timestamp", "run_id") if order is None else F.struct(order, instant)
        for name, order in orders.items()
    }
    return entries.groupBy("exchange_id").agg(*[F.max_by(entry, rank).alias(name) for name, rank in ranks.items()])


def sample_head(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by a total order."""
    return df.orderBy(*order).limit(n)
