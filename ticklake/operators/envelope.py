"""Ticks of one venue at one instant -> nested snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.operators.reduce import latest_by

SNAPSHOT_KEY = ["exchange_id", "extraction_timestamp"]

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def latest_ticks(ticks: DataFrame) -> DataFrame:
    """One tick per (venue, snapshot, symbol); of several the later arrival (``tick_id``) wins."""
    return latest_by(ticks, [*SNAPSHOT_KEY, "symbol"], ["tick_id"])


def iso_text(instant: Column) -> Column:
    return F.date_format(instant, ISO_FORMAT)


def raw_ticker() -> Column:
    """A tick in the field names the venues use."""
    return F.struct(
        "symbol",
        F.col("ticker_timestamp_ms").alias("timestamp"),
        iso_text(F.col("ticker_time")).alias("datetime"),
        "last",
        "bid",
        "ask",
        "high",
        "low",
        "volume",
        F.col("base_volume").alias("baseVolume"),
        F.col("quote_volume").alias("quoteVolume"),
    )


def envelopes(ticks: DataFrame, parts: int = 1) -> DataFrame:
    """Nested snapshots ``(metadata, data)``.

    The per-symbol reduction comes first: it keeps map keys unique and shrinks what is shuffled to
    the snapshot. A map is collected in one task, so it has to stay small: venues with more symbols than
    fit a row (some ten thousands) are written with ``parts`` rows per snapshot, which share its metadata and
    split its symbols by hash. Readers flatten rows, so they do not see the split; who counts snapshots
    counts distinct metadata.
    """
    entry = F.struct("symbol", raw_ticker().alias("ticker"))
    return (
        latest_ticks(ticks)
        .select(*SNAPSHOT_KEY, F.pmod(F.xxhash64("symbol"), F.lit(parts)).alias("part"), entry.alias("entry"))
        .groupBy(*SNAPSHOT_KEY, "part")
        .agg(F.map_from_entries(F.collect_list("entry")).alias("data"))
        .select(
            F.struct(F.col("extraction_timestamp").alias("timestamp"), "exchange_id").alias("metadata"),
            "data",
        )
    )


def sample_symbols(snapshots: DataFrame, n: int = 5) -> DataFrame:
    """Per snapshot: how many symbols, and the first ``n`` names in order.

    Rows of a split snapshot are reduced to their own first names before they meet.
    """
    names = F.array_sort(F.map_keys("data"))
    per_row = snapshots.select(
        F.col("metadata.exchange_id").alias("exchange_id"),
        F.col("metadata.timestamp").cast("bigint").alias("extraction_timestamp"),
        F.size("data").cast("bigint").alias("symbols"),
        F.slice(names, 1, n).alias("names"),
    )
    return per_row.groupBy(*SNAPSHOT_KEY).agg(
        F.sum("symbols").alias("record_count"),
        F.slice(F.array_sort(F.flatten(F.collect_list("names"))), 1, n).alias("sample"),
    )


def to_json_text(snapshots: DataFrame) -> DataFrame:
    """Snapshots as JSON lines; NULL fields are left out."""
    return snapshots.select(F.to_json(F.struct("metadata", "data")).alias("value"))
