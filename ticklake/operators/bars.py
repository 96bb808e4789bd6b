"""Candles from ticks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.contracts import OHLCV
from ticklake.functions.times import bucket_ms
from ticklake.operators.flatten import conform

ORDER = ("ticker_timestamp_ms", "tick_id")


def chronological(order: Sequence[str] = ORDER) -> Column:
    """One comparable value of several integer columns, NULLs first.

    Two columns fit a DECIMAL(38), which aggregates hold in place; more become a struct.
    """
    if len(order) != 2:
        return F.struct(*order)
    least = F.lit(-(2**63)).cast("decimal(20,0)")
    first, second = (F.coalesce(F.col(c).cast("decimal(20,0)"), least) for c in order)
    return (first * F.lit(10**18).cast("decimal(19,0)") * F.lit(20) + second).cast("decimal(38,0)")


def bars(ticks: DataFrame, width_ms: int, order: Sequence[str] = ORDER) -> DataFrame:
    """Open, high, low, close and volume per (venue, symbol, bucket).

    Time orders the ticks, and arrival (``tick_id``) those of one instant. Aggregates combine before the
    shuffle, so a symbol with most of the ticks costs no more than its number of buckets.
    """
    rank = chronological(order)
    keyed = ticks.withColumn("timestamp", bucket_ms(F.col("ticker_timestamp_ms"), width_ms))
    grouped = keyed.groupBy(F.col("exchange_id").alias("exchange"), "symbol", "timestamp").agg(
        F.min_by("last", rank).alias("open"),
        F.max("last").alias("high"),
        F.min("last").alias("low"),
        F.max_by("last", rank).alias("close"),
        F.sum("base_volume").alias("volume"),
    )
    return conform(grouped, OHLCV.struct)
