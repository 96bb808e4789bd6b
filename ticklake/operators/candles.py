"""Stored candles that loads add to: mergeable partial candles, and candles merged from them.

A partial keeps the ranks of its open and close beside the prices, so partials of one candle can be merged in any order:
the open is that of the least rank, the close that of the greatest, highs, lows, volumes and counts combine as they are. Each
load's partials are kept under its id and replaced when it runs again; then only the days it touches, of its venues, are
merged anew. Volumes are added up as they are given: whole numbers exactly, others up to rounding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.contracts import OHLCV
from ticklake.functions.times import bucket_ms, utc_date
from ticklake.operators.bars import ORDER, chronological
from ticklake.operators.flatten import conform
from ticklake.session import drop, existing, folders

KEY = ["exchange", "symbol", "timestamp"]


def partials(ticks: DataFrame, width_ms: int, order: Sequence[str] = ORDER) -> DataFrame:
    """Candles of these ticks with the ranks of open and close and the number of ticks."""
    ranked = ticks.withColumn("timestamp", bucket_ms(F.col("ticker_timestamp_ms"), width_ms)).withColumn("rank", chronological(order))
    return ranked.groupBy(F.col("exchange_id").alias("exchange"), "symbol", "timestamp").agg(
        F.min_by("last", "rank").alias("open"),
        F.min("rank").alias("first_rank"),
        F.max("last").alias("high"),
        F.min("last").alias("low"),
        F.max_by("last", "rank").alias("close"),
        F.max("rank").alias("last_rank"),
        F.sum("base_volume").alias("volume"),
        F.count(F.lit(1)).alias("ticks"),
    )


def merge(parts: DataFrame, *by: str) -> DataFrame:
    """Partials of the same candle as one, whatever their order and grouping before."""
    return parts.groupBy(*KEY, *by).agg(
        F.min_by("open", "first_rank").alias("open"),
        F.min("first_rank").alias("first_rank"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "last_rank").alias("close"),
        F.max("last_rank").alias("last_rank"),
        F.sum("volume").alias("volume"),
        F.sum("ticks").alias("ticks"),
    )


class CandleStore:
    """Candles of one width below ``path``, by venue and day of the candle's begin, and each load's partials."""

    DAY = ("exchange", "date")

    def __init__(self, spark: SparkSession, path: str, width_ms: int, order: Sequence[str] = ORDER):
        self.spark = spark
        self.partials_root = f"{path.rstrip('/')}/partials"
        self.candles_root = f"{path.rstrip('/')}/candles"
        self.width_ms = width_ms
        self.order = tuple(order)

    def _write(self, rows: DataFrame, root: str, layout: Sequence[str]) -> None:
        columns = [F.col(c) for c in layout]
        placed = rows.hint("rebalance", *columns).sortWithinPartitions(*columns, "symbol", "timestamp")
        placed.write.partitionBy(*layout).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)

    def _days(self, load_id: str) -> set[str]:
        """``exchange=…/date=…`` of the days a load has partials of."""
        names = folders(self.spark, f"{self.partials_root}/exchange=*/date=*/load_id={load_id}")
        return {"/".join(n.split("/")[-3:-1]) for n in names}

    def add(self, ticks: DataFrame, load_id: str) -> list[str]:
        """Take in a load's ticks, in place of what it brought before; the days whose candles were written anew."""
        before = self._days(load_id)
        for day in before:
            drop(self.spark, f"{self.partials_root}/{day}/load_id={load_id}")
        made = partials(ticks, self.width_ms, self.order).withColumn("date", utc_date(F.col("timestamp")))
        self._write(made.withColumn("load_id", F.lit(load_id)), self.partials_root, (*self.DAY, "load_id"))
        return self.refresh(before | self._days(load_id))

    def refresh(self, days: set[str]) -> list[str]:
        """Merge the candles of these days anew from all partials; a day without any left goes."""
        there, gone = existing(self.spark, [f"{self.partials_root}/{d}/load_id=*" for d in sorted(days)])
        for name in gone:
            drop(self.spark, f"{self.candles_root}/{'/'.join(name.split('/')[-3:-1])}")
        if there:
            rank = partials(self._none(), self.width_ms, self.order).schema
            schema = T.StructType([*rank.fields, T.StructField("date", T.DateType()), T.StructField("load_id", T.StringType())])
            parts = self.spark.read.schema(schema).option("basePath", self.partials_root).parquet(*[n.rsplit("/", 1)[0] for n in there])
            self._write(merge(parts, "date"), self.candles_root, self.DAY)
        return sorted(days)

    def _none(self) -> DataFrame:
        numbers = ", ".join(f"`{c}` long" for c in dict.fromkeys(("ticker_timestamp_ms", *self.order)))
        return self.spark.createDataFrame([], f"exchange_id string, symbol string, last double, base_volume double, {numbers}")

    def read(self) -> DataFrame:
        """All candles, by contract."""
        if not existing(self.spark, [self.candles_root])[0]:
            return self.spark.createDataFrame([], OHLCV.struct)
        stored = T.StructType([*OHLCV.struct.fields, T.StructField("date", T.DateType())])
        return conform(self.spark.read.schema(stored).parquet(self.candles_root), OHLCV.struct)
