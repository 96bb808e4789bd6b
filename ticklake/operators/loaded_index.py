"""Which instants of each venue a table holds: bitmaps, written by each load and merged by OR.

An instant is one bit. Whole seconds have a bit for each second, other instants one for each millisecond; 32,768 bits
next to each other are one row of 4 KB, by venue and day. So the index answers exactly, and a
question about all history reads a few rows per venue and day instead of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.times import utc_date
from ticklake.operators.backlog import KEY, stamped
from ticklake.session import existing

GRAIN_MS = 1000
PLACE = ["exchange_id", "date", "grain", "bucket"]
SCHEMA = "exchange_id string, date date, grain int, bucket long, bits binary, load_id string"


def _placed(pairs: DataFrame) -> DataFrame:
    """Pairs with the row of the index their bit lies in, and the bit's position there."""
    instant = F.col("extraction_timestamp")
    grain = F.when(instant % GRAIN_MS == 0, F.lit(GRAIN_MS)).otherwise(F.lit(1))
    slot = F.expr("extraction_timestamp div grain")
    timed = pairs.withColumn("date", utc_date(instant)).withColumn("grain", grain)
    return timed.withColumn("bucket", F.bitmap_bucket_number(slot)).withColumn("position", F.bitmap_bit_position(slot))


def bitmaps(pairs: DataFrame, *by: str) -> DataFrame:
    """Index rows of (exchange_id, extraction_timestamp) pairs, repeated ones included; NULLs have no bit."""
    known = _placed(stamped(pairs).filter(F.col("exchange_id").isNotNull()))
    return known.groupBy(*PLACE, *by).agg(F.bitmap_construct_agg("position").alias("bits"))


def merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*PLACE).agg(F.bitmap_or_agg("bits").alias("bits"))


def has_bit(bits: Column, position: Column) -> Column:
    """Whether a bit is set; a NULL bitmap has none."""
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))


def backlog_indexed(manifest: DataFrame, index: DataFrame) -> DataFrame:
    """Everything whose instant is not loaded, by the (merged) index alone.

    The same rows as ``backlog_full``: a snapshot without a venue matches nothing and stays, one without an instant is left out.
    """
    asked = _placed(stamped(manifest))
    found = asked.join(index.select(*PLACE, "bits"), PLACE, "left")
    return found.filter(~has_bit(F.col("bits"), F.col("position"))).select(*manifest.columns)


class LoadedIndex:
    """Index rows below ``path``, a folder per load, which a repeated load replaces."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _write(self, rows: DataFrame) -> None:
        writer = rows.write.partitionBy("load_id").mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.parquet(self.path)

    def add(self, pairs: DataFrame, load_id: str) -> None:
        """Note what a load holds, in place of what was noted of it before."""
        self._write(bitmaps(pairs.select(*KEY)).coalesce(1).withColumn("load_id", F.lit(load_id)))

    def rebuild(self, rows: DataFrame) -> None:
        """Note everything anew from a table's rows, which name their load."""
        self._write(bitmaps(rows.select(*KEY, "load_id"), "load_id").hint("rebalance", F.col("load_id")))

    def exists(self) -> bool:
        return bool(existing(self.spark, [self.path])[0])

    def read(self) -> DataFrame:
        """All loads together."""
        rows = self.spark.read.schema(SCHEMA).parquet(self.path) if self.exists() else self.spark.createDataFrame([], SCHEMA)
        return merged(rows)
