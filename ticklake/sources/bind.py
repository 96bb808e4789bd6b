"""The test tables read as the ticker domain.

``events`` are ticks: the event type is the venue, users share twenty symbols, each hour is one
snapshot. Prices follow from ``value`` by fixed arithmetic, with NULLs, so that null handling and
quality rules have something to do. ``customer`` gives one pipeline configuration per customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.times import DAY_MS, HOUR_MS, bucket_ms
from ticklake.operators.configs import with_defaults
from ticklake.operators.envelope import iso_text

OUTAGE_HOURS = (3, 19, 20)  # hours of the day in which the loader did not run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_every(k: int, value: Column) -> Column:
    return F.when(F.col("event_id") % k != 0, value)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks in arrival order ``tick_id``."""
    value = F.col("value")
    volume = (F.col("event_id") % 1000).cast("double")
    instant = F.col("ts").cast("timestamp")
    ms = F.unix_millis(instant)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("tick_id"),
        F.col("event_type").alias("exchange_id"),
        F.concat(F.lit("U"), (F.col("user_id") % 20).cast("string")).alias("symbol"),
        ms.alias("ticker_timestamp_ms"),
        _null_every(11, instant).alias("ticker_time"),
        value.alias("last"),
        _null_every(7, value * 0.99).alias("bid"),
        _null_every(13, value * 1.01).alias("ask"),
        (value + 1.0).alias("high"),
        (value - 1.0).alias("low"),
        _null_every(5, value * 2.0).alias("volume"),
        _null_every(17, volume).alias("base_volume"),
        _null_every(17, volume * value).alias("quote_volume"),
        bucket_ms(ms, HOUR_MS).alias("extraction_timestamp"),
    )


def records(ticks: DataFrame) -> DataFrame:
    """Ticks as flat rows in the venues' field names."""
    return ticks.select(
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
        "exchange_id",
        "extraction_timestamp",
    )


def is_loaded(ticks: DataFrame) -> Column:
    """Loaded so far: all but the outage hours and the newest day."""
    hour = F.pmod(F.col("extraction_timestamp"), F.lit(DAY_MS)) / HOUR_MS
    newest = ticks.agg(F.max("extraction_timestamp")).scalar()
    return ~hour.isin(*OUTAGE_HOURS) & (F.col("extraction_timestamp") < newest - DAY_MS)


def manifest(ticks: DataFrame) -> DataFrame:
    """One row per snapshot, with the flag the loader would have left."""
    snapshots = ticks.select("exchange_id", "extraction_timestamp").distinct()
    return snapshots.select(
        F.concat(
            F.col("exchange_id"), F.lit("/raw/tickers_"), F.col("extraction_timestamp"), F.lit(".json")
        ).alias("snapshot_path"),
        F.lit("raw_tickers").alias("dataset"),
        "exchange_id",
        "extraction_timestamp",
        F.concat(F.lit("run-"), F.col("extraction_timestamp")).alias("run_id"),
        (F.col("extraction_timestamp") + 1500).alias("run_timestamp"),
        is_loaded(ticks).alias("loaded"),
    )


def configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pipeline configuration per customer; region and segment become tags."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    placed = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    venue = venue_of(F.col("c_custkey"))
    balance = F.col("c_acctbal")
    sloppy = F.col("c_mktsegment") == "MACHINERY"
    return with_defaults(
        placed.select(
            venue.alias("exchange_id"),
            (balance >= 0).alias("enabled"),
            F.when(sloppy, F.col("c_name")).otherwise(F.concat(venue, F.lit("_raw_tickers"))).alias(
                "extract_asset_name"
            ),
            F.concat(venue, F.lit("_transformed_tickers")).alias("transform_asset_name"),
            F.when(balance < 0, "").otherwise("raw_data").alias("extract_group_name"),
            (balance > 5000).alias("schedule_enabled"),
            F.floor(balance / 100).cast("int").alias("priority"),
            F.create_map(
                F.lit("region"),
                F.lower("r_name"),
                F.lit("tier"),
                F.lower("c_mktsegment"),
            ).alias("tags"),
        )
    )


def venue_of(custkey: Column) -> Column:
    return F.concat(F.lit("venue_"), custkey.cast("string"))


def venue_configs(ticks: DataFrame) -> DataFrame:
    """One configuration per venue that has ticks: all symbols, listed ones, or switched off."""
    venue = F.col("exchange_id")
    listed = F.array(*[F.lit(s) for s in ("U1", "U3", "U5", "U7")])
    return with_defaults(
        ticks.select("exchange_id")
        .distinct()
        .select(
            "exchange_id",
            (venue != "error").alias("enabled"),
            (venue == "click").alias("fetch_all_tickers"),
            F.when(venue != "view", listed).alias("symbols"),
        )
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a tick table: groups of parts are symbols, return flags are venues.

    Line numbers repeat within an order, so the price in cents completes the arrival order.
    """
    cents = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        cents.alias("cents"),
        F.col("l_returnflag").alias("exchange_id"),
        F.concat(F.lit("P"), F.pmod("l_partkey", F.lit(25)).cast("string")).alias("symbol"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ticker_timestamp_ms"),
        (cents / 100.0).alias("last"),
        F.col("l_quantity").alias("base_volume"),
    )
