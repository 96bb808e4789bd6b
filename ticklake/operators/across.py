"""One view of a symbol across venues: at each instant the last quote of every venue, and the best of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.functions.times import DAY_MS, bucket_ms

SERIES = ["symbol", "exchange_id"]


def as_of(quotes: DataFrame, block_ms: int = DAY_MS) -> DataFrame:
    """(symbol, extraction_timestamp, exchange_id, quoted_at, bid, ask): each venue's last quote at each instant of a symbol.

    ``quotes`` has one row per (exchange_id, symbol, extraction_timestamp). Instants are those at which any venue quoted the
    symbol; a venue has no row before its first quote. No range join: rows are laid on a grid of a symbol's instants and
    venues, and the last quote is carried along in two steps. Between blocks of ``block_ms`` only each block's last quote
    moves on; inside a block a running window fills the gaps. So the symbol with most ticks is sorted in
    as many parts as it has venues and blocks. Rows without a symbol, venue or instant are left out.
    """
    known = quotes.select("symbol", "extraction_timestamp", "exchange_id", "bid", "ask").dropna(subset=["symbol", "extraction_timestamp", "exchange_id"])
    quote = F.struct(F.col("extraction_timestamp").alias("quoted_at"), "bid", "ask").alias("quote")
    # A list per symbol, as long as there are venues.
    venues = known.groupBy("symbol").agg(F.collect_set("exchange_id").alias("venues"))
    instants = known.select("symbol", "extraction_timestamp").distinct()
    grid = instants.join(venues, "symbol").select("symbol", "extraction_timestamp", F.explode("venues").alias("exchange_id"))
    laid = grid.join(known.select(*SERIES, "extraction_timestamp", quote), [*SERIES, "extraction_timestamp"], "left")
    laid = laid.withColumn("block", bucket_ms(F.col("extraction_timestamp"), block_ms))
    last = laid.groupBy(*SERIES, "block").agg(F.max("quote").alias("last"))  # the latest, as its instant comes first
    before = Window.partitionBy(*SERIES).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    seeds = last.select(*SERIES, "block", F.last("last", ignorenulls=True).over(before).alias("seed"))
    inside = Window.partitionBy(*SERIES, "block").orderBy("extraction_timestamp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = laid.withColumn("quote", F.last("quote", ignorenulls=True).over(inside)).join(seeds, [*SERIES, "block"], "left")
    filled = carried.withColumn("quote", F.coalesce("quote", "seed")).filter("quote IS NOT NULL")
    return filled.select("symbol", "extraction_timestamp", "exchange_id", "quote.*")


def best(quotes: DataFrame, block_ms: int = DAY_MS) -> DataFrame:
    """(symbol, extraction_timestamp, best_bid, bid_venue, best_ask, ask_venue, venues): the best of all venues' last quotes.

    Of venues that offer the same the first by name counts; NULL prices offer nothing.
    """
    offered = as_of(quotes, block_ms)
    # The least by (price, name); bids by their negated price.
    venue = F.col("exchange_id").alias("venue")
    bid = F.min(F.when(F.col("bid").isNotNull(), F.struct((-F.col("bid")).alias("price"), venue)))
    ask = F.min(F.when(F.col("ask").isNotNull(), F.struct(F.col("ask").alias("price"), venue)))
    grouped = offered.groupBy("symbol", "extraction_timestamp").agg(
        F.max("bid").alias("best_bid"), bid.alias("b"), ask.alias("a"), F.count(F.lit(1)).alias("venues")
    )
    return grouped.select(
        "symbol", "extraction_timestamp", "best_bid", F.col("b.venue").alias("bid_venue"), F.col("a.price").alias("best_ask"), F.col("a.venue").alias("ask_venue"), "venues"
    )
