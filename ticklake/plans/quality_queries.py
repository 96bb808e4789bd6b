"""Queries for quality rules, candles and freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.times import DAY_MS, HOUR_MS
from ticklake.operators import across, gaps, quality, ranges
from ticklake.operators.bars import bars
from ticklake.operators.candles import CandleStore
from ticklake.plans.domain_sql import LATEST, MANIFEST, TICKER_COLUMNS, TICKS, TRADES
from ticklake.plans.registry import query
from ticklake.plans.snapshot_queries import transform_tickers
from ticklake.session import scratch_dir
from ticklake.sources import bind

# Violated rules by name, in rule order; NULL where the rule holds.
_BROKEN = {
    "symbol_present": "symbol IS NULL",
    "exchange_id_present": "exchange_id IS NULL",
    "extraction_timestamp_present": "extraction_timestamp IS NULL",
    "last_positive": "last IS NULL OR last <= 0",
    "bid_present": "bid IS NULL",
    "ask_present": "ask IS NULL",
    "low_positive": "low <= 0",
    "bid_below_ask": "bid > ask",
    "base_volume_not_negative": "base_volume < 0",
}
_VIOLATIONS = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _BROKEN.items()) + ")"


@query(
    f"WITH {LATEST} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) AS checked, count(*) FILTER ({broken}) AS violations FROM latest"
        for name, broken in _BROKEN.items()
    )
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of each rule."""
    return quality.report(transform_tickers(spark, sf_dir), quality.TICKER_RULES)


@query(
    f"""WITH {LATEST}
    SELECT {TICKER_COLUMNS}, {_VIOLATIONS} AS violations,
           CASE WHEN {_VIOLATIONS} = '' THEN 'passed' ELSE 'quarantined' END AS state FROM latest"""
)
def quality_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that pass, and the others with the reasons."""
    judged = quality.with_state(transform_tickers(spark, sf_dir), quality.TICKER_RULES)
    return judged.withColumn("violations", F.array_join("violations", ","))


BARS = """
    SELECT {bucket} AS "timestamp", first(last ORDER BY {order}) AS open, max(last) AS high,
           min(last) AS low, last(last ORDER BY {order}) AS close, sum(base_volume) AS volume,
           exchange_id AS exchange, symbol
    FROM {source} GROUP BY 1, exchange_id, symbol"""
BY_ARRIVAL = "ticker_timestamp_ms, tick_id"
BY_LINE = "ticker_timestamp_ms, l_orderkey, l_linenumber, cents"


@query(f"WITH {TICKS} " + BARS.format(bucket="ticker_timestamp_ms // 21600000 * 21600000", source="ticks", order=BY_ARRIVAL))
def tick_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour candles."""
    return bars(bind.ticks(spark, sf_dir), 6 * HOUR_MS)


@query(f"WITH {TICKS} " + BARS.format(bucket="ticker_timestamp_ms // 21600000 * 21600000", source="ticks", order=BY_ARRIVAL))
def tick_bars_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour candles grown by three loads, the latest ticks first; one load brings other ticks, then its own again."""
    ticks = bind.ticks(spark, sf_dir)
    store = CandleStore(spark, scratch_dir(spark, "candles"), 6 * HOUR_MS)
    for load_id, nth in (("load-3", 2), ("load-1", 1), ("load-2", 1), ("load-1", 0)):
        store.add(ticks.filter(F.col("tick_id") % 3 == nth), load_id)
    return store.read()


@query(
    f"WITH {TRADES} "
    + BARS.format(bucket="ticker_timestamp_ms // 2592000000 * 2592000000", source="trades", order=BY_LINE)
)
def trade_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty-day candles of the larger trade table."""
    order = ("ticker_timestamp_ms", "l_orderkey", "l_linenumber", "cents")
    return bars(bind.trades(spark, sf_dir), 30 * DAY_MS, order)


@query(
    f"""WITH {TICKS},
    shifted AS (SELECT tick_id, exchange_id, symbol, ticker_timestamp_ms, last - 5 AS last, base_volume FROM ticks),
    bars AS ({BARS.format(bucket="ticker_timestamp_ms // 21600000 * 21600000", source="shifted", order=BY_ARRIVAL)})
    SELECT 'timestamp_present' AS rule, count(*) AS checked, 0::BIGINT AS violations FROM bars
    """
    + " ".join(
        f"UNION ALL SELECT '{c}_positive', count(*), count(*) FILTER (coalesce({c} <= 0, true)) FROM bars"
        for c in ("open", "high", "low", "close")
    )
    + " UNION ALL SELECT 'volume_not_negative', count(*), count(*) FILTER (coalesce(volume < 0, true)) FROM bars"
)
def bar_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candle rules, on candles whose prices were moved down so that some break them."""
    moved = bind.ticks(spark, sf_dir).withColumn("last", F.col("last") - 5)
    return quality.report(bars(moved, 6 * HOUR_MS), quality.CANDLE_RULES)


@query(
    f"""WITH {TICKS}, newest AS (SELECT exchange_id, max(extraction_timestamp) AS newest_ms FROM ticks GROUP BY 1)
    SELECT exchange_id, newest_ms, 1707955200000 - newest_ms AS age_ms,
           1707955200000 - newest_ms > 1296000000 AS stale FROM newest"""
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age of each venue's newest snapshot on 2024-02-15, stale after 15 days."""
    return quality.freshness(bind.ticks(spark, sf_dir), 1_707_955_200_000, 15 * DAY_MS)


@query(
    f"""WITH {MANIFEST}, steps AS (
      SELECT exchange_id, extraction_timestamp // 3600000 AS slot,
             lag(extraction_timestamp // 3600000) OVER (PARTITION BY exchange_id ORDER BY extraction_timestamp) AS before
      FROM loaded)
    SELECT exchange_id, (before + 1) * 3600000 AS gap_start, (slot - 1) * 3600000 AS gap_end, slot - before - 1 AS missing
    FROM steps WHERE slot - before > 1"""
)
def missing_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours without a loaded snapshot, venue by venue, sorted in blocks of five hours."""
    ticks = bind.ticks(spark, sf_dir)
    return gaps.missing_polls(ticks.filter(bind.is_loaded(ticks)), HOUR_MS, 5 * HOUR_MS)


@query(
    f"""WITH {LATEST}, l AS (
      SELECT exchange_id, symbol, min(last) AS low, max(last) AS high, count(last) AS n FROM latest
      WHERE extraction_timestamp < (SELECT max(extraction_timestamp) FROM latest) - 86400000 GROUP BY 1, 2)
    SELECT exchange_id, symbol, extraction_timestamp, last,
           coalesce(last < l.low + (l.high - l.low) * 0.25::DOUBLE OR last > l.high - (l.high - l.low) * 0.25::DOUBLE, false) AS out_of_range
    FROM latest LEFT JOIN l USING (exchange_id, symbol)"""
)
def price_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices against limits from all days but the newest, by merged sketches, whose ends are exact at any size.

    The slack is negative here, so that some prices break their limits.
    """
    rows = transform_tickers(spark, sf_dir).select("exchange_id", "symbol", "extraction_timestamp", "last")
    newest = rows.agg(F.max("extraction_timestamp")).scalar()
    history = ranges.day_sketches(rows.filter(F.col("extraction_timestamp") < newest - DAY_MS))
    return ranges.judged(rows, ranges.limits(history, 0.0, 1.0, -0.25))


@query(
    f"""WITH {LATEST}, grid AS (
      SELECT i.symbol, i.extraction_timestamp, v.exchange_id
      FROM (SELECT DISTINCT symbol, extraction_timestamp FROM latest) i
      JOIN (SELECT DISTINCT symbol, exchange_id FROM latest) v ON i.symbol = v.symbol),
    last_quotes AS (
      SELECT g.symbol, g.extraction_timestamp, g.exchange_id, q.bid, q.ask FROM grid g ASOF JOIN latest q
        ON g.symbol = q.symbol AND g.exchange_id = q.exchange_id AND g.extraction_timestamp >= q.extraction_timestamp)
    SELECT symbol, extraction_timestamp, max(bid) AS best_bid,
           first(exchange_id ORDER BY bid DESC, exchange_id) FILTER (bid IS NOT NULL) AS bid_venue,
           min(ask) AS best_ask, first(exchange_id ORDER BY ask, exchange_id) FILTER (ask IS NOT NULL) AS ask_venue,
           count(*) AS venues
    FROM last_quotes GROUP BY 1, 2"""
)
def best_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best bid and ask of all venues at each instant, by the last quote of each."""
    return across.best(transform_tickers(spark, sf_dir), 6 * HOUR_MS)
