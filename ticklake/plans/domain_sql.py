"""Shared SQL of the oracles: the domain binding of ``sources.bind``, written for DuckDB.

DuckDB rounds where Spark truncates, so instants are cut from microseconds by integer division.
"""

TICKS = """
ticks AS (
  SELECT event_id AS tick_id, event_type AS exchange_id, 'U' || (user_id % 20) AS symbol,
         epoch_us(ts) // 1000 AS ticker_timestamp_ms,
         CASE WHEN event_id % 11 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') END AS ticker_datetime,
         value AS last,
         CASE WHEN event_id % 7 <> 0 THEN value * 0.99::DOUBLE END AS bid,
         CASE WHEN event_id % 13 <> 0 THEN value * 1.01::DOUBLE END AS ask,
         value + 1.0::DOUBLE AS high,
         value - 1.0::DOUBLE AS low,
         CASE WHEN event_id % 5 <> 0 THEN value * 2.0::DOUBLE END AS volume,
         CASE WHEN event_id % 17 <> 0 THEN (event_id % 1000)::DOUBLE END AS base_volume,
         CASE WHEN event_id % 17 <> 0 THEN (event_id % 1000)::DOUBLE * value END AS quote_volume,
         epoch_us(ts) // 3600000000 * 3600000 AS extraction_timestamp
  FROM events)"""

TICKER_COLUMNS = (
    "symbol, ticker_timestamp_ms, ticker_datetime, last, bid, ask, high, low, volume, "
    "base_volume, quote_volume, exchange_id, extraction_timestamp"
)

LATEST = f"""{TICKS},
latest AS (
  SELECT * FROM ticks
  QUALIFY row_number() OVER (
    PARTITION BY exchange_id, extraction_timestamp, symbol ORDER BY tick_id DESC) = 1)"""

MANIFEST = f"""{LATEST},
snapshots AS (
  SELECT DISTINCT exchange_id, extraction_timestamp,
         exchange_id || '/raw/tickers_' || extraction_timestamp || '.json' AS snapshot_path
  FROM ticks),
manifest AS (
  SELECT *, (extraction_timestamp // 3600000) % 24 NOT IN (3, 19, 20)
            AND extraction_timestamp < (SELECT max(extraction_timestamp) FROM ticks) - 86400000 AS loaded
  FROM snapshots),
loaded AS (SELECT exchange_id, extraction_timestamp FROM manifest WHERE loaded)"""

LOOKBACK = f"""{MANIFEST},
recent AS (
  SELECT l.exchange_id, l.extraction_timestamp FROM loaded l
  JOIN (SELECT exchange_id, max(extraction_timestamp) AS newest FROM loaded GROUP BY 1) n
    ON l.exchange_id = n.exchange_id AND l.extraction_timestamp > n.newest - 21600000),
lookback AS (
  SELECT m.exchange_id, m.extraction_timestamp, m.snapshot_path FROM manifest m
  LEFT JOIN (SELECT exchange_id, min(extraction_timestamp) AS floor FROM recent GROUP BY 1) f
    ON m.exchange_id = f.exchange_id
  WHERE (f.floor IS NULL OR m.extraction_timestamp > f.floor)
    AND NOT EXISTS (SELECT 1 FROM recent r WHERE r.exchange_id = m.exchange_id
                    AND r.extraction_timestamp = m.extraction_timestamp))"""

CONFIGS = """
configs AS (
  SELECT 'venue_' || c_custkey AS exchange_id, c_acctbal >= 0 AS enabled,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name
              ELSE 'venue_' || c_custkey || '_raw_tickers' END AS extract_asset_name,
         'venue_' || c_custkey || '_transformed_tickers' AS transform_asset_name,
         CASE WHEN c_acctbal < 0 THEN '' ELSE 'raw_data' END AS extract_group_name,
         'transformed_data' AS transform_group_name,
         c_acctbal > 5000 AS schedule_enabled,
         floor(c_acctbal / 100)::INTEGER AS priority,
         lower(r_name) AS region, lower(c_mktsegment) AS tier
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

TRADES = """
trades AS (
  SELECT l_orderkey, l_linenumber, floor(l_extendedprice / l_quantity * 100)::BIGINT AS cents,
         l_returnflag AS exchange_id, 'P' || l_partkey % 25 AS symbol,
         epoch_us(l_shipdate) // 1000 AS ticker_timestamp_ms,
         floor(l_extendedprice / l_quantity * 100) / 100.0::DOUBLE AS last,
         l_quantity AS base_volume
  FROM lineitem)"""
