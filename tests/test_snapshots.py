"""Envelope, flatten and conform on the fixture snapshots."""

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ticklake.contracts import SNAPSHOT, TICKER
from ticklake.operators import envelope, flatten, metrics

from .conftest import rows

TICK = (
    "tick_id long, exchange_id string, symbol string, ticker_timestamp_ms long, ticker_time timestamp, "
    "last double, bid double, ask double, high double, low double, volume double, base_volume double, "
    "quote_volume double, extraction_timestamp long"
)


def lines(spark, *snapshots):
    return flatten.parse_json_text(spark.createDataFrame([(json.dumps(s),) for s in snapshots], "value string"))


def full(symbol, last):
    return {
        "symbol": symbol, "timestamp": 1735675200000, "datetime": "2025-12-31T20:00:00.000Z", "last": last,
        "bid": last - 1, "ask": last + 1, "high": last + 2, "low": last - 2, "volume": 10.0,
        "baseVolume": 11.0, "quoteVolume": 12.0, "info": {"unknown": [1, 2]},
    }


def snapshot(*tickers, timestamp="2025-12-31T19:00:00.000000+00:00", exchange="binance"):
    return {"metadata": {"timestamp": timestamp, "exchange_id": exchange}, "data": {t["symbol"]: t for t in tickers}}


def ticks(spark, *given):
    names = [f.split()[0] for f in TICK.split(", ")]
    return spark.createDataFrame([tuple(g.get(n) for n in names) for g in given], TICK)


def test_full_snapshot_in_contract_order_and_types(spark):
    df = flatten.transform(
        lines(spark, snapshot(full("OAK-ELM", 640.0), full("PINE-ELM", 7.5), full("YEW-ELM", 0.25)))
    )
    assert df.columns == TICKER.columns
    assert [f.dataType for f in df.schema] == [f.dataType for f in TICKER.struct]
    assert rows(df)[0] == (
        "OAK-ELM", 1735675200000, "2025-12-31T20:00:00.000Z", 640.0, 639.0, 641.0, 642.0,
        638.0, 10.0, 11.0, 12.0, "binance", 1767207600000,
    )
    assert [r[0] for r in rows(df, "symbol")] == ["OAK-ELM", "PINE-ELM", "YEW-ELM"]


def test_missing_fields_are_null(spark):
    btc = {k: v for k, v in full("BTC/USDT", 1.0).items() if k not in ("high", "low")}
    eth = {"symbol": "ETH/USDT", "last": 3000, "timestamp": 1735675200000.0}
    got = rows(flatten.transform(lines(spark, snapshot(btc, eth))), "symbol", "last", "bid", "high", "ticker_timestamp_ms")
    assert got == [("BTC/USDT", 1.0, 0.0, None, 1735675200000), ("ETH/USDT", 3000.0, None, None, 1735675200000)]


def test_empty_snapshot_keeps_the_columns(spark):
    df = flatten.transform(lines(spark, snapshot()))
    assert df.columns == TICKER.columns and df.count() == 0
    assert flatten.empty_tickers(spark).columns == TICKER.columns


def test_wide_snapshot(spark):
    wide = [{"symbol": f"s{i:03}", "last": 0.5 * i, "bid": 0.5 * i - 2, "ask": 0.5 * i + 2} for i in range(211)]
    df = flatten.transform(lines(spark, snapshot(*wide)))
    assert df.agg(F.count("*"), F.sum("last"), F.sum("ask") - F.sum("bid")).first() == Row(211, 11077.5, 844.0)


def test_symbol_only_as_key_and_no_merging_across_snapshots(spark):
    inner = {"BTC/USDT": {"last": 1.0}, "ETH/USDT": {"last": 2.0, "symbol": None}}
    landed = [{"metadata": {"exchange_id": "binance", "timestamp": 1735689600000}, "data": inner}] * 3
    got = rows(flatten.transform(lines(spark, *landed)), "symbol", "extraction_timestamp")
    assert got == [("BTC/USDT", 1735689600000)] * 3 + [("ETH/USDT", 1735689600000)] * 3


def test_inner_symbol_overrides_the_key(spark):
    data = {"key": {"symbol": "BTC/USDT", "last": 1.0}}
    df = flatten.transform(lines(spark, {"metadata": {"timestamp": 1}, "data": data}))
    assert rows(df, "symbol") == [("BTC/USDT",)]


def test_minimal_snapshot_has_null_provenance(spark):
    df = flatten.transform(
        lines(spark, {"data": {"BTC/USDT": {"symbol": "BTC/USDT", "last": 50000}}, "metadata": {"exchange": "binance"}})
    )
    assert rows(df, "symbol", "last", "exchange_id", "extraction_timestamp") == [("BTC/USDT", 50000.0, None, None)]


def test_typed_snapshot_without_metadata_fields(spark):
    df = spark.sql("SELECT struct('x' AS other) AS metadata, map('A', struct(1.5D AS last)) AS data")
    assert rows(flatten.transform(df), "symbol", "last", "exchange_id") == [("A", 1.5, None)]


def test_flat_rows_are_accepted_and_other_shapes_refused(spark):
    flat = spark.sql("SELECT 'A' AS symbol, '12.9' AS timestamp, 3 AS last, 'x' AS extra, 7.5D AS extraction_timestamp")
    assert rows(flatten.transform(flat), "symbol", "ticker_timestamp_ms", "last", "extraction_timestamp") == [("A", 12, 3.0, 7)]
    with pytest.raises(ValueError, match="Neither"):
        flatten.transform(spark.range(1))


def test_union_of_unlike_records(spark):
    a = spark.sql("SELECT 'A' AS symbol, 1D AS last")
    b = spark.sql("SELECT 2D AS bid, 'B' AS symbol")
    assert rows(flatten.union_records(a, b), "symbol", "last", "bid") == [("A", 1.0, None), ("B", None, 2.0)]


def test_conform_drops_fills_reorders_and_casts(spark):
    df = spark.sql("SELECT 'x' AS extra, 3 AS last, 'A' AS symbol, named_struct('a', 1) AS exchange_id")
    got = flatten.conform(df, TICKER.struct)
    assert got.columns == TICKER.columns
    assert rows(got, "symbol", "last", "bid", "exchange_id") == [("A", 3.0, None, '{"a":1}')]


def test_drop_all_null_looks_at_every_value(spark):
    df = spark.createDataFrame([(None, "d", 1), (None, None, 2)], "ticker_timestamp_ms long, ticker_datetime string, x int")
    assert flatten.drop_all_null(df).columns == ["ticker_datetime", "x"]
    assert flatten.drop_all_null(df.limit(0)).columns == ["x"]


def test_mismatch_is_flagged_not_dropped(spark):
    df = spark.createDataFrame([("binance",), ("bybit",), (None,)], "exchange_id string")
    assert rows(flatten.with_mismatch(df, "binance")) == [(None, False), ("binance", False), ("bybit", True)]


def test_later_tick_wins_whole(spark):
    base = {"exchange_id": "e", "symbol": "A", "extraction_timestamp": 0}
    df = ticks(
        spark,
        {**base, "tick_id": 2, "last": 2.0, "bid": None},
        {**base, "tick_id": 1, "last": 1.0, "bid": 9.0},
        {**base, "tick_id": 3, "symbol": "B", "last": 3.0},
    )
    assert rows(envelope.latest_ticks(df), "symbol", "tick_id", "last", "bid") == [("A", 2, 2.0, None), ("B", 3, 3.0, None)]


def test_envelope_round_trip_and_split(spark):
    given = [
        {"tick_id": i, "exchange_id": e, "symbol": f"S{i}", "extraction_timestamp": 1000, "last": float(i)}
        for e in ("x", "y")
        for i in range(40)
    ]
    df = ticks(spark, *given)
    whole, split = envelope.envelopes(df), envelope.envelopes(df, parts=3)
    assert whole.count() == 2 and split.count() == 6
    assert split.select(F.max(F.size("data"))).first()[0] < 40
    for nested in (whole, split):
        text = flatten.parse_json_text(envelope.to_json_text(nested))
        back = rows(flatten.transform(text), "exchange_id", "symbol", "last", "extraction_timestamp")
        assert back == sorted((g["exchange_id"], g["symbol"], g["last"], 1000) for g in given)
        sampled = rows(envelope.sample_symbols(nested))
        assert sampled == [(e, 1000, 40, ["S0", "S1", "S10", "S11", "S12"]) for e in ("x", "y")]


def test_landed_json_matches_the_schema(spark):
    df = ticks(spark, {"tick_id": 1, "exchange_id": "e", "symbol": "A", "extraction_timestamp": 5, "last": 1.5})
    text = envelope.to_json_text(envelope.envelopes(df)).first()[0]
    assert json.loads(text) == {"metadata": {"timestamp": 5, "exchange_id": "e"}, "data": {"A": {"symbol": "A", "last": 1.5}}}
    assert lines(spark, json.loads(text)).schema == SNAPSHOT


def test_summaries(spark):
    df = spark.createDataFrame([("f1", 1), ("f1", 2), ("f2", 3)], "source_path string, x int")
    assert rows(metrics.load_summary(df)) == [(2, 3)]
    assert rows(metrics.load_summary(df.limit(0))) == [(0, 0)]
    assert rows(metrics.batch_summary(df)) == [(3, 2, "source_path, x")]
    assert rows(metrics.sample_head(df, ["x"], 2), "x") == [(1,), (2,)]


def test_observed_counts_come_with_the_action(spark):
    df = flatten.transform(lines(spark, snapshot(full("A", 1.0), {"symbol": "B"}, timestamp=5)))
    measured, seen = metrics.observed(df)
    measured.collect()
    assert seen.get == {"row_count": 2, "with_ticker_timestamp": 1, "newest_ms": 5}


def test_latest_metadata_by_time_and_by_name(spark):
    schema = "exchange_id string, extraction_timestamp long, run_timestamp long, run_id string, path string"
    df = spark.createDataFrame([("e", 9, 1, "a", "p1"), ("e", None, 2, "b", "p3"), ("e", 8, 3, "c", "p2")], schema)
    assert rows(metrics.latest_metadata(df), "path") == [("p1",)]
    assert rows(metrics.latest_metadata(df, F.col("path")), "path") == [("p3",)]


def test_latest_metadata_by_both_orders_at_once(spark):
    schema = "exchange_id string, extraction_timestamp long, run_timestamp long, run_id string, path string"
    df = spark.createDataFrame([("e", 9, 1, "a", "p1"), ("e", None, 2, "b", "p3"), ("e", 8, 3, "c", "p2")], schema)
    both = metrics.latest_entries(df, by_time=None, by_name=F.col("path"))
    assert rows(both.select("by_time.path", "by_name.run_id")) == [("p1", "b")]
