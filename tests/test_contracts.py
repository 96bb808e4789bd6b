from pyspark.sql import types as T

from ticklake.contracts import OHLCV, PIPELINE_CONFIG, TICKER, property_type, struct_from_annotations


def test_ticker_contract_columns_in_order():
    assert TICKER.columns == [
        "symbol", "ticker_timestamp_ms", "ticker_datetime", "last", "bid", "ask", "high", "low",
        "volume", "base_volume", "quote_volume", "exchange_id", "extraction_timestamp",
    ]
    assert TICKER.full_name == "crypto_data.raw_tickers"


def test_config_contract_width():
    assert len(PIPELINE_CONFIG.columns) == 24
    assert OHLCV.key == ("exchange", "symbol", "timestamp")


def test_types_from_annotations_take_the_first_member_of_optionals():
    got = struct_from_annotations({"a": int, "b": float | None, "c": bool, "d": str | None, "e": dict})
    kinds = [(f.name, f.dataType.simpleString(), f.nullable) for f in got]
    assert kinds == [
        ("a", "bigint", True), ("b", "double", True), ("c", "boolean", True),
        ("d", "string", True), ("e", "string", True),
    ]


def test_property_types_fall_back_to_text():
    assert property_type(T.IntegerType()) == T.LongType()
    assert property_type(T.FloatType()) == T.DoubleType()
    assert property_type(T.DateType()) == T.DateType()
    assert property_type(T.TimestampNTZType()) == T.TimestampType()
    assert property_type(T.ArrayType(T.LongType())) == T.StringType()
    assert property_type(T.DecimalType(10, 2)) == T.StringType()
