import uuid

import pytest

from ticklake.contracts import OHLCV, TICKER
from ticklake.operators import writers
from ticklake.session import scratch_dir
from ticklake.sources.tables import jdbc_options, read_table

from .conftest import rows


@pytest.fixture
def name(spark):
    writers.create_namespace(spark, "crypto_data", scratch_dir(spark, "crypto_data"))
    return f"crypto_data.t_{uuid.uuid4().hex[:8]}"


def candles(spark, shift=0):
    data = [(t + shift, 1.0, 2.0, 0.5, 1.5, 10.0, "binance", "BTC/USDT") for t in (1735689600000, 1735693200000)]
    return spark.createDataFrame(data, OHLCV.struct)


def test_append_accumulates(spark, name):
    writers.append_by_name(candles(spark), name, OHLCV)
    writers.append_by_name(candles(spark, 1000), name, OHLCV)
    assert read_table(spark, name).count() == 4
    assert rows(read_table(spark, name), "timestamp")[1] == (1735689601000,)


def test_partial_frame_fills_the_contract(spark, name):
    df = spark.createDataFrame([("A", 1, 2.0), ("B", 3, 4.0)], "symbol string, ticker_timestamp_ms long, last double")
    writers.append_by_name(df, name, TICKER)
    got = read_table(spark, name)
    assert got.columns == TICKER.columns
    assert rows(got, "symbol", "last", "bid", "exchange_id") == [("A", 2.0, None, None), ("B", 4.0, None, None)]


def test_extra_column_is_dropped_and_order_does_not_matter(spark, name):
    first = spark.createDataFrame([("A", 1.0, 1)], "symbol string, price double, timestamp long")
    writers.append_by_name(first, name)
    second = spark.createDataFrame([("x", 2, "B", 2.0)], "extra_field string, timestamp long, symbol string, price double")
    writers.append_by_name(second, name)
    assert rows(read_table(spark, name)) == [("A", 1.0, 1), ("B", 2.0, 2)]


@pytest.mark.parametrize("policy", ["create", "skip"])
def test_empty_frame(spark, name, policy):
    empty = spark.createDataFrame([], "timestamp long, value double")
    writers.append_by_name(empty, name, on_empty=policy)
    assert spark.catalog.tableExists(name) == (policy == "create")
    if policy == "create":
        assert read_table(spark, name).columns == ["timestamp", "value"]


def test_missing_table_policy(spark, name):
    with pytest.raises(ValueError, match="does not exist"):
        writers.append_by_name(candles(spark), name, OHLCV, on_missing="error")
    assert read_table(spark, name, OHLCV).count() == 0
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        read_table(spark, name)


def test_creating_twice_keeps_the_rows(spark, name):
    writers.create_table(spark, name, OHLCV.struct)
    writers.append_by_name(candles(spark), name, OHLCV)
    writers.create_table(spark, name, OHLCV.struct)
    assert read_table(spark, name).count() == 2


def test_an_absent_namespace_is_created(spark, name):
    other = name.replace("crypto_data.t", "fresh_namespace.t")
    writers.append_by_name(candles(spark), other, OHLCV)
    assert read_table(spark, other).count() == 2


def test_node_table_is_replaced_and_first_of_a_key_stays(spark, name):
    schema = "id long, symbol string, price double, volume double, arrival int"
    first = [(1, "BTC/USDT", 50000.0, 100.5, 1), (2, "ETH/USDT", 3000.0, 200.3, 2), (1, "again", 0.0, 0.0, 3)]
    location = scratch_dir(spark, "nodes")
    writers.replace_node_table(spark.createDataFrame(first, schema), name, ["arrival"], location)
    assert rows(read_table(spark, name), "id", "symbol") == [(1, "BTC/USDT"), (2, "ETH/USDT")]
    assert dict(read_table(spark, name).dtypes)["arrival"] == "bigint"
    writers.replace_node_table(spark.createDataFrame([(3, "X", 1.0, 1.0, 1)], schema), name, ["arrival"], location)
    assert rows(read_table(spark, name), "id") == [(3,)]


def test_node_properties_turn_nested_values_into_text(spark):
    got = writers.node_properties(spark.sql("SELECT 1 AS id, array(1, 2) AS a, DATE'2024-01-01' AS d, 1.5BD AS n"))
    assert [t for _, t in got.dtypes] == ["bigint", "string", "date", "string"]
    assert rows(got, "a", "n") == [("[1,2]", "1.5")]


def test_ticker_table_load_replaces_itself_only(spark):
    table = writers.TickerTable(spark, scratch_dir(spark, "tickers"))
    one = spark.createDataFrame([("A", 1.0, "e", 5)], "symbol string, last double, exchange_id string, extraction_timestamp long")
    table.append(one, "l1")
    table.append(one, "l2")
    table.append(one.selectExpr("symbol", "last + 1 AS last", "exchange_id", "extraction_timestamp"), "l1")
    assert rows(table.read(), "last") == [(1.0,), (2.0,)]


def test_jdbc_options_are_text():
    assert jdbc_options("jdbc:x", "t", fetchsize=5, user="u") == {
        "url": "jdbc:x", "dbtable": "t", "fetchsize": "5", "user": "u",
    }


def test_a_node_table_refuses_a_row_without_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, n long")
    with pytest.raises(Exception, match="NULL in its key"):
        writers.replace_node_table(df, "nodes_refused", ["n"])
