import random

import pytest
from pyspark.sql import functions as F

from ticklake.functions.times import HOUR_MS
from ticklake.operators import quality
from ticklake.operators.bars import bars
from ticklake.operators.reduce import first_by, latest_by

from .conftest import rows
from .test_tables import candles


def test_negative_open_is_one_violation(spark):
    bad = candles(spark).withColumn("open", F.lit(-50000.0))
    mixed = candles(spark).union(bad.limit(1))
    found = {r["rule"]: (r["checked"], r["violations"]) for r in quality.report(mixed, quality.CANDLE_RULES).collect()}
    assert found["open_positive"] == (3, 1) and found["close_positive"] == (3, 0)
    good, kept_out = quality.split(mixed, quality.CANDLE_RULES)
    assert good.count() == 2 and rows(kept_out, "open", "violations") == [(-50000.0, ["open_positive"])]


def test_null_breaks_a_rule_and_zero_volume_does_not(spark):
    df = candles(spark).withColumn("close", F.lit(None).cast("double")).withColumn("volume", F.lit(0.0))
    checked = quality.check(df, quality.CANDLE_RULES).first()
    assert checked["close_positive"] is False and checked["volume_not_negative"] is True


def test_split_is_a_partition(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (0.0,), (None,), (float("nan"),)], "x double")
    good, bad = quality.split(df, [quality.positive("x")])
    assert good.count() + bad.count() == 5 and bad.count() == 3
    optional = quality.optional(quality.positive("x"), "x")
    assert quality.split(df, [optional])[1].count() == 2


def test_state_says_what_split_does(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (0.0,), (None,), (float("nan"),)], "x double")
    states = quality.with_state(df, [quality.positive("x")]).groupBy("state").count()
    assert sorted(rows(states, "state", "count")) == [("passed", 2), ("quarantined", 3)]


def test_text_must_be_numeric(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "v string")
    assert rows(quality.report(df, [quality.numeric("v")])) == [(3, "v_numeric", 2)]


def test_one_row_per_key_by_hash_and_by_sort(spark):
    random.seed(3)
    data = [(random.choice("abc"), random.randrange(5), i, random.choice([None, float(i)])) for i in range(300)]
    df = spark.createDataFrame(data, "k string, g int, n long, v double")
    last = {(k, g): (k, g, n, v) for k, g, n, v in data}
    first = {(k, g): (k, g, n, v) for k, g, n, v in reversed(data)}
    hashed, wide = latest_by(df, ["k", "g"], ["n"]), latest_by(df.withColumn("s", F.lit("x")), ["k", "g"], ["n"])
    assert rows(hashed) == rows(wide.drop("s")) == sorted(last.values(), key=lambda r: [(v is not None, str(v)) for v in r])
    assert rows(first_by(df, ["k", "g"], ["n"])) == sorted(first.values(), key=lambda r: [(v is not None, str(v)) for v in r])
    assert "HashAggregate" in hashed._jdf.queryExecution().executedPlan().toString()


def test_rows_without_an_order_survive(spark):
    df = spark.createDataFrame([("a", None, 1.0)], "k string, n long, v double")
    assert rows(latest_by(df, ["k"], ["n"])) == [("a", None, 1.0)]
    assert rows(first_by(df, ["k"], ["n"])) == [("a", None, 1.0)]


def test_dedup_and_freshness(spark):
    schema = "exchange_id string, symbol string, extraction_timestamp long, last double, n int"
    df = spark.createDataFrame([("e", "A", 1, 1.0, 1), ("e", "A", 1, 2.0, 2), ("e", "B", 5, 3.0, 1)], schema)
    assert rows(quality.dedup_latest(df, ["n"]), "symbol", "last") == [("A", 2.0), ("B", 3.0)]
    assert rows(quality.freshness(df, 10, 5)) == [("e", 5, 5, False)]
    assert rows(quality.freshness(df, 11, 5)) == [("e", 5, 6, True)]


def test_bars(spark):
    schema = "tick_id long, exchange_id string, symbol string, ticker_timestamp_ms long, last double, base_volume double"
    given = [(2, "e", "A", 10, 5.0, 1.0), (1, "e", "A", 20, 3.0, None), (3, "e", "A", 30, 4.0, 2.0), (4, "e", "A", HOUR_MS, 9.0, None)]
    got = rows(bars(spark.createDataFrame(given, schema), HOUR_MS))
    # By time, though arrival says otherwise.
    assert got == [(0, 5.0, 5.0, 3.0, 4.0, 3.0, "e", "A"), (HOUR_MS, 9.0, 9.0, 9.0, 9.0, None, "e", "A")]


@pytest.mark.parametrize("order", [("ticker_timestamp_ms", "tick_id"), ("ticker_timestamp_ms", "tick_id", "last")])
def test_bars_of_equal_instants_follow_arrival(spark, order):
    schema = "tick_id long, exchange_id string, symbol string, ticker_timestamp_ms long, last double, base_volume double"
    big = 2**63 - 1
    given = [(big, "e", "A", 10, 1.0, 1.0), (-big, "e", "A", 10, 2.0, 1.0), (None, "e", "A", 5, 3.0, 1.0), (7, "e", "A", 10, 4.0, 1.0)]
    got = rows(bars(spark.createDataFrame(given, schema).repartition(3), HOUR_MS, order), "open", "close")
    assert got == [(3.0, 1.0)]
