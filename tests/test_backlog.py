import random

import pytest
from pyspark.sql import functions as F

from ticklake.operators import backlog as b

from .conftest import rows

PAIR = "exchange_id string, extraction_timestamp long"


def pairs(spark, *given):
    return spark.createDataFrame(list(given), PAIR)


@pytest.mark.parametrize(
    ("table", "venue", "expected"),
    [
        ([("binance", 1000), ("binance", 1000), ("binance", 2000)], "binance", [1000, 2000]),
        ([("binance", 1), ("binance", 2), ("bybit", 1)], "binance", [1, 2]),
        ([("binance", 1), ("binance", 1), ("bybit", 2), ("bybit", 2)], "bybit", [2]),
        ([("binance", None)], "binance", []),
        ([], "binance", []),
    ],
)
def test_loaded_timestamps(spark, table, venue, expected):
    got = rows(b.loaded_timestamps(pairs(spark, *table), venue), "extraction_timestamp")
    assert got == [(t,) for t in expected]


def test_recent_window_excludes_its_lower_bound(spark):
    loaded = pairs(spark, ("e", 100), ("e", 3_400_000), ("e", 25_000_000), ("f", 1), ("f", 2))
    assert rows(b.recent_loaded(loaded)) == [("e", 25_000_000), ("f", 1), ("f", 2)]


def test_lookback_boundaries(spark):
    loaded = pairs(spark, ("e", 100), ("e", 3_400_000), ("e", 25_000_000))
    candidates = [25_000_000, 24_999_999, 25_000_001, None]
    manifest = pairs(spark, *[("e", t) for t in candidates], ("new", 1), ("new", None))
    assert rows(b.backlog_lookback(manifest, loaded)) == [("e", 25_000_001), ("new", 1)]
    assert rows(b.backlog_full(manifest, loaded)) == [("e", 24_999_999), ("e", 25_000_001), ("new", 1)]
    assert rows(b.unstamped(manifest)) == [("e", None), ("new", None)]


def test_gap_above_the_oldest_window_instant_is_found_below_it_is_not(spark):
    hour = 3_600_000
    loaded = pairs(spark, *[("e", h * hour) for h in (1, 10, 12, 14)])
    manifest = pairs(spark, *[("e", h * hour) for h in range(1, 17)])
    assert [t // hour for _, t in rows(b.backlog_lookback(manifest, loaded))] == [11, 13, 15, 16]


def test_a_null_in_the_table_hides_nothing(spark):
    loaded = b.loaded_timestamps(pairs(spark, ("e", None), ("e", 1)))
    assert rows(b.backlog_full(pairs(spark, ("e", 1), ("e", 2)), loaded)) == [("e", 2)]


def test_flags(spark):
    flags = [("a", "false"), ("b", "true"), ("c", None), ("d", "TRUE"), ("e", "maybe"), ("f", "False")]
    manifest = spark.createDataFrame(flags, "path string, loaded string")
    assert [r[0] for r in rows(b.backlog_flag(manifest, "objects"), "path")] == ["a", "c", "f"]
    assert [r[0] for r in rows(b.backlog_flag(manifest, "files"), "path")] == ["a", "c", "e", "f"]
    typed = spark.createDataFrame([("a", False), ("b", True), ("c", None)], "path string, loaded boolean")
    assert [r[0] for r in rows(b.backlog_flag(typed), "path")] == ["a", "c"]


def test_strategy_choice(spark):
    manifest = spark.createDataFrame(
        [("e", 1, True), ("e", 30_000_000, False), ("e", 40_000_000, True), ("f", 5, True)], PAIR + ", loaded boolean"
    )
    target = pairs(spark, ("e", 30_000_000))
    assert rows(b.backlog(manifest), "extraction_timestamp") == [(30_000_000,)]
    assert rows(b.backlog(manifest, target, "objects"), "extraction_timestamp") == [(40_000_000,), (5,)]
    assert rows(b.backlog(manifest, target, "files"), "extraction_timestamp") == [(1,), (40_000_000,), (5,)]
    assert rows(b.backlog(manifest, target.limit(0)), "extraction_timestamp") == [(1,), (30_000_000,), (40_000_000,), (5,)]


def test_against_brute_force(spark):
    random.seed(7)
    for _ in range(3):
        table = [(random.choice("abc"), random.randrange(0, 200) * 360_000) for _ in range(40)]
        landed = [(random.choice("abcd"), random.randrange(0, 260) * 360_000) for _ in range(150)]
        expected = []
        for venue, t in landed:
            mine = [x for v, x in table if v == venue]
            window = [x for x in mine if x > max(mine) - 6 * 3_600_000] if mine else []
            if not mine or (t > min(window) and t not in window):
                expected.append((venue, t))
        got = b.backlog_lookback(pairs(spark, *landed), b.loaded_timestamps(pairs(spark, *table)))
        assert rows(got, "exchange_id", "extraction_timestamp") == sorted(expected, key=lambda r: [(True, str(v)) for v in r])


def test_load_rows_keeps_copies(spark):
    records = spark.createDataFrame([("e", 1, "A"), ("e", 1, "A"), ("e", 2, "A")], PAIR + ", symbol string")
    assert b.load_rows(records, pairs(spark, ("e", 1))).count() == 2


def test_hot_snapshot_and_venue(spark):
    """A third of the ticks in one snapshot: same answer, and copies shrink before they are shuffled."""
    hot = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 50)).alias("exchange_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400).cast("long").alias("extraction_timestamp"),
    )
    loaded = b.loaded_timestamps(hot)
    assert loaded.filter("exchange_id = 'hot'").count() == 1
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange hashpartitioning") == 1
