import pytest
from pyspark.sql import functions as F

from ticklake.contracts import PIPELINE_CONFIG
from ticklake.operators import configs
from ticklake.operators.flatten import transform
from ticklake.plans.bootstrap import bootstrap, seed_configs
from ticklake.plans.pipeline import extract_configured
from ticklake.session import scratch_dir
from ticklake.sources.lake import SnapshotLake
from ticklake.sources.tables import read_table

from .conftest import rows
from .test_snapshots import ticks


def test_seed_rows(spark):
    seed = configs.default_configs(spark)
    assert seed.columns == PIPELINE_CONFIG.columns
    assert rows(seed, "exchange_id", "priority", "max_retries", "rate_limit_per_minute", "timeout_seconds") == [
        ("binance", 100, 3, None, 30), ("bybit", 90, 3, None, 30), ("coinbase", 40, 3, None, 30),
        ("gateio", 30, 3, None, 30), ("kraken", 50, 5, 60, 45),
    ]
    binance = seed.filter("exchange_id = 'binance'").first()
    assert binance["symbols"] == ["BTC/USDT", "ETH/USDT", "BNB/USDT"]
    assert binance["tags"] == {"region": "global", "tier": "tier1", "type": "spot"}
    assert (binance["extract_asset_name"], binance["extract_group_name"]) == ("binance_raw_tickers", "raw_data")


def test_seeding_twice_adds_nothing_new(spark):
    seed = configs.default_configs(spark)
    empty = configs.empty_configs(spark)
    assert rows(configs.seed_counts(seed, empty)) == [(5, 0)]
    table = empty.unionByName(configs.to_insert(seed, empty))
    assert rows(configs.seed_counts(seed, table)) == [(0, 5)]
    assert configs.to_insert(seed, table).count() == 0
    assert rows(configs.config_counts(table)) == [(5, 2)]


def test_an_existing_row_is_not_overwritten(spark):
    seed = configs.default_configs(spark)
    mine = seed.filter("exchange_id = 'kraken'").withColumn("priority", F.lit(1))
    table = mine.unionByName(configs.to_insert(seed, mine))
    assert table.filter("exchange_id = 'kraken'").select("priority").first()[0] == 1 and table.count() == 5


def test_ranking_and_labels(spark):
    ranked = configs.by_priority(configs.labelled(configs.default_configs(spark))).collect()
    assert [tuple(r) for r in ranked] == [
        ("binance", 100, "enabled", "scheduled"), ("bybit", 90, "enabled", "scheduled"),
        ("kraken", 50, "disabled", "manual"), ("coinbase", 40, "disabled", "manual"),
        ("gateio", 30, "disabled", "manual"),
    ]


def test_tags(spark):
    seed = configs.default_configs(spark)
    assert rows(configs.tagged(seed, region="us", tier="tier2"), "exchange_id") == [("coinbase",), ("kraken",)]
    assert configs.tagged(seed, absent="x").count() == 0


@pytest.mark.parametrize(
    ("name", "ok"),
    [
        ("rows_of_a_venue", True), ("x9__", True), ("z", True), ("camelCase", False), ("_first", False),
        ("9lives", False), ("a b", False), ("dash-ed", False), ("", False), ("line\n", False), (None, False),
    ],
)
def test_names(spark, name, ok):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(configs.valid_name("n")).first()[0] is ok


def test_allow_list_is_exact(spark):
    allowed = spark.createDataFrame([("binance",), ("bybit",), ("binance",)], "exchange_id string")
    given = spark.createDataFrame([("binance",), ("Binance",), ("BINANCE",), (" binance ",), ("",), (None,)], "exchange_id string")
    assert rows(configs.supported(given, allowed)) == [("binance",)]
    assert configs.unsupported(given, allowed).count() == 5


def test_symbol_selection(spark):
    ticks = spark.createDataFrame(
        [(v, s) for v in ("all", "none", "some", "off", "gate") for s in ("A", "B")], "exchange_id string, symbol string"
    )
    given = spark.createDataFrame(
        [
            ("all", True, True, ["Z"]), ("none", True, False, None), ("some", True, False, ["B"]),
            ("off", False, True, None), ("gateio", True, False, ["A"]),
        ],
        "exchange_id string, enabled boolean, fetch_all_tickers boolean, symbols array<string>",
    )
    got = configs.configured_ticks(ticks, configs.with_defaults(given))
    assert rows(got) == [("all", "A"), ("all", "B"), ("gate", "A"), ("none", "A"), ("none", "B"), ("some", "B")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_bootstrap_and_seed_a_table(spark):
    root = scratch_dir(spark, "bootstrap")
    spark.sql("DROP DATABASE IF EXISTS config CASCADE")
    for expected in ((5, 0), (0, 5)):
        bootstrap(spark, root, (PIPELINE_CONFIG,))
        assert seed_configs(configs.default_configs(spark)) == expected
    table = read_table(spark, PIPELINE_CONFIG.full_name)
    assert rows(configs.config_counts(table)) == [(5, 2)]
    assert table.filter("exchange_id = 'bybit'").first()["tags"]["type"] == "derivatives"


def test_only_configured_ticks_are_landed(spark):
    lake = SnapshotLake(spark, scratch_dir(spark, "lake"))
    given = [
        {"tick_id": i, "exchange_id": v, "symbol": s, "extraction_timestamp": 9, "last": 1.0}
        for i, (v, s) in enumerate([("on", "A"), ("on", "B"), ("off", "A")])
    ]
    rules = [("on", True, False, ["B"]), ("off", False, True, None)]
    schema = "exchange_id string, enabled boolean, fetch_all_tickers boolean, symbols array<string>"
    wanted = configs.with_defaults(spark.createDataFrame(rules, schema))
    extract_configured(ticks(spark, *given), wanted, lake, "raw_tickers", "r1", 5)
    assert rows(transform(lake.snapshots()), "exchange_id", "symbol") == [("on", "B")]


def test_a_venue_twice_in_a_seed_is_inserted_once(spark):
    seed = configs.with_defaults(spark.createDataFrame([("v", 1), ("v", 5), ("w", 2)], "exchange_id string, priority int"))
    empty = configs.empty_configs(spark)
    assert rows(configs.to_insert(seed, empty), "exchange_id", "priority") == [("v", 5), ("w", 2)]
    assert rows(configs.seed_counts(seed, empty)) == [(2, 1)]
    assert rows(configs.seed_counts(seed, seed.filter("exchange_id = 'v'"))) == [(1, 2)]


def test_a_venue_and_its_alias_do_not_double_ticks(spark):
    ticks = spark.createDataFrame([("gate", "A"), ("gate", "B")], "exchange_id string, symbol string")
    given = [("gateio", True, True, None, 9), ("gate", True, False, ["B"], 1)]
    schema = "exchange_id string, enabled boolean, fetch_all_tickers boolean, symbols array<string>, priority int"
    rules = configs.with_defaults(spark.createDataFrame(given, schema))
    assert rows(configs.configured_ticks(ticks, rules)) == [("gate", "B")]
    assert rows(configs.configured_ticks(ticks, rules.filter("priority = 9"))) == [("gate", "A"), ("gate", "B")]
