"""Pipeline configuration: seeding, reports, and selection of what to load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.contracts import PIPELINE_CONFIG
from ticklake.operators.flatten import conform
from ticklake.operators.reduce import first_by

# Fixed value. ``\\z`` rather than ``$``, which in Java also matches before a final line break.
NAME_PATTERN = r"^[a-z][a-z0-9_]*\z"

# Defaults of columns a configuration row leaves out.
DEFAULTS = {
    "enabled": True,
    "extract_group_name": "raw_data",
    "transform_group_name": "transformed_data",
    "extract_io_manager_key": "s3_io_manager",
    "transform_io_manager_key": "postgres_io_manager",
    "schedule_enabled": False,
    "fetch_all_tickers": True,
    "timeout_seconds": 30,
    "priority": 0,
    "retry_enabled": True,
    "max_retries": 3,
}

# The five venues a new installation starts with.
# exchange_id, enabled, schedule_enabled, schedule_cron, priority, max_retries, symbols,
# rate_limit_per_minute, timeout_seconds, region, tier, type, description
SEED = [
    ("binance", True, True, "0 * * * *", 100, 3, ["BTC/USDT", "ETH/USDT", "BNB/USDT"],
     None, 30, "global", "tier1", "spot", "Binance exchange - largest crypto exchange by volume"),
    ("bybit", True, True, "0 * * * *", 90, 3, ["BTC/USDT", "ETH/USDT"],
     None, 30, "global", "tier1", "derivatives", "Bybit exchange - derivatives and spot trading"),
    ("kraken", False, False, "0 */2 * * *", 50, 5, ["BTC/USD", "ETH/USD"],
     60, 45, "us", "tier2", "spot", "Kraken exchange - US-based exchange (disabled by default)"),
    ("coinbase", False, False, "0 */6 * * *", 40, 3, ["BTC/USD", "ETH/USD"],
     None, 30, "us", "tier2", "spot", "Coinbase exchange - US-based exchange (disabled by default)"),
    ("gateio", False, False, "0 */4 * * *", 30, 3, ["BTC/USDT", "ETH/USDT"],
     None, 30, "global", "tier3", "spot", "Gate.io exchange - altcoin focused (disabled by default)"),
]

_SEED_COLUMNS = (
    "exchange_id string, enabled boolean, schedule_enabled boolean, schedule_cron string, "
    "priority int, max_retries int, symbols array<string>, rate_limit_per_minute int, "
    "timeout_seconds int, region string, tier string, type string, description string"
)

# Configured names that differ from the names snapshots carry.
ALIASES = {"gateio": "gate"}


def with_defaults(rows: DataFrame) -> DataFrame:
    """Complete partial configuration rows to the contract; the venue doubles as the key."""
    have = set(rows.columns)
    for name, value in DEFAULTS.items():
        given = F.coalesce(F.col(name), F.lit(value)) if name in have else F.lit(value)
        rows = rows.withColumn(name, given)
    if "id" not in have:
        rows = rows.withColumn("id", F.col("exchange_id"))
    return conform(rows, PIPELINE_CONFIG.struct)


def default_configs(spark: SparkSession) -> DataFrame:
    seeds = spark.createDataFrame(SEED, _SEED_COLUMNS)
    tags = F.create_map(*[x for k in ("region", "tier", "type") for x in (F.lit(k), F.col(k))])
    return with_defaults(
        seeds.withColumn("tags", tags)
        .withColumn("extract_asset_name", F.concat("exchange_id", F.lit("_raw_tickers")))
        .withColumn("transform_asset_name", F.concat("exchange_id", F.lit("_transformed_tickers")))
    )


def to_insert(seed: DataFrame, existing: DataFrame) -> DataFrame:
    """One seed row of each venue that is not configured yet; of several the first by priority, then by id."""
    ranked = seed.withColumn("_order", -F.coalesce("priority", F.lit(0)))
    first = first_by(ranked, ["exchange_id"], ["_order", "id", "extract_asset_name", "enabled"])
    fresh = first.join(existing.select("exchange_id"), "exchange_id", "left_anti")
    return fresh.select(*seed.columns)


def seed_counts(seed: DataFrame, existing: DataFrame) -> DataFrame:
    """How many seed rows would be inserted, how many skipped: known venues, and all but one row of a venue."""
    known = existing.select("exchange_id", F.lit(True).alias("known")).distinct()
    venues = seed.groupBy("exchange_id").agg(F.count(F.lit(1)).alias("n")).join(known, "exchange_id", "left")
    inserted = F.count_if(F.col("known").isNull())
    return venues.agg(inserted.alias("inserted"), (F.coalesce(F.sum("n"), F.lit(0)) - inserted).alias("skipped"))


def config_counts(configs: DataFrame) -> DataFrame:
    return configs.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("enabled")).alias("enabled")
    )


def enabled(configs: DataFrame) -> DataFrame:
    return configs.filter("enabled")


def labelled(configs: DataFrame) -> DataFrame:
    """Venue, priority, and its two states in words."""
    return configs.select(
        "exchange_id",
        "priority",
        F.when(F.col("enabled"), "enabled").otherwise("disabled").alias("status"),
        F.when(F.col("schedule_enabled"), "scheduled").otherwise("manual").alias("schedule"),
    )


def by_priority(configs: DataFrame) -> DataFrame:
    """Highest priority first; the venue name settles ties."""
    return configs.orderBy(F.desc("priority"), "exchange_id")


def tagged(configs: DataFrame, **wanted: str) -> DataFrame:
    """Rows that carry all the given tags."""
    for key, value in wanted.items():
        configs = configs.filter(F.try_element_at("tags", F.lit(key)) == value)
    return configs


def valid_name(name: str | Column) -> Column:
    return F.coalesce(F.col(name) if isinstance(name, str) else name, F.lit("")).rlike(NAME_PATTERN)


def name_checks(configs: DataFrame) -> DataFrame:
    """Configuration rows with one verdict per naming rule."""
    return configs.select(
        "exchange_id",
        valid_name("extract_asset_name").alias("extract_name_ok"),
        valid_name("transform_asset_name").alias("transform_name_ok"),
        (F.length(F.coalesce("extract_group_name", F.lit(""))) >= 1).alias("extract_group_ok"),
        (F.length(F.coalesce("transform_group_name", F.lit(""))) >= 1).alias("transform_group_ok"),
    )


def supported(rows: DataFrame, allowed: DataFrame) -> DataFrame:
    """Rows whose venue is on the allow list, compared exactly."""
    listed = allowed.select("exchange_id").distinct()
    return rows.join(listed, "exchange_id", "left_semi").select(*rows.columns)


def unsupported(rows: DataFrame, allowed: DataFrame) -> DataFrame:
    """The others, a NULL venue among them."""
    listed = allowed.select("exchange_id").distinct()
    return rows.join(listed, "exchange_id", "left_anti").select(*rows.columns)


def snapshot_exchange(name: Column, aliases: dict[str, str] = ALIASES) -> Column:
    """Configured venue name -> the name its snapshots carry."""
    if not aliases:
        return name
    pairs = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, name), name)


def configured_ticks(
    ticks: DataFrame, configs: DataFrame, aliases: dict[str, str] = ALIASES
) -> DataFrame:
    """Ticks of enabled venues, of all symbols or the listed ones as the venue's row says.

    Several rows may mean one venue, by its name or an alias; then the row with the venue's own name
    counts, else the one with the highest priority, then the first name. Ticks are not multiplied. Hand
    the configurations in as a stored table: with its size known Spark broadcasts it, if it is small, and
    leaves the ticks in place.
    """
    venue = snapshot_exchange(F.col("exchange_id"), aliases)
    rows = configs.select(
        venue.alias("_venue"),
        F.when(venue.eqNullSafe(F.col("exchange_id")), 0).otherwise(1).alias("_alias"),
        (-F.coalesce("priority", F.lit(0))).alias("_rank"),
        F.col("exchange_id").alias("_name"),
        F.coalesce("fetch_all_tickers", F.lit(True)).alias("_all"),
        F.col("symbols").alias("_symbols"),
        "enabled",
    )
    chosen = first_by(rows, ["_venue"], ["_alias", "_rank", "_name"]).filter("enabled")
    chosen = chosen.select(F.col("_venue").alias("exchange_id"), "_all", "_symbols").hint("rebalance")
    wanted = F.col("_all") | F.col("_symbols").isNull() | F.array_contains("_symbols", F.col("symbol"))
    return ticks.join(chosen, "exchange_id").filter(wanted).select(*ticks.columns)


def empty_configs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], T.StructType(PIPELINE_CONFIG.struct.fields))
