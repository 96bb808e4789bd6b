"""Queries over pipeline configurations."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.contracts import PIPELINE_CONFIG
from ticklake.operators import configs
from ticklake.operators.writers import create_namespace, create_table
from ticklake.plans.bootstrap import seed_configs
from ticklake.plans.domain_sql import CONFIGS, TICKS
from ticklake.plans.registry import query
from ticklake.session import scratch_dir, stored
from ticklake.sources import bind
from ticklake.sources.tables import read_table


@query(
    f"""WITH {CONFIGS}
    SELECT exchange_id, enabled, extract_group_name, transform_group_name, schedule_enabled, priority,
           's3_io_manager' AS extract_io_manager_key, true AS fetch_all_tickers, 30 AS timeout_seconds,
           3 AS max_retries, region, tier
    FROM configs WHERE NOT enabled"""
)
def config_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows a seeding adds where only the enabled venues are configured so far; the seed has each venue twice."""
    seed = bind.configs(spark, sf_dir)
    return configs.to_insert(seed.unionByName(seed), configs.enabled(seed)).select(
        "exchange_id",
        "enabled",
        "extract_group_name",
        "transform_group_name",
        "schedule_enabled",
        "priority",
        "extract_io_manager_key",
        "fetch_all_tickers",
        "timeout_seconds",
        "max_retries",
        F.try_element_at("tags", F.lit("region")).alias("region"),
        F.try_element_at("tags", F.lit("tier")).alias("tier"),
    )


@query(
    f"""WITH {CONFIGS}
    SELECT exchange_id, enabled, schedule_enabled, priority, region, tier FROM configs"""
)
def config_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configuration table: created, seeded with some venues, then with all, then once more."""
    name = f"config.pipeline_configs_{uuid.uuid4().hex[:12]}"
    create_namespace(spark, "config", scratch_dir(spark, "config"))
    create_table(spark, name, PIPELINE_CONFIG.struct, scratch_dir(spark, "pipeline_configs"))
    seed = bind.configs(spark, sf_dir)
    for batch in (configs.enabled(seed), seed, seed):
        seed_configs(batch, name)
    return read_table(spark, name, PIPELINE_CONFIG).select(
        "exchange_id",
        "enabled",
        "schedule_enabled",
        "priority",
        F.try_element_at("tags", F.lit("region")).alias("region"),
        F.try_element_at("tags", F.lit("tier")).alias("tier"),
    )


@query(
    f"""WITH {CONFIGS}
    SELECT count(*) FILTER (NOT enabled) AS inserted, count(*) + count(*) FILTER (enabled) AS skipped FROM configs"""
)
def config_seed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed has each venue twice: a new one is inserted once."""
    seed = bind.configs(spark, sf_dir)
    return configs.seed_counts(seed.unionByName(seed), configs.enabled(seed))


@query(f"WITH {CONFIGS} SELECT count(*) AS total, count(*) FILTER (enabled) AS enabled FROM configs")
def config_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configs.config_counts(bind.configs(spark, sf_dir))


@query(
    f"""WITH {CONFIGS}
    SELECT exchange_id, priority, CASE WHEN enabled THEN 'enabled' ELSE 'disabled' END AS status,
           CASE WHEN schedule_enabled THEN 'scheduled' ELSE 'manual' END AS schedule
    FROM configs ORDER BY priority DESC, exchange_id"""
)
def config_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configs.by_priority(configs.labelled(bind.configs(spark, sf_dir)))


@query(f"WITH {CONFIGS} SELECT exchange_id, priority FROM configs WHERE region = 'asia' AND tier = 'building'")
def config_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = configs.tagged(bind.configs(spark, sf_dir), region="asia", tier="building")
    return found.select("exchange_id", "priority")


@query(
    rf"""WITH {CONFIGS}
    SELECT exchange_id, regexp_full_match(extract_asset_name, '[a-z][a-z0-9_]*') AS extract_name_ok,
           regexp_full_match(transform_asset_name, '[a-z][a-z0-9_]*') AS transform_name_ok,
           length(extract_group_name) >= 1 AS extract_group_ok,
           length(transform_group_name) >= 1 AS transform_group_ok
    FROM configs"""
)
def config_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naming rules, per configuration row."""
    return configs.name_checks(bind.configs(spark, sf_dir))


_ALLOWED = "SELECT 'venue_' || o_custkey FROM orders WHERE o_totalprice > 400000"


@query(
    f"""WITH {CONFIGS}
    SELECT exchange_id, exchange_id IN ({_ALLOWED}) AS supported FROM configs"""
)
def config_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues on the allow list (customers with a large order) and the others."""
    orders = bind.table(spark, sf_dir, "orders").filter("o_totalprice > 400000")
    allowed = orders.select(bind.venue_of(F.col("o_custkey")).alias("exchange_id"))
    rows = bind.configs(spark, sf_dir).select("exchange_id")
    yes = configs.supported(rows, allowed).withColumn("supported", F.lit(True))
    return yes.unionByName(configs.unsupported(rows, allowed).withColumn("supported", F.lit(False)))


@query(
    f"""WITH {TICKS},
    venues AS (
      SELECT DISTINCT exchange_id, exchange_id = 'click' AS fetch_all,
             CASE WHEN exchange_id <> 'view' THEN ['U1', 'U3', 'U5', 'U7'] END AS symbols
      FROM ticks WHERE exchange_id <> 'error')
    SELECT t.tick_id, t.exchange_id, t.symbol, t.last FROM ticks t JOIN venues v USING (exchange_id)
    WHERE v.fetch_all OR v.symbols IS NULL OR list_contains(v.symbols, t.symbol)"""
)
def config_symbol_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks the configuration asks for; one venue is configured under an alias as well, which doesn't count."""
    ticks = bind.ticks(spark, sf_dir)
    rules = bind.venue_configs(ticks)
    again = rules.filter("exchange_id = 'signup'").withColumn("exchange_id", F.lit("signups")).withColumn("fetch_all_tickers", F.lit(True))
    table = stored(rules.unionByName(again), "venue_configs")
    chosen = configs.configured_ticks(ticks, table, {"signups": "signup"})
    return chosen.select("tick_id", "exchange_id", "symbol", "last")
