"""First-time setup: namespaces, tables, and the configuration rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticklake.contracts import PIPELINE_CONFIG, TICKER, Contract
from ticklake.operators import configs
from ticklake.operators.writers import append_by_name, create_namespace, create_table
from ticklake.sources.tables import read_table


def bootstrap(
    spark: SparkSession,
    root: str | None = None,
    contracts: tuple[Contract, ...] = (TICKER, PIPELINE_CONFIG),
) -> None:
    """Create what is absent, keep what is there; ``root`` places new namespaces."""
    for contract in contracts:
        location = f"{root}/{contract.namespace}" if root else None
        create_namespace(spark, contract.namespace, location)
        create_table(spark, contract.full_name, contract.struct)


def seed_configs(seed: DataFrame, name: str = PIPELINE_CONFIG.full_name) -> tuple[int, int]:
    """Insert the seed rows whose venue is absent: (inserted, skipped)."""
    existing = read_table(seed.sparkSession, name, PIPELINE_CONFIG)
    inserted, skipped = configs.seed_counts(seed, existing).first()
    append_by_name(configs.to_insert(seed, existing), name, PIPELINE_CONFIG)
    return inserted, skipped
