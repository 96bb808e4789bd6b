"""Scans of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticklake.contracts import Contract


def read_table(spark: SparkSession, name: str, contract: Contract | None = None) -> DataFrame:
    """A catalog table. With a contract a missing table reads as empty, without one it is an error."""
    if contract is not None and not spark.catalog.tableExists(name):
        return spark.createDataFrame([], contract.struct)
    return spark.table(name)


def jdbc_options(url: str, table: str, **extra: object) -> dict[str, str]:
    return {"url": url, "dbtable": table, **{k: str(v) for k, v in extra.items()}}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    lower_ms: int | None = None,
    upper_ms: int | None = None,
    partitions: int = 1,
    **extra: object,
) -> DataFrame:
    """A table of a SQL database, read in parallel slices of ``extraction_timestamp``.

    The bounds only place the slices; rows outside them fall into the first and last one.
    """
    options = jdbc_options(url, table, fetchsize=10_000, **extra)
    if partitions > 1:
        options |= {
            "partitionColumn": "extraction_timestamp",
            "lowerBound": str(lower_ms),
            "upperBound": str(upper_ms),
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(**options).load()
