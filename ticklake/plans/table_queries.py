"""Queries through tables: contract append, implicit create, node tables, the partitioned lake."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.contracts import TICKER, struct_from_annotations
from ticklake.functions.times import now_ms
from ticklake.operators import flatten, quality, writers
from ticklake.plans.domain_sql import LATEST, TICKER_COLUMNS, TICKS
from ticklake.plans.registry import query
from ticklake.plans.snapshot_queries import transform_tickers
from ticklake.session import scratch_dir
from ticklake.sources import bind
from ticklake.sources.tables import read_table


def _fresh_table(spark: SparkSession, label: str) -> tuple[str, str]:
    """(unused table name, its location in the shared folder)"""
    writers.create_namespace(spark, TICKER.namespace, scratch_dir(spark, TICKER.namespace))
    return f"{TICKER.namespace}.{label}_{uuid.uuid4().hex[:12]}", scratch_dir(spark, label)


@query(
    f"""WITH {LATEST}
    SELECT symbol, ticker_timestamp_ms, NULL::VARCHAR AS ticker_datetime, last,
           NULL::DOUBLE AS bid, NULL::DOUBLE AS ask, NULL::DOUBLE AS high, NULL::DOUBLE AS low,
           NULL::DOUBLE AS volume, NULL::DOUBLE AS base_volume, NULL::DOUBLE AS quote_volume,
           exchange_id, extraction_timestamp FROM latest"""
)
def append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame with too few, too many and reordered columns into a table created from the contract."""
    name, location = _fresh_table(spark, "by_name")
    rows = transform_tickers(spark, sf_dir).select(
        F.lit("x").alias("extra_field"),
        "extraction_timestamp",
        "last",
        "exchange_id",
        "symbol",
        "ticker_timestamp_ms",
    )
    writers.append_by_name(rows, name, TICKER, location=location)
    return read_table(spark, name)


@query(f"WITH {LATEST} SELECT {TICKER_COLUMNS} FROM latest UNION ALL SELECT {TICKER_COLUMNS} FROM latest")
def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain append does not look at what is there."""
    name, location = _fresh_table(spark, "twice")
    rows = transform_tickers(spark, sf_dir)
    for _ in range(2):
        writers.append_by_name(rows, name, TICKER, location=location)
    return read_table(spark, name)


@query(f"WITH {LATEST} SELECT exchange_id, symbol, last, extraction_timestamp FROM latest")
def ctas_implicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No contract: the table takes the frame's columns."""
    name, location = _fresh_table(spark, "implicit")
    rows = transform_tickers(spark, sf_dir).select("exchange_id", "symbol", "last", "extraction_timestamp")
    writers.append_by_name(rows, name, location=location)
    return read_table(spark, name)


_NODES = """WITH nodes AS (
  SELECT user_id AS id, 'U' || (user_id % 20) AS symbol, value AS price, event_type AS venue
  FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1)"""


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, location = _fresh_table(spark, "nodes")
    rows = bind.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.concat(F.lit("U"), (F.col("user_id") % 20).cast("string")).alias("symbol"),
        F.col("value").alias("price"),
        F.col("event_type").alias("venue"),
        F.col("event_id").alias("arrival"),
    )
    writers.replace_node_table(rows, name, ["arrival"], location)
    return read_table(spark, name).drop("arrival")


@query(f"{_NODES} SELECT * FROM nodes")
def node_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as nodes; of equal keys the first stays."""
    return _nodes(spark, sf_dir)


@query(f"{_NODES} SELECT * FROM nodes WHERE symbol = 'U7'")
def node_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(spark, sf_dir).filter(F.col("symbol") == "U7")


@query(
    f"""WITH {LATEST}
    SELECT {TICKER_COLUMNS}, CAST(make_timestamp(extraction_timestamp * 1000) AS DATE) AS date
    FROM latest WHERE exchange_id = 'purchase' AND extraction_timestamp >= 1705276800000"""
)
def lake_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by venue and date, read back with both pruned: from 2024-01-15 on."""
    tickers = writers.TickerTable(spark, scratch_dir(spark, "tickers"))
    tickers.append(transform_tickers(spark, sf_dir), "load-1")
    return tickers.read().filter("exchange_id = 'purchase' AND date >= DATE'2024-01-15'")


@query(
    f"""WITH {TICKS}
    SELECT {TICKER_COLUMNS} FROM ticks
    QUALIFY row_number() OVER (
      PARTITION BY exchange_id, symbol, extraction_timestamp ORDER BY ticker_timestamp_ms DESC, tick_id DESC) = 1"""
)
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per natural key."""
    ticks = bind.ticks(spark, sf_dir)
    kept = quality.dedup_latest(ticks, ["ticker_timestamp_ms", "tick_id"])
    return flatten.transform(bind.records(kept))



@query(f"WITH {LATEST} SELECT {TICKER_COLUMNS} FROM latest")
def table_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four loads; closed days compacted; one of the loads again and one more; compacted again, hidden files dropped."""
    table = writers.TickerTable(spark, scratch_dir(spark, "compacted"))
    rows = transform_tickers(spark, sf_dir).withColumn("nth", F.pmod(F.col("extraction_timestamp") / 3_600_000, F.lit(5)))
    loads = {n: rows.filter(F.col("nth") == n).drop("nth") for n in range(5)}
    for n in range(4):
        table.append(loads[n], f"load-{n}")
    closed = datetime.fromtimestamp(rows.agg(F.max("extraction_timestamp")).first()[0] / 1000, UTC).date()
    table.compact(closed)
    table.append(loads[2], "load-2")
    table.append(loads[4], "load-4")
    table.compact(closed)
    table.vacuum()
    return table.read().drop("date")


@query(
    f"""WITH {LATEST}
    SELECT 'skipped' AS what, 0 AS n UNION ALL SELECT 'created', 0
    UNION ALL SELECT 'refused', 1 UNION ALL SELECT 'rows', count(*) FROM latest"""
)
def table_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty frame creates nothing or an empty table; a table that isn't there is refused or created."""
    rows = transform_tickers(spark, sf_dir)
    empty = rows.filter("last < -1e300")
    skipped, place = _fresh_table(spark, "skipped")
    writers.append_by_name(empty, skipped, on_empty="skip", location=place)
    created, place = _fresh_table(spark, "created")
    writers.append_by_name(empty, created, TICKER, on_empty="create", location=place)
    written, place = _fresh_table(spark, "written")
    refused = 0
    try:
        writers.append_by_name(rows, written, on_missing="error", location=place)
    except ValueError:
        refused = 1
    writers.append_by_name(rows, written, on_missing="create", location=place)
    count = F.count(F.lit(1)).alias("n")
    sizes = [
        spark.range(1).select(F.lit("skipped").alias("what"), F.lit(int(spark.catalog.tableExists(skipped))).cast("long").alias("n")),
        spark.range(1).select(F.lit("refused").alias("what"), F.lit(refused).cast("long").alias("n")),
        read_table(spark, created).agg(count).select(F.lit("created").alias("what"), "n"),
        read_table(spark, written).agg(count).select(F.lit("rows").alias("what"), "n"),
    ]
    return reduce(DataFrame.unionByName, sizes)


QUOTE = {"exchange_id": str, "symbol": str, "last": float | None, "seen": int, "late": bool}


@query(
    f"""WITH {LATEST}
    SELECT exchange_id, symbol, last, true AS stamped, extraction_timestamp % 7200000 = 0 AS late FROM latest"""
)
def derived_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows conformed to a schema derived from plain annotations, stamped with the query's own time."""
    rows = transform_tickers(spark, sf_dir).withColumn("seen", now_ms())
    late = rows.withColumn("late", F.col("extraction_timestamp") % 7_200_000 == 0)
    conformed = flatten.conform(late, struct_from_annotations(QUOTE))
    year_2025 = 1_735_689_600_000
    return conformed.select("exchange_id", "symbol", "last", (F.col("seen") > year_2025).alias("stamped"), "late")
