"""Fields outside the contract: kept and reported, where a scan with a given schema would lose them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.contracts import SNAPSHOT

KNOWN = tuple(SNAPSHOT["data"].dataType.valueType.fieldNames())


def ticker_fields(lines: DataFrame, value: str = "value") -> DataFrame:
    """(exchange_id, extraction_timestamp, symbol, field, content) of every field of every ticker in landed JSON texts.

    ``content`` is a VARIANT, so nothing is cast or cut. Texts that are no JSON, and snapshots whose data is no object, have
    no fields; a ticker that is no object has none either.
    """
    spark = lines.sparkSession
    parsed = lines.select(F.try_parse_json(F.col(value)).alias("snapshot"))
    placed = parsed.select(
        F.try_variant_get("snapshot", "$.metadata.exchange_id", "string").alias("exchange_id"),
        F.try_variant_get("snapshot", "$.metadata.timestamp", "double").cast("long").alias("extraction_timestamp"),
        F.try_variant_get("snapshot", "$.data", "variant").alias("data"),
    )
    symbols = placed.lateralJoin(spark.tvf.variant_explode(F.col("data").outer())).filter("key IS NOT NULL")
    tickers = symbols.select("exchange_id", "extraction_timestamp", F.col("key").alias("symbol"), F.col("value").alias("ticker"))
    fields = tickers.lateralJoin(spark.tvf.variant_explode(F.col("ticker").outer())).filter("key IS NOT NULL")
    return fields.select("exchange_id", "extraction_timestamp", "symbol", F.col("key").alias("field"), F.col("value").alias("content"))


def unknown_fields(fields: DataFrame, known: Sequence[str] = KNOWN) -> DataFrame:
    """The fields that aren't ``known``; a JSON null is a field as well."""
    return fields.filter(~F.col("field").isin(*known))


def report(fields: DataFrame, known: Sequence[str] = KNOWN) -> DataFrame:
    """(field, kind, tickers, venues): each unknown field with the one type all its contents have (VARIANT if they differ)."""
    return unknown_fields(fields, known).groupBy("field").agg(
        F.schema_of_variant_agg("content").alias("kind"), F.count(F.lit(1)).alias("tickers"), F.countDistinct("exchange_id").alias("venues")
    )


def extras(fields: DataFrame, known: Sequence[str] = KNOWN) -> DataFrame:
    """(exchange_id, extraction_timestamp, symbol, extras): a ticker's unknown fields as a map to JSON text, to store beside its row."""
    # As many entries as a ticker has fields, each once: JSON objects with a name twice aren't parsed.
    entry = F.struct("field", F.to_json("content").alias("content"))
    kept = unknown_fields(fields, known).groupBy("exchange_id", "extraction_timestamp", "symbol")
    return kept.agg(F.map_from_entries(F.array_sort(F.collect_set(entry))).alias("extras"))
