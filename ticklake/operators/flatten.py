"""Snapshots -> rows of the ticker contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.contracts import SNAPSHOT, TICKER
from ticklake.functions.times import epoch_ms_of

# Venue field names on the left, contract names on the right.
RENAMES = {
    "timestamp": "ticker_timestamp_ms",
    "datetime": "ticker_datetime",
    "baseVolume": "base_volume",
    "quoteVolume": "quote_volume",
}
INSTANTS = ("ticker_timestamp_ms", "extraction_timestamp")
DROPPABLE = ("ticker_timestamp_ms", "ticker_datetime")


def parse_json_text(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON text -> ``(metadata, data)``; unknown fields are ignored, missing ones are NULL."""
    parsed = lines.select(F.from_json(column, SNAPSHOT).alias("snapshot"))
    return parsed.select("snapshot.metadata", "snapshot.data")


def is_snapshot(df: DataFrame) -> bool:
    types = {f.name: f.dataType for f in df.schema}
    return isinstance(types.get("metadata"), T.StructType) and isinstance(types.get("data"), T.MapType)


def flatten(snapshots: DataFrame) -> DataFrame:
    """One row per (snapshot, symbol) with the snapshot's provenance.

    The symbol inside the ticker wins; where it is missing or NULL the map key stands in.
    """
    metadata = snapshots.schema["metadata"].dataType
    ticker_fields = snapshots.schema["data"].dataType.valueType.fieldNames()

    def provenance(name: str) -> Column:
        return F.col(f"metadata.{name}") if name in metadata.fieldNames() else F.lit(None)

    if "timestamp" in metadata.fieldNames():
        extracted = epoch_ms_of("metadata.timestamp", metadata["timestamp"].dataType)
    else:
        extracted = F.lit(None).cast("bigint")
    exploded = snapshots.select(
        provenance("exchange_id").cast("string").alias("exchange_id"),
        extracted.alias("extraction_timestamp"),
        F.explode("data").alias("key", "ticker"),
    )
    inner = F.col("ticker.symbol") if "symbol" in ticker_fields else F.lit(None)
    return exploded.select(
        F.coalesce(inner, F.col("key")).alias("symbol"),
        *[F.col(f"ticker.`{name}`") for name in ticker_fields if name != "symbol"],
        "exchange_id",
        "extraction_timestamp",
    )


def as_records(df: DataFrame) -> DataFrame:
    """Accept nested snapshots or rows that are flat already; any other shape is an error."""
    if is_snapshot(df):
        return flatten(df)
    if "symbol" in df.columns:
        return df
    raise ValueError(f"Neither a snapshot nor ticker rows: {df.schema.simpleString()}")


def union_records(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by name; columns only some of the frames have are NULL for the rest."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Project to a table's columns: extras dropped, missing ones NULL, order and types as declared."""
    have = {f.name: f.dataType for f in df.schema}

    def column(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        nested = isinstance(have[f.name], (T.StructType, T.MapType, T.ArrayType))
        if nested and isinstance(f.dataType, T.StringType):
            return F.to_json(f.name).alias(f.name)
        if have[f.name] == f.dataType:
            return F.col(f.name)
        return F.col(f.name).cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in target])


def to_tickers(records: DataFrame) -> DataFrame:
    """Keep the known columns, rename them, normalise instants, null-fill what is absent."""
    renamed = records.withColumnsRenamed(RENAMES)
    types = {f.name: f.dataType for f in renamed.schema}
    kept = [
        epoch_ms_of(c, types[c]).alias(c) if c in INSTANTS else F.col(c)
        for c in TICKER.columns
        if c in types
    ]
    return conform(renamed.select(*kept), TICKER.struct)


def transform(df: DataFrame) -> DataFrame:
    """Snapshots (or flat rows) -> ticker contract, for every venue alike."""
    return to_tickers(as_records(df))


def empty_tickers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TICKER.struct)


def non_null_counts(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """One row: non-NULL values per column, and ``row_count``."""
    return df.agg(*[F.count(c).alias(c) for c in columns], F.count(F.lit(1)).alias("row_count"))


def drop_all_null(df: DataFrame, columns: tuple[str, ...] = DROPPABLE) -> DataFrame:
    """Drop those of ``columns`` that hold no value at all.

    The output schema depends on the data, so this runs one aggregate first; it reads only
    ``columns``. Streams must not use it.
    """
    present = [c for c in columns if c in df.columns]
    counts = non_null_counts(df, present).first()
    return df.drop(*[c for c in present if counts[c] == 0])


def with_mismatch(rows: DataFrame, configured_exchange: str) -> DataFrame:
    """Flag rows whose venue is not the configured one; they are kept."""
    differs = F.col("exchange_id").isNotNull() & (F.col("exchange_id") != F.lit(configured_exchange))
    return rows.withColumn("exchange_mismatch", differs)

