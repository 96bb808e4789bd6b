"""Table contracts: the fixed shapes that every source and sink agrees on."""

from __future__ import annotations

import types as pytypes
import typing
from dataclasses import dataclass, field

from pyspark.sql import types as T

STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
DOUBLE, BOOL, TIMESTAMP = T.DoubleType(), T.BooleanType(), T.TimestampType()


def struct(*fields: tuple) -> T.StructType:
    """StructType from ``(name, type)`` or ``(name, type, nullable)`` tuples."""
    return T.StructType([T.StructField(*f) for f in fields])


@dataclass(frozen=True)
class Contract:
    """A named table shape with its natural key."""

    name: str
    namespace: str
    struct: T.StructType
    key: tuple[str, ...] = field(default=())

    @property
    def full_name(self) -> str:
        return f"{self.namespace}.{self.name}" if self.namespace else self.name

    @property
    def columns(self) -> list[str]:
        return self.struct.fieldNames()


# One ticker as the venues publish it. ``timestamp`` is text because venues send it as an
# integer, a float or a quoted number; ``flatten`` turns it into epoch milliseconds.
RAW_TICKER = struct(
    ("symbol", STRING),
    ("timestamp", STRING),
    ("datetime", STRING),
    ("last", DOUBLE),
    ("bid", DOUBLE),
    ("ask", DOUBLE),
    ("high", DOUBLE),
    ("low", DOUBLE),
    ("volume", DOUBLE),
    ("baseVolume", DOUBLE),
    ("quoteVolume", DOUBLE),
)

SNAPSHOT_METADATA = struct(("timestamp", STRING), ("exchange_id", STRING))

# The landed envelope. Unknown ticker fields are ignored by the JSON reader, missing ones are NULL.
SNAPSHOT = struct(
    ("metadata", SNAPSHOT_METADATA),
    ("data", T.MapType(STRING, RAW_TICKER)),
)

# Run metadata that travels with a landed snapshot; every value is text.
SIDECAR = struct(
    ("run_id", STRING),
    ("timestamp", STRING),
    ("dt", STRING),
    ("run_timestamp", STRING),
    ("run_dt", STRING),
    ("loaded", STRING),
)

TICKER = Contract(
    "raw_tickers",
    "crypto_data",
    struct(
        ("symbol", STRING, False),
        ("ticker_timestamp_ms", LONG),
        ("ticker_datetime", STRING),
        ("last", DOUBLE),
        ("bid", DOUBLE),
        ("ask", DOUBLE),
        ("high", DOUBLE),
        ("low", DOUBLE),
        ("volume", DOUBLE),
        ("base_volume", DOUBLE),
        ("quote_volume", DOUBLE),
        ("exchange_id", STRING, False),
        ("extraction_timestamp", LONG),
    ),
    ("exchange_id", "symbol", "extraction_timestamp"),
)

MANIFEST = Contract(
    "snapshot_manifest",
    "crypto_data",
    struct(
        ("snapshot_path", STRING),
        ("dataset", STRING),
        ("exchange_id", STRING),
        ("extraction_timestamp", LONG),
        ("run_id", STRING),
        ("run_timestamp", LONG),
        ("loaded", BOOL),
    ),
    ("dataset", "exchange_id", "extraction_timestamp"),
)

OHLCV = Contract(
    "ohlcv",
    "crypto_data",
    struct(
        ("timestamp", LONG),
        ("open", DOUBLE),
        ("high", DOUBLE),
        ("low", DOUBLE),
        ("close", DOUBLE),
        ("volume", DOUBLE),
        ("exchange", STRING),
        ("symbol", STRING),
    ),
    ("exchange", "symbol", "timestamp"),
)

PIPELINE_CONFIG = Contract(
    "pipeline_configs",
    "config",
    struct(
        ("id", STRING),
        ("exchange_id", STRING, False),
        ("enabled", BOOL),
        ("extract_asset_name", STRING),
        ("transform_asset_name", STRING),
        ("extract_group_name", STRING),
        ("transform_group_name", STRING),
        ("extract_io_manager_key", STRING),
        ("transform_io_manager_key", STRING),
        ("schedule_enabled", BOOL),
        ("schedule_cron", STRING),
        ("symbols", T.ArrayType(STRING)),
        ("fetch_all_tickers", BOOL),
        ("rate_limit_per_minute", INT),
        ("timeout_seconds", INT),
        ("config", STRING),
        ("description", STRING),
        ("created_at", TIMESTAMP),
        ("updated_at", TIMESTAMP),
        ("last_run_at", TIMESTAMP),
        ("priority", INT),
        ("retry_enabled", BOOL),
        ("max_retries", INT),
        ("tags", T.MapType(STRING, STRING)),
    ),
    ("exchange_id",),
)


def struct_from_annotations(annotations: dict[str, object]) -> T.StructType:
    """Column types from Python annotations: int, float and bool are typed, the rest is text.

    Of an optional annotation the first member counts, and every column is nullable.
    """
    known = {int: LONG, float: DOUBLE, bool: BOOL}
    fields = []
    for name, annotation in annotations.items():
        if isinstance(annotation, pytypes.UnionType) or typing.get_origin(annotation) is typing.Union:
            annotation = typing.get_args(annotation)[0]
        fields.append(T.StructField(name, known.get(annotation, STRING)))
    return T.StructType(fields)


def property_type(data_type: T.DataType) -> T.DataType:
    """Type a node-table property gets for a frame column; anything unlisted becomes text."""
    if isinstance(data_type, (T.LongType, T.IntegerType)):
        return LONG
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return DOUBLE
    if isinstance(data_type, (T.StringType, T.BooleanType, T.DateType, T.TimestampType)):
        return data_type
    if isinstance(data_type, T.TimestampNTZType):
        return TIMESTAMP
    return STRING
