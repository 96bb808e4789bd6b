"""Keep one row per key, without sorting or collecting the group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIXED_WIDTH = (
    T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType, T.FloatType,
    T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
)
_LONG_MIN = -(2**63)


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    """``pick`` is ``max_by`` or ``min_by``. Copies collapse before the shuffle, so a hot key is harmless.

    With one integer order and fixed-width values every column is its own aggregate, which Spark
    runs in a hash table; anything else travels as a struct through a sort-based aggregate. In both
    cases all columns come from the same row, because every column sees the same comparisons.
    """
    types = {f.name: f.dataType for f in df.schema}
    values = [c for c in df.columns if c not in keys]
    fixed = len(order) == 1 and isinstance(types[order[0]], (T.LongType, T.IntegerType))
    if fixed and all(isinstance(types[c], _FIXED_WIDTH) for c in values):
        rank = F.coalesce(F.col(order[0]).cast("bigint"), F.lit(_LONG_MIN))
        picked = df.groupBy(*keys).agg(*[pick(F.col(c), rank).alias(c) for c in values])
    else:
        rank = F.struct(*order)
        grouped = df.groupBy(*keys).agg(pick(F.struct(*values), rank).alias("_row"))
        picked = grouped.select(*keys, "_row.*")
    return picked.select(*df.columns)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` of each key."""
    return _one_per_key(df, keys, order, F.max_by)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the least ``order`` of each key."""
    return _one_per_key(df, keys, order, F.min_by)


