"""Which landed snapshots are not yet in the target table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.times import HOUR_MS

KEY = ["exchange_id", "extraction_timestamp"]
LOOKBACK_MS = 6 * HOUR_MS


def stamped(manifest: DataFrame) -> DataFrame:
    """Snapshots with a usable instant; only these can be compared with a table."""
    return manifest.filter(F.col("extraction_timestamp").isNotNull())


def unstamped(manifest: DataFrame) -> DataFrame:
    """The others, for quarantine: a NULL never matches a join key, so they would reload forever."""
    return manifest.filter(F.col("extraction_timestamp").isNull())


def loaded_timestamps(target: DataFrame, exchange_id: str | None = None) -> DataFrame:
    """Distinct (venue, instant) pairs of a table, of one venue or of all at once.

    NULL keys match nothing, so they are left out here; that also makes all uses of the pairs in
    one plan alike, and Spark then computes them once.
    """
    rows = stamped(target).filter(F.col("exchange_id").isNotNull())
    if exchange_id is not None:
        rows = rows.filter(F.col("exchange_id") == exchange_id)
    return rows.select(*KEY).distinct()


def per_venue(pairs: DataFrame, value: Column) -> DataFrame:
    """One aggregate per venue, as a shuffled result of its own.

    Snapshots are joined to it by venue, and one venue may hold most of them. With its own shuffle
    the size of this side is known before the join runs: Spark broadcasts it when it is small, so
    the other side stays where it is, and otherwise splits the hot venue.
    """
    return pairs.groupBy("exchange_id").agg(value).hint("rebalance")


def recent_loaded(loaded: DataFrame, lookback_ms: int = LOOKBACK_MS) -> DataFrame:
    """Loaded instants strictly newer than the venue's newest one minus the lookback."""
    newest = per_venue(loaded, F.max("extraction_timestamp").alias("newest"))
    return (
        loaded.join(newest, "exchange_id")
        .filter(F.col("extraction_timestamp") > F.col("newest") - lookback_ms)
        .select(*KEY)
    )


def backlog_full(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Everything whose instant is not loaded."""
    return stamped(manifest).join(loaded, KEY, "left_anti")


def backlog_lookback(manifest: DataFrame, loaded: DataFrame, lookback_ms: int = LOOKBACK_MS) -> DataFrame:
    """Not loaded, and newer than the oldest instant of the lookback window.

    A venue with nothing loaded has no window and contributes everything. The anti join may use
    the whole loaded set: whatever passes the floor and is loaded lies inside the window.
    """
    floor = per_venue(recent_loaded(loaded, lookback_ms), F.min("extraction_timestamp").alias("floor"))
    fresh = F.col("floor").isNull() | (F.col("extraction_timestamp") > F.col("floor"))
    return (
        stamped(manifest)
        .join(floor, "exchange_id", "left")
        .filter(fresh)
        .select(*manifest.columns)
        .join(loaded, KEY, "left_anti")
    )


def backlog_flag(manifest: DataFrame, style: str = "objects") -> DataFrame:
    """By the load flag alone. A text flag follows the store: objects want ``false``, files not ``true``."""
    flag = F.col("loaded")
    if dict(manifest.dtypes)["loaded"] == "boolean":
        return manifest.filter(~F.coalesce(flag, F.lit(False)))
    text = F.lower(F.coalesce(flag, F.lit("false")))
    return manifest.filter(text == "false" if style == "objects" else text != "true")


def backlog(manifest: DataFrame, target: DataFrame | None = None, style: str = "objects") -> DataFrame:
    """Pick the strategy: no table -> flags; objects -> lookback; files -> full history.

    A venue the table does not know yet gets all its snapshots under either table strategy.
    """
    if target is None:
        return backlog_flag(manifest, style)
    loaded = loaded_timestamps(target)
    return backlog_lookback(manifest, loaded) if style == "objects" else backlog_full(manifest, loaded)


def load_rows(records: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of the chosen snapshots, all of them: copies across snapshots are not merged.

    Hand in ``chosen`` as a stored table. Its size is then known when the join is planned, so a
    small backlog is broadcast and the records are not shuffled.
    """
    return records.join(chosen.select(*KEY), KEY, "left_semi")
