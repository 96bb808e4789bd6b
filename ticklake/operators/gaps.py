"""Polls that are missing: gaps between a venue's snapshots at the cadence they are expected with."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.functions.times import DAY_MS
from ticklake.operators.backlog import stamped


def missing_polls(snapshots: DataFrame, cadence_ms: int, block_ms: int = DAY_MS) -> DataFrame:
    """(exchange_id, gap_start, gap_end, missing): each run of expected instants without a snapshot.

    Instants count for the slot of ``cadence_ms`` they fall into; start and end are the first and the last slot that is empty,
    between a venue's first and last snapshot. A venue is looked at in blocks of ``block_ms``, inside of which slots
    are sorted; between blocks only their edges meet, one row a block. So a venue with most of the history is
    many sorts, not one. Snapshots without a venue or an instant are left out.
    """
    slot = F.expr(f"floor(extraction_timestamp / {cadence_ms})").cast("bigint")
    known = stamped(snapshots).filter(F.col("exchange_id").isNotNull())
    slots = known.select("exchange_id", slot.alias("slot")).distinct()
    per_block = max(1, block_ms // cadence_ms)
    blocks = slots.withColumn("block", F.expr(f"floor(slot / {per_block})").cast("bigint"))
    inside = Window.partitionBy("exchange_id", "block").orderBy("slot")
    within = blocks.select("exchange_id", F.lag("slot").over(inside).alias("before"), "slot")
    edges = blocks.groupBy("exchange_id", "block").agg(F.min("slot").alias("first"), F.max("slot").alias("last"))
    along = Window.partitionBy("exchange_id").orderBy("block")
    between = edges.select("exchange_id", F.lag("last").over(along).alias("before"), F.col("first").alias("slot"))
    steps = within.unionByName(between).filter(F.col("slot") - F.col("before") > 1)
    return steps.select(
        "exchange_id",
        ((F.col("before") + 1) * cadence_ms).alias("gap_start"),
        ((F.col("slot") - 1) * cadence_ms).alias("gap_end"),
        (F.col("slot") - F.col("before") - 1).alias("missing"),
    )
