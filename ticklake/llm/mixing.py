"""Mixing sources to target weights by weighted fair queueing (operator 4).

Every document of a source waits in that source's queue, in an order shuffled by a hash of its id; the
queue may be run through up to ``max_repeats`` times. A document's virtual finish time is the number of
its source's tokens served when it is done, divided by the source's target. Merging all queues by finish
time and cutting where the total budget is used up gives the mix. The targets add up to the budget, so
the cut lies at virtual time 1; a document in service at that moment is served in part, as the fluid
model has it. No document is read twice: the share taken of each has a closed form in the tokens queued
before it, and what is range-sorted in the end is one row per document.

Tokens queued before a document are a prefix sum over its source, in two steps, so that a source of any
size is spread: sums of ``buckets`` hash ranges per source, offsets over these few rows, then a running
sum inside each bucket.

Edge cases: NULL text or no token: size 0, taken 0; NULL source: a source of its own, last in order; an
empty table gives an empty result; rows with one id twice are two documents, ordered by their size;
sources without a token have target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 256
SEED = "mix"


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space (NULL: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: DataFrame, share: float = 1.0, max_repeats: int = 3) -> DataFrame:
    """(source, source_size) with (source, weight) -> target per source.

    A source gets ``min(cap, weight * level)``, cap being ``max_repeats`` times its size, with the one
    level at which all sources together get ``share`` of all sizes. Sorted by cap / weight, the sources up
    to some place are capped, the others are not; the place is found with running sums over one row
    per source.
    """
    ranked = (
        sizes.join(weights, F.col("source").eqNullSafe(F.col("w_source")), "inner")
        .drop("w_source")
        .withColumn("cap", F.col("source_size") * max_repeats)
    )
    order = [(F.col("cap") / F.col("weight")).asc(), F.col("rank").asc()]
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        ranked.withColumn("capped", F.coalesce(F.sum("cap").over(upto), F.lit(0)))
        .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0)))
        .withColumn("budget", F.sum("source_size").over(every) * F.lit(share))
        .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open"))
        # The level holds for the first source that it doesn't fill.
        .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("chosen", F.min(F.when(F.col("fits"), F.struct((F.col("cap") / F.col("weight")).alias("r"), "rank", "level"))).over(every))
    )
    return level.select(
        "source",
        "source_size",
        F.when(F.col("source_size") == 0, F.lit(0.0))
        .otherwise(F.least(F.col("cap").cast("double"), F.col("weight") * F.col("chosen.level")))
        .alias("target"),
    )


def cycling_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, ... cycle, repeating, for the sources in code point order, NULL last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.select("source").withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.select(F.col("source").alias("w_source"), "rank", (F.pmod(F.col("rank") - 1, F.lit(cycle)) + 1).alias("weight"))


def mix(
    docs: DataFrame,
    weights=cycling_weights,
    share: float = 1.0,
    max_repeats: int = 3,
    buckets: int = BUCKETS,
    seed: str = SEED,
    carry: tuple[str, ...] = (),
    ordered: bool = True,
) -> DataFrame:
    """``docs`` with (doc_id, source, size) -> doc_id, source, size, source_size, target, taken, ``finish``, ``carry``.

    ``finish`` is the virtual time at which the document's first pass is done; rows are range-sorted by it, unless
    ``ordered`` is false.
    """
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = docs.select("doc_id", "source", "size", *carry, key.alias("_key")).withColumn(
        "_bucket", F.floor(F.conv(F.substring("_key", 1, 4), 16, 10).cast("int") * F.lit(buckets) / F.lit(1 << 16)).cast("int")
    )
    # An unlikely name for NULL sources keeps the joins plain; the flag keeps it apart from real ones.
    rows = rows.withColumn("_null", F.col("source").isNull()).withColumn("_source", F.coalesce("source", F.lit("")))
    sums = rows.groupBy("_source", "_null", "_bucket").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("_source", "_null").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    sizes = (
        sums.groupBy("_source", "_null")
        .agg(F.sum("_sum").alias("source_size"))
        .select(F.when(~F.col("_null"), F.col("_source")).alias("source"), "source_size")
    )
    wanted = targets(sizes, weights(sizes), share, max_repeats).select(
        F.coalesce("source", F.lit("")).alias("_source"), F.col("source").isNull().alias("_null"), "source_size", "target"
    )
    offsets = starts.select("_source", "_null", "_bucket", "_start").join(wanted, ["_source", "_null"])
    inside = (
        Window.partitionBy("_source", "_null", "_bucket")
        .orderBy("_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    queued = (
        rows.withColumn("_upto", F.sum("size").over(inside))
        .join(offsets, ["_source", "_null", "_bucket"])
        .withColumn("_before", F.col("_start") + F.col("_upto") - F.col("size"))
    )
    served = F.floor("target")
    taken = sum(
        (
            F.greatest(F.lit(0), F.least(F.col("size"), served - F.lit(i) * F.col("source_size") - F.col("_before")))
            for i in range(max_repeats)
        ),
        F.lit(0),
    )
    mixed = queued.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
        F.when(F.col("target") > 0, (F.col("_before") + F.col("size")) / F.col("target")).alias("finish"),
        *carry,
    )
    return mixed.repartitionByRange("finish").sortWithinPartitions("finish") if ordered else mixed


def expanded(docs: DataFrame, weights=cycling_weights, share: float = 1.0, max_repeats: int = 3) -> DataFrame:
    """The mix of ``docs`` with (doc_id, text, source and more) as rows in the order of service.

    Documents come as whole copies, as many as their share taken rounds to; columns stay as they are.
    """
    row = F.struct(*[F.col(c) for c in docs.columns])
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), row.alias("_row"))
    # Sorted once, below, by the time of each pass.
    mixed = mix(sized, weights, share, max_repeats, carry=("_row",), ordered=False)
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    passes = F.explode(F.sequence(F.lit(0), copies - 1)).alias("_pass")
    served = mixed.filter((F.col("size") > 0) & (copies > 0)).select("_row", "finish", "source_size", "target", passes)
    time = F.col("finish") + F.col("_pass") * F.col("source_size") / F.col("target")
    return served.withColumn("_time", time).repartitionByRange("_time").sortWithinPartitions("_time").select("_row.*")
