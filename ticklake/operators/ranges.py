"""Limits for prices from their own history: quantile sketches per symbol and day that merge.

A day's sketch is made once and kept; the history of a symbol is its days' sketches merged, so limits move on without a second
look at old rows. Sketches keep all values of a symbol while there are at most ``EXACT`` of them, and its quantiles are
exact then; beyond that their rank is off by at most about 1.7 percent at ``SIZE``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.times import utc_date

SIZE = 200
EXACT = 200
SERIES = ["exchange_id", "symbol"]


def day_sketches(rows: DataFrame, value: str = "last", size: int = SIZE) -> DataFrame:
    """(exchange_id, symbol, date, sketch, values): a sketch of each symbol's values by day; NULLs and NaN are no values."""
    usable = F.col(value).isNotNull() & ~F.isnan(value)
    kept = rows.filter(usable).withColumn("date", utc_date(F.col("extraction_timestamp")))
    sketch = F.kll_sketch_agg_double(F.col(value), F.lit(size)).alias("sketch")
    return kept.groupBy(*SERIES, "date").agg(sketch, F.count(F.lit(1)).alias("values"))


def limits(sketches: DataFrame, low: float = 0.01, high: float = 0.99, slack: float = 0.5, size: int = SIZE) -> DataFrame:
    """(exchange_id, symbol, least, most, values): the quantiles of all days, moved apart by ``slack`` of what lies between them."""
    merged = sketches.groupBy(*SERIES).agg(F.kll_merge_agg_double(F.col("sketch"), F.lit(size)).alias("sketch"), F.sum("values").alias("values"))
    at = {name: F.kll_sketch_get_quantile_double(F.col("sketch"), F.lit(q).cast("double")) for name, q in (("low", low), ("high", high))}
    found = merged.select(*SERIES, at["low"].alias("low"), at["high"].alias("high"), "values")
    room = (F.col("high") - F.col("low")) * slack
    return found.select(*SERIES, (F.col("low") - room).alias("least"), (F.col("high") + room).alias("most"), "values")


def outside(value: Column, least: Column, most: Column) -> Column:
    """Whether a value breaks its symbol's limits; a symbol without history has none, and NULL breaks none."""
    return F.coalesce((value < least) | (value > most), F.lit(False))


def judged(rows: DataFrame, known: DataFrame, value: str = "last") -> DataFrame:
    """``rows`` with ``out_of_range``, by the limits of their symbols."""
    bounds = known.select(*SERIES, F.col("least").alias("_least"), F.col("most").alias("_most"))
    met = rows.join(bounds, SERIES, "left")
    return met.withColumn("out_of_range", outside(F.col(value), F.col("_least"), F.col("_most"))).drop("_least", "_most")
