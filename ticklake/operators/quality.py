"""Row rules, their report, the pass/quarantine split, duplicates and freshness."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.contracts import TICKER
from ticklake.operators.reduce import latest_by


@dataclass(frozen=True)
class Rule:
    """A named SQL condition. A row passes when it is true; NULL counts as a violation."""

    name: str
    condition: str

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def required(column: str) -> Rule:
    return Rule(f"{column}_present", f"{column} IS NOT NULL")


def positive(column: str) -> Rule:
    return Rule(f"{column}_positive", f"{column} > 0")


def not_negative(column: str) -> Rule:
    return Rule(f"{column}_not_negative", f"{column} >= 0")


def numeric(column: str) -> Rule:
    """Text that must hold a number."""
    return Rule(f"{column}_numeric", f"try_cast({column} AS DOUBLE) IS NOT NULL")


def optional(rule: Rule, column: str) -> Rule:
    """The rule, for rows where the column has a value."""
    return Rule(rule.name, f"{column} IS NULL OR {rule.condition}")


TICKER_RULES = (
    required("symbol"),
    required("exchange_id"),
    required("extraction_timestamp"),
    positive("last"),
    required("bid"),
    required("ask"),
    optional(positive("low"), "low"),
    Rule("bid_below_ask", "bid IS NULL OR ask IS NULL OR bid <= ask"),
    optional(not_negative("base_volume"), "base_volume"),
)

CANDLE_RULES = (
    required("timestamp"),
    positive("open"),
    positive("high"),
    positive("low"),
    positive("close"),
    not_negative("volume"),
)


def check(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows with one boolean column per rule."""
    return rows.select("*", *[rule.passes().alias(rule.name) for rule in rules])


def report(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Checked rows and violations per rule, from one aggregate."""
    counted = rows.agg(
        F.count(F.lit(1)).alias("checked"),
        *[F.count_if(~rule.passes()).alias(rule.name) for rule in rules],
    )
    return counted.unpivot("checked", [rule.name for rule in rules], "rule", "violations")


def with_violations(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows with the names of the rules they break, in rule order."""
    names = F.array(*[F.when(~rule.passes(), F.lit(rule.name)) for rule in rules])
    return rows.withColumn("violations", F.filter(names, lambda name: name.isNotNull()))


PASSED, QUARANTINED = "passed", "quarantined"


def with_state(rows: DataFrame, rules: Sequence[Rule], state: str = "state") -> DataFrame:
    """Rows with the names of the rules they break, and whether they pass everything."""
    passed = F.when(F.size("violations") == 0, PASSED).otherwise(QUARANTINED)
    return with_violations(rows, rules).withColumn(state, passed)


def split(rows: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass everything, the others with the names of the broken rules)."""
    judged = with_state(rows, rules, "_state")
    passed = judged.filter(F.col("_state") == PASSED).drop("violations", "_state")
    return passed, judged.filter(F.col("_state") == QUARANTINED).drop("_state")


def dedup_latest(
    rows: DataFrame, order: Sequence[str], keys: Sequence[str] = TICKER.key
) -> DataFrame:
    """One row per natural key, the last by ``order``."""
    return latest_by(rows, list(keys), list(order))


def freshness(rows: DataFrame, at_ms: int | Column, stale_after_ms: int) -> DataFrame:
    """Per venue: newest instant, its age at ``at_ms``, and whether that is too old."""
    at = at_ms if isinstance(at_ms, Column) else F.lit(at_ms)
    newest = rows.groupBy("exchange_id").agg(F.max("extraction_timestamp").alias("newest_ms"))
    age = at - F.col("newest_ms")
    return newest.select("exchange_id", "newest_ms", age.alias("age_ms"), (age > stale_after_ms).alias("stale"))
