"""Exact duplicates by sorting whole texts (operator 9; DataFrame functions only).

Texts are normalised, dealt out by sampled splitters (``repartitionByRange``), sorted on disk where memory is
short, and each run of neighbours that are equal in full forms a group. The sort order is the first bytes,
a hash, then the whole text: splitters, which the driver sees, hold only the first two.

A text that is very common would make one partition too large. Such texts are found by a count of
64-bit hashes: those above a 1/(4 n) share of the rows, of which there are fewer than 4 n. They are
sorted as ``SALTS`` sub-runs, and the sub-runs' results, one row each, are merged afterwards. Two texts
that share a hash only get the same treatment; equality is always decided on whole texts.

Edge cases: NULL text counts as empty; NULL ids lose against all others and the group of ids that are all
NULL has a NULL ``keep_id`` and keeps one row; of repeated rows with one id, one is kept; an empty table
gives an empty result; further columns are carried unless they have a name of the result's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64
HEAD = 16  # characters of a text that splitters are made of, besides its hash
RESULT = ("keep_id", "group_size", "kept", "text_sha256")


def unchanged(text: Column) -> Column:
    return text


def groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    normalise: Callable[[Column], Column] = unchanged,
    keep: str = "largest",
    with_text: bool = False,
) -> DataFrame:
    """All rows, each with its group's kept id, the group's size, ``kept`` and the digest of the normalised text.

    The text itself, normalised, only comes along ``with_text``.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    carried = [c for c in docs.columns if c not in (id_column, text_column, *RESULT)]
    rows = docs.select(
        F.col(id_column).alias("_id"),
        F.coalesce(normalise(F.col(text_column)), F.lit("")).alias("_text"),
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carried)],
    )
    total = docs.count()
    hot = (
        rows.groupBy(F.xxhash64("_text").alias("_hash"))
        .count()
        .filter(F.col("count") * (4 * parts) > total)
        .select("_hash", F.lit(True).alias("_hot"))
    )
    # Fewer than 4 * parts rows of 17 bytes, whatever the table holds.
    salted = rows.withColumn("_hash", F.xxhash64("_text")).join(F.broadcast(hot), "_hash", "left")
    salted = salted.withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64("_id"), F.lit(SALTS))).otherwise(F.lit(-1)))
    order = F.desc_nulls_last("_id") if keep == "largest" else F.asc_nulls_last("_id")
    run = Window.partitionBy("_head", "_hash", "_text", "_salt").orderBy(order)
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = (
        salted.drop("_hot")
        .withColumn("_head", F.substring("_text", 1, HEAD))
        .repartitionByRange(parts, "_head", "_hash", "_salt")
        .withColumn("_at", F.row_number().over(run))
        .withColumn("_keep", F.first("_id").over(whole))
        .withColumn("_size", F.count(F.lit(1)).over(whole))
        .withColumn("text_sha256", F.sha2("_text", 256))
        .drop("_head", "_hash")
    )
    if not with_text:
        runs = runs.drop("_text")
    pick = F.max if keep == "largest" else F.min
    merged = (
        runs.filter((F.col("_salt") >= 0) & (F.col("_at") == 1))
        .groupBy("text_sha256")
        .agg(pick("_keep").alias("_all_keep"), F.sum("_size").alias("_all_size"))
        .withColumn("_merged", F.lit(True))
    )
    # One row per hot text: fewer than 4 * parts rows of a digest and two numbers.
    out = runs.join(F.broadcast(merged), "text_sha256", "left")
    keep_id = F.when(F.col("_merged"), F.col("_all_keep")).otherwise(F.col("_keep"))
    # Rows of one id share a sub-run; ids that are all NULL as well.
    return out.select(
        F.col("_id").alias(id_column),
        keep_id.alias("keep_id"),
        F.coalesce("_all_size", "_size").alias("group_size"),
        (keep_id.eqNullSafe(F.col("_id")) & (F.col("_at") == 1)).alias("kept"),
        "text_sha256",
        *([F.col("_text").alias(text_column)] if with_text else []),
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carried)],
    )


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were; of rows that agree in id and text one stays.

    A NULL text that stays is returned as NULL.
    """
    names = [c for c in docs.columns if c not in (id_column, text_column)]
    packed = docs.select(id_column, text_column, F.struct(F.col(text_column).isNull().alias("_null"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(names)]).alias("_row"))
    kept = groups(packed, id_column, text_column, keep=keep, with_text=True).filter("kept")
    text = F.when(~F.col("_row._null"), F.col(text_column))
    back = {id_column: F.col(id_column), text_column: text} | {c: F.col(f"_row._{i}") for i, c in enumerate(names)}
    return kept.select(*[back[c].alias(c) for c in docs.columns])
