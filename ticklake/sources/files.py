"""Scans of snapshot files that other programs wrote: one JSON object per file, or JSON lines."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.contracts import SIDECAR, SNAPSHOT, STRING
from ticklake.functions import paths
from ticklake.functions.times import truncated_ms
from ticklake.session import existing, scratch_dir
from ticklake.sources import planned

CORRUPT = "_corrupt_record"


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _scan(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    glob: str,
    multi_line: bool,
    on_missing: str,
    on_corrupt: str,
) -> DataFrame:
    reader = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("ignoreMissingFiles", on_missing == "empty")
    )
    source = paths.plain_path(F.col("_metadata.file_path")).alias("file_path")
    if on_missing == "empty":
        path, _ = existing(spark, [path] if isinstance(path, str) else path)
        if not path:
            extra = [CORRUPT, "file_path"] if on_corrupt == "quarantine" else ["file_path"]
            return spark.createDataFrame([], T.StructType([*schema.fields, *[T.StructField(c, STRING) for c in extra]]))
    if on_corrupt == "quarantine":
        # Parsed from text, since a JSON scan refuses to filter on the corrupt text alone.
        return parsed(reader.text(path, wholetext=multi_line).select("value", source), schema)
    strict = reader.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST")
    return strict.json(path).select("*", source)


def parsed(text: DataFrame, schema: T.StructType) -> DataFrame:
    """(value, file_path) as the schema's fields, the text of what can't be read, and the path."""
    with_text = T.StructType([*schema.fields, T.StructField(CORRUPT, STRING)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    fields = F.from_json("value", with_text, options).alias("parsed")
    return text.select(fields, "file_path").select("parsed.*", "file_path")


def read_planned(spark: SparkSession, plan: str, *, multi_line: bool = True) -> DataFrame:
    """The snapshot files that a plan names, unreadable ones as text, as with ``on_corrupt="quarantine"``.

    Tasks open the files themselves, by the names that ``list_files`` gave; a file that is gone since is left out.
    """
    return parsed(planned.read_plan(spark, plan, lines=not multi_line).filter("NOT missing"), SNAPSHOT)


def read_snapshots(
    spark: SparkSession,
    path: str | list[str],
    *,
    multi_line: bool = True,
    on_missing: str = "empty",
    on_corrupt: str = "fail",
    glob: str = "*.json",
) -> DataFrame:
    """All snapshot files below ``path`` as ``(metadata, data, file_path)``; sidecars are left out.

    ``on_missing``: ``empty`` for a backlog, where each absent path is left out and the others are read
    (``skipped`` names them), ``error`` for one given snapshot. ``on_corrupt``:
    ``fail``, or ``quarantine`` to keep the text of unreadable records in ``_corrupt_record``.
    ``multi_line`` reads one object per file, each in one task; JSON lines are split instead.
    """
    found = _scan(spark, path, SNAPSHOT, glob, multi_line, on_missing, on_corrupt)
    return found.filter(~paths.is_sidecar(F.col("file_path")))


def skipped(spark: SparkSession, names: list[str]) -> list[str]:
    """Those of the paths that a backlog would leave out because nothing is there."""
    return existing(spark, names)[1]


def split_corrupt(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable, unreadable) parts of a scan made with ``on_corrupt="quarantine"``."""
    good = scanned.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = scanned.filter(F.col(CORRUPT).isNotNull()).select("file_path", CORRUPT)
    return good, bad


def read_sidecars(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Run metadata files below ``path``; an unreadable one keeps NULL fields, so it counts as unloaded."""
    return _sidecars(list_files(spark, path, f"*{paths.SIDECAR_SUFFIX}"), multi_line)


def _sidecars(listed: DataFrame, multi_line: bool) -> DataFrame:
    spark = listed.sparkSession
    plan = scratch_dir(spark, "sidecars")
    planned.write_plan(listed.select("file_path"), plan)
    scanned = parsed(planned.read_plan(spark, plan, lines=not multi_line).filter("NOT missing"), SIDECAR)
    return scanned.withColumn("extraction_timestamp", truncated_ms(F.col("timestamp")))


def pair(data_files: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Data files with their sidecars, matched by name; a file without a sidecar stays, with NULLs."""
    key = paths.pairing_key(F.col("file_path")).alias("pairing_key")
    left = data_files.select("file_path", key)
    right = sidecars.select(*[c for c in sidecars.columns if c != "file_path"], key)
    return left.join(right, "pairing_key", "left").drop("pairing_key")


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Names, sizes and times of the files below the folder ``path``, which is no pattern; contents are not read."""
    schema = "file_path string, length long, modified_at timestamp"
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
    )
    try:
        found = reader.load(paths.literal(path))
    except AnalysisException as error:
        if _missing(error):
            return spark.createDataFrame([], schema)
        raise
    name = F.regexp_replace("path", "^file:/+", "file:/").alias("file_path")
    return found.select(name, "length", F.col("modificationTime").alias("modified_at"))


def snapshot_manifest(spark: SparkSession, root: str, *, multi_line: bool = True) -> DataFrame:
    """Data files below ``root`` with what is known of them: path, venue, instant, run and load flag.

    The venue is the first folder below ``root``. The instant comes from the sidecar, or from the name where
    there is none. Only names are listed and sidecars read, no data file.
    """
    listed = list_files(spark, root, "*.json").select("file_path")
    beside = paths.is_sidecar(F.col("file_path"))
    paired = pair(listed.filter(~beside), _sidecars(listed.filter(beside), multi_line))
    named = F.regexp_extract("file_path", r"_(\d+)\.json$", 1)
    below = F.regexp_extract("file_path", r"\Q" + root.rstrip("/").removeprefix("file:").lstrip("/") + r"\E/([^/]+)/", 1)
    return paired.select(
        "file_path",
        F.nullif(below, F.lit("")).alias("exchange_id"),
        F.coalesce("extraction_timestamp", F.try_to_number(named, F.lit("9" * 18)).cast("bigint")).alias("extraction_timestamp"),
        "run_id",
        "loaded",
    )
