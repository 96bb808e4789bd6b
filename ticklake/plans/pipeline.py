"""The two scheduled jobs: extract (ticks -> lake) and transform (lake -> table)."""

from __future__ import annotations

from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ticklake.operators.backlog import backlog
from ticklake.operators.configs import configured_ticks
from ticklake.operators.envelope import SNAPSHOT_KEY, envelopes
from ticklake.operators.flatten import transform
from ticklake.operators.loaded_index import backlog_indexed
from ticklake.operators.writers import TickerTable
from ticklake.session import existing, stored
from ticklake.sources import files, planned
from ticklake.sources.lake import CORRUPT, VERSION_KEY, SnapshotLake


def extract(ticks: DataFrame, lake: SnapshotLake, dataset: str, run_id: str, run_timestamp: int) -> None:
    """Land the ticks' snapshots."""
    lake.land(envelopes(ticks), dataset, run_id, run_timestamp, keys=ticks.select(*SNAPSHOT_KEY))


def extract_configured(
    ticks: DataFrame, configs: DataFrame, lake: SnapshotLake, dataset: str, run_id: str, run_timestamp: int
) -> None:
    """Land what the pipeline configuration asks for: enabled venues, all or listed symbols."""
    extract(configured_ticks(ticks, stored(configs, "configs")), lake, dataset, run_id, run_timestamp)


def load_backlog(
    lake: SnapshotLake,
    table: TickerTable,
    load_id: str,
    style: str = "objects",
    by_flag: bool = False,
    recorded_at: int | None = None,
    on_corrupt: str = "quarantine",
    watch: Observation | None = None,
) -> DataFrame:
    """Load what is missing: choose, transform, commit, and only then mark what was read.

    Landed lines are read and parsed once, by the write itself, which also counts them (``watch`` gets ``load_counts``). Only
    where the counts tell that lines are broken or snapshots absent, or come in parts, are they looked at again.

    Returns the manifest rows that were loaded. A run that failed is repeated with its ``load_id``:
    it takes the same snapshots again and replaces the rows it may have written. Landed lines that cannot be
    read are set aside (``on_corrupt="quarantine"``) or stop the load before anything is written (``"fail"``);
    their snapshots, and those whose folder is gone, stay unmarked. An ``indexed`` table answers the full-history
    strategy (``style="files"``) by its index.
    """
    if table.indexed and style == "files" and not by_flag:
        wanted = backlog_indexed(lake.manifest(), table.loaded_index())
    else:
        target = None if by_flag else (table.recent() if style == "objects" else table.read())
        wanted = backlog(lake.manifest(), target, style)
    chosen = lake.plan(load_id, wanted)
    if on_corrupt == "fail":
        broken, _ = _judged(lake.scan(chosen))
        if not broken.isEmpty():
            raise ValueError(f"Load {load_id}: landed lines cannot be read, {broken.count()} of them")
    watch = watch or Observation()
    scanned = lake.scan(chosen).observe(watch, *load_counts())
    table.append(transform(scanned.filter(F.col(CORRUPT).isNull()).select("metadata", "data")), load_id)
    expected = chosen.agg(F.count(F.lit(1)).alias("lines"), _names()).first()
    counted = counts_of(watch)
    if (counted["lines"], counted["names"]) == (expected["lines"], expected["names"]):
        # One readable line for each snapshot, as usual: nothing is read a second time.
        loaded = chosen
    else:
        broken, whole = _judged(lake.scan(chosen))
        if not broken.isEmpty():
            lake.set_aside(broken, load_id)
        same = [F.col(f"c.{c}").eqNullSafe(F.col(f"s.{c}")) for c in VERSION_KEY]
        loaded = chosen.alias("c").join(whole.alias("s"), reduce(and_, same), "left_semi")
    lake.mark_loaded(loaded, recorded_at)
    return loaded


def _names() -> Column:
    """A sum that two sets of snapshots, each once, only share if they are the same, but for one chance in 10^18."""
    return F.sum(F.xxhash64(*VERSION_KEY).cast("decimal(20,0)")).alias("names")


def load_counts() -> list[Column]:
    """What a load observes of the lines it reads: readable ones, broken ones, symbols, and which snapshots."""
    good = F.col(CORRUPT).isNull()
    name = F.when(good, F.xxhash64(*VERSION_KEY).cast("decimal(20,0)"))
    return [
        F.count_if(good).alias("lines"),
        F.count_if(~good).alias("broken"),
        F.coalesce(F.sum(F.when(good, F.size("data"))), F.lit(0)).alias("symbols"),
        F.sum(name).alias("names"),
    ]


def counts_of(watch: Observation) -> dict[str, object]:
    """What a load counted. Where there was nothing to read Spark drops the step that counts, and all counts are 0."""
    try:
        return watch.get
    except Py4JJavaError:
        return {"lines": 0, "broken": 0, "symbols": 0, "names": None}


def _judged(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(broken lines, whole snapshots) of a scan, written down, as both are used."""
    # With the data in view, so that a line is judged here as it is where rows are made.
    seen = stored(scanned.select(*VERSION_KEY, CORRUPT, F.size("data").alias("symbols")).distinct(), "seen")
    return seen.filter(F.col(CORRUPT).isNotNull()), seen.filter(F.col(CORRUPT).isNull())


def load_one(
    spark: SparkSession,
    lake: SnapshotLake,
    dataset: str,
    exchange_id: str,
    extraction_timestamp: int,
) -> DataFrame:
    """Ticker rows of one given snapshot."""
    return transform(lake.snapshot(dataset, exchange_id, extraction_timestamp))


def load_files(
    spark: SparkSession,
    root: str,
    table: TickerTable,
    load_id: str,
    state: str,
    style: str = "files",
    by_flag: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """Load the snapshot files below ``root`` that other programs wrote and that are not loaded yet.

    Files are listed once, paired with their sidecars and chosen by flag or by the table; only the chosen are read, by
    the tasks that hold their rows of the plan. Names may hold blanks, percent signs, brackets, any letters.
    Sidecars belong to their writers: what was loaded is noted below ``state``, and a note overrules a sidecar.
    Unreadable files are set aside there. Returns the files that were loaded; as with ``load_backlog`` a
    repeated ``load_id`` takes the same files again.
    """
    notes = f"{state}/loaded"
    there, _ = existing(spark, [notes])
    known = spark.read.schema("file_path string").parquet(notes) if there else spark.createDataFrame([], "file_path string")
    noted = known.distinct().withColumn("noted", F.lit(True))
    manifest = files.snapshot_manifest(spark, root, multi_line=multi_line).join(noted, "file_path", "left")
    manifest = manifest.withColumn("loaded", F.when(F.col("noted"), "true").otherwise(F.col("loaded"))).drop("noted")
    plan = f"{state}/plans/load_id={load_id}"
    if not existing(spark, [plan])[0]:
        planned.write_plan(backlog(manifest, None if by_flag else table.read(), style), plan)
    chosen = spark.read.schema(manifest.schema).parquet(plan)
    good, bad = files.split_corrupt(files.read_planned(spark, plan, multi_line=multi_line))
    table.append(transform(good.select("metadata", "data")), load_id)
    bad.write.mode("overwrite").parquet(f"{state}/quarantine/load_id={load_id}")
    loaded = stored(chosen.join(good.select("file_path").distinct(), "file_path", "left_semi"), "loaded")
    loaded.select("file_path").write.mode("overwrite").parquet(f"{notes}/load_id={load_id}")
    return loaded
