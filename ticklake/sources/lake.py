"""The snapshot lake: landed envelopes and the manifest that says which are loaded."""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.contracts import LONG, MANIFEST, SNAPSHOT, STRING
from ticklake.functions.paths import asset_path, snapshot_path
from ticklake.functions.times import to_epoch_ms, utc_date
from ticklake.operators.flatten import is_snapshot
from ticklake.operators.reduce import latest_by
from ticklake.session import existing, stored

CORRUPT = "_corrupt_record"
RUN = ["dataset", "run_timestamp", "run_id"]
NAMED_RUNS = 256  # whose folders a scan names one by one
_STORED = T.StructType(
    [
        *SNAPSHOT.fields,
        T.StructField(CORRUPT, STRING),
        T.StructField("dataset", STRING),
        T.StructField("run_timestamp", LONG),
        T.StructField("run_id", STRING),
        T.StructField("exchange_id", STRING),
    ]
)
_LOGGED = T.StructType(
    [
        *MANIFEST.struct.fields,
        T.StructField("withdrawn", T.BooleanType()),
        T.StructField("recorded_at", LONG),
        T.StructField("run_day", T.DateType()),
    ]
)
# The log lies in folders by dataset and day of the run, so a landing reads its own day's records only.
_LOG_FOLDERS = ("dataset", "run_day")

# The same snapshot may be landed by several runs.
VERSION_KEY = ["dataset", "exchange_id", "extraction_timestamp", "run_timestamp", "run_id"]
_PLAIN = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def _plain(name: str) -> str:
    """Run and load ids and datasets become folder names."""
    if not _PLAIN.fullmatch(name):
        raise ValueError(f"Letters, digits, dots, dashes and underscores only: {name!r}")
    return name


class SnapshotLake:
    """JSON lines below ``root``, a folder for each dataset, run (instant and id) and venue.

    Landing a run again replaces the run as a whole: snapshots it no longer has are withdrawn from
    the manifest as well. The manifest is a log: a later record about a version of a snapshot
    overrules an earlier one, and the version of the latest run is the snapshot's state.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.snapshot_root = f"{root.rstrip('/')}/snapshots"
        self.manifest_root = f"{root.rstrip('/')}/manifest"
        self.loads_root = f"{root.rstrip('/')}/loads"
        self.quarantine_root = f"{root.rstrip('/')}/quarantine"

    def _run_folder(self, dataset: str, run_timestamp: int, run_id: str) -> str:
        return f"{self.snapshot_root}/dataset={dataset}/run_timestamp={run_timestamp}/run_id={run_id}"

    def land(
        self,
        snapshots: DataFrame,
        dataset: str,
        run_id: str,
        run_timestamp: int,
        recorded_at: int | None = None,
        keys: DataFrame | None = None,
    ) -> None:
        """Write snapshots, then record them as not loaded, also those that were loaded before.

        ``keys`` are the snapshots' venues and instants, where the caller knows them more cheaply than by
        reading back what this run wrote.
        """
        if not is_snapshot(snapshots):
            raise TypeError(f"Snapshots expected, got {snapshots.schema.simpleString()}")
        folder = self._run_folder(_plain(dataset), run_timestamp, _plain(run_id))
        placed = snapshots.select("metadata", "data", F.col("metadata.exchange_id").alias("exchange_id"))
        placed.hint("rebalance", F.col("exchange_id")).write.partitionBy("exchange_id").mode("overwrite").json(folder)
        run = {
            "dataset": F.lit(dataset),
            "run_timestamp": F.lit(run_timestamp).cast("bigint"),
            "run_id": F.lit(run_id),
        }
        if keys is None:
            keys = self._stored([folder]).filter(F.col(CORRUPT).isNull())
        landed = keys.select("exchange_id", "extraction_timestamp").distinct()
        before = self._log().filter((F.col("dataset") == dataset) & (F.col("run_day") == utc_date(run["run_timestamp"])))
        before = before.filter((F.col("run_id") == run_id) & (F.col("run_timestamp") == run_timestamp))
        before = before.select("exchange_id", "extraction_timestamp").distinct()
        state = landed.withColumn("withdrawn", F.lit(False)).unionByName(before.withColumn("withdrawn", F.lit(True)))
        state = state.groupBy("exchange_id", "extraction_timestamp").agg(F.min("withdrawn").alias("withdrawn"))
        asset = asset_path(F.concat_ws("_", "exchange_id", F.lit(dataset)))
        entries = state.select(
            snapshot_path(asset, F.col("extraction_timestamp")).alias("snapshot_path"),
            "exchange_id",
            "extraction_timestamp",
            *[value.alias(name) for name, value in run.items()],
            F.lit(False).alias("loaded"),
            "withdrawn",
        )
        self._record(entries.select(*MANIFEST.columns, "withdrawn"), recorded_at)

    def _scan(self, reader: Callable[[], DataFrame], schema: T.StructType | str) -> DataFrame:
        """A part of the lake; what was never written reads as empty."""
        try:
            return reader()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _stored(self, where: list[str] | None = None) -> DataFrame:
        """Landed snapshots of all runs, or of the runs in these folders, with the text of unreadable lines."""
        read = self.spark.read.schema(_STORED).option("basePath", self.snapshot_root)
        read = read.option("columnNameOfCorruptRecord", CORRUPT)
        there, _ = existing(self.spark, [self.snapshot_root] if where is None else where)
        lines = read.json(there) if there else self.spark.createDataFrame([], _STORED)
        return lines.withColumn("extraction_timestamp", to_epoch_ms(F.col("metadata.timestamp")))

    def _record(self, entries: DataFrame, recorded_at: int | None) -> None:
        """Add to the log. Records are ordered by ``recorded_at``, by default the time of writing."""
        at = int(time.time() * 1000) if recorded_at is None else recorded_at
        logged = entries.withColumn("recorded_at", F.lit(at).cast("bigint")).withColumn("run_day", utc_date(F.col("run_timestamp")))
        logged.hint("rebalance", *[F.col(c) for c in _LOG_FOLDERS]).write.partitionBy(*_LOG_FOLDERS).mode("append").parquet(self.manifest_root)

    def _log(self) -> DataFrame:
        read = self.spark.read.schema(_LOGGED)
        return self._scan(lambda: read.parquet(self.manifest_root), _LOGGED)

    def manifest(self) -> DataFrame:
        """Current state: one row per snapshot, from the last record of its latest version."""
        versions = latest_by(self._log(), VERSION_KEY, ["recorded_at", "loaded"])
        standing = versions.filter(~F.coalesce("withdrawn", F.lit(False)))
        return latest_by(standing, list(MANIFEST.key), ["run_timestamp", "run_id"]).select(*MANIFEST.columns)

    def compact_manifest(self) -> None:
        """Write the manifest's log anew with the last record of each version; not while a landing or load runs."""
        kept = stored(latest_by(self._log(), VERSION_KEY, ["recorded_at", "loaded"]).filter(~F.coalesce("withdrawn", F.lit(False))), "manifest")
        kept.write.partitionBy(*_LOG_FOLDERS).mode("overwrite").parquet(self.manifest_root)

    def scan(self, chosen: DataFrame | None = None) -> DataFrame:
        """Lines of the runs of the chosen manifest rows (all by default): metadata, data, version key, corrupt text.

        Only those runs' folders are read. The folders of few runs are named one by one; of more than ``NAMED_RUNS`` the
        driver never holds a list: their datasets are listed by tasks, and the runs joined, which prunes the
        folders that are read. A folder that is gone is left out; its snapshots are then missing from the result. Unreadable lines have their text in ``_corrupt_record`` and no other value but
        their folder's. ``chosen`` should be a stored table, as ``plan`` returns it.
        """
        if chosen is None:
            chosen, found = self.manifest(), self._stored()
        else:
            runs = chosen.select(*RUN).distinct()
            few = runs.limit(NAMED_RUNS + 1).collect()
            if len(few) <= NAMED_RUNS:
                found = self._stored([self._run_folder(*r) for r in few])
            else:
                datasets = chosen.select("dataset").distinct().collect()
                found = self._stored([f"{self.snapshot_root}/dataset={d.dataset}" for d in datasets]).join(runs, RUN, "left_semi")
        # A snapshot may lack its venue or instant, so those two compare NULLs as equal.
        same = F.lit(True)
        for c in VERSION_KEY:
            equal = F.col(f"s.{c}").eqNullSafe(F.col(f"c.{c}")) if c in ("exchange_id", "extraction_timestamp") else F.col(f"s.{c}") == F.col(f"c.{c}")
            same = same & equal
        good = found.filter(F.col(CORRUPT).isNull())
        bad = found.filter(F.col(CORRUPT).isNotNull())
        columns = ["metadata", "data", *VERSION_KEY, CORRUPT]
        kept = good.alias("s").join(chosen.select(*VERSION_KEY).alias("c"), same, "left_semi")
        return kept.select(*columns).unionByName(bad.select(*columns))

    def snapshots(self, chosen: DataFrame | None = None) -> DataFrame:
        """``(metadata, data)`` of the chosen manifest rows (all by default), in their last version; readable ones."""
        return self.scan(chosen).filter(F.col(CORRUPT).isNull()).select("metadata", "data")

    def set_aside(self, lines: DataFrame, load_id: str) -> None:
        """Keep the text of unreadable lines for inspection, once per load."""
        lines.select(*RUN, "exchange_id", CORRUPT).write.mode("overwrite").parquet(f"{self.quarantine_root}/load_id={_plain(load_id)}")

    def quarantined(self) -> DataFrame:
        schema = "dataset string, run_timestamp long, run_id string, exchange_id string, _corrupt_record string, load_id string"
        read = self.spark.read.schema(schema)
        return self._scan(lambda: read.parquet(self.quarantine_root), schema)

    def snapshot(self, dataset: str, exchange_id: str, extraction_timestamp: int) -> DataFrame:
        """One given snapshot; that it is not there is an error."""
        wanted = (
            (F.col("dataset") == dataset)
            & (F.col("exchange_id") == exchange_id)
            & (F.col("extraction_timestamp") == extraction_timestamp)
        )
        chosen = self.manifest().filter(wanted)
        if chosen.isEmpty():
            raise FileNotFoundError(f"No snapshot {dataset}/{exchange_id}/{extraction_timestamp}")
        return self.snapshots(chosen)

    def pending_in(self, target: DataFrame) -> DataFrame:
        """Snapshots still flagged as not loaded although ``target`` has their rows."""
        key = ["exchange_id", "extraction_timestamp"]
        pending = self.manifest().filter(~F.col("loaded"))
        return pending.join(target.select(*key).distinct(), key, "left_semi").select(*MANIFEST.columns)

    def mark_loaded(self, entries: DataFrame, recorded_at: int | None = None) -> None:
        """Record manifest rows as loaded, after their rows are committed. Repeating it is harmless."""
        done = entries.withColumn("loaded", F.lit(True)).withColumn("withdrawn", F.lit(False))
        self._record(done.select(*MANIFEST.columns, "withdrawn"), recorded_at)

    def _plan_folder(self, load_id: str) -> str:
        return f"{self.loads_root}/load_id={_plain(load_id)}"

    def planned(self, load_id: str) -> DataFrame:
        """The manifest rows a load set out to load, read by its own folder."""
        read = self.spark.read.schema(MANIFEST.struct)
        return self._scan(lambda: read.parquet(self._plan_folder(load_id)), MANIFEST.struct)

    def plan(self, load_id: str, chosen: DataFrame) -> DataFrame:
        """Fix what a load takes, before anything is written. A repeated load keeps its first plan,
        so it rewrites exactly what it wrote before."""
        if self.planned(load_id).isEmpty():
            chosen.select(*MANIFEST.columns).write.mode("overwrite").parquet(self._plan_folder(load_id))
        return self.planned(load_id)
