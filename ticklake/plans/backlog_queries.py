"""Queries over the backlog: what is loaded, what is missing, and loading it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ticklake.operators import backlog, envelope, flatten, loaded_index
from ticklake.operators.writers import TickerTable
from ticklake.plans.domain_sql import LATEST, LOOKBACK, MANIFEST, TICKER_COLUMNS
from ticklake.plans.pipeline import counts_of, extract, load_backlog, load_files, load_one
from ticklake.plans.registry import query
from ticklake.session import scratch_dir, stored
from ticklake.sources import bind, files, planned
from ticklake.sources.lake import SnapshotLake
from ticklake.streaming.ingest import ingest_plans

CHOSEN = ["exchange_id", "extraction_timestamp", "snapshot_path"]
_FULL = f"""WITH {MANIFEST}
    SELECT exchange_id, extraction_timestamp, snapshot_path FROM manifest WHERE NOT loaded"""
_LOOKBACK = f"WITH {LOOKBACK} SELECT exchange_id, extraction_timestamp, snapshot_path FROM lookback"


def _target(ticks: DataFrame) -> DataFrame:
    """The table so far: the ticks of loaded snapshots."""
    return ticks.filter(bind.is_loaded(ticks))


@query(f"WITH {MANIFEST} SELECT exchange_id, extraction_timestamp FROM loaded")
def loaded_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the table holds, of every venue at once."""
    return backlog.loaded_timestamps(_target(bind.ticks(spark, sf_dir)))


@query(f"WITH {MANIFEST} SELECT exchange_id, extraction_timestamp FROM loaded WHERE exchange_id = 'click'")
def loaded_timestamps_venue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the table holds of one venue."""
    return backlog.loaded_timestamps(_target(bind.ticks(spark, sf_dir)), "click")


@query(f"WITH {LOOKBACK} SELECT exchange_id, extraction_timestamp FROM recent")
def recent_loaded_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded instants of each venue's last six hours."""
    return backlog.recent_loaded(backlog.loaded_timestamps(_target(bind.ticks(spark, sf_dir))))


@query(_FULL)
def backlog_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = bind.ticks(spark, sf_dir)
    loaded = backlog.loaded_timestamps(_target(ticks))
    return backlog.backlog_full(bind.manifest(ticks), loaded).select(*CHOSEN)


# Some instants are no whole seconds, so that both kinds of bitmaps are used.
_ODD = "extraction_timestamp + (extraction_timestamp // 3600000) % 3 * 7"


def _odd(df: DataFrame) -> DataFrame:
    return df.withColumn("extraction_timestamp", F.expr("extraction_timestamp + (extraction_timestamp div 3600000) % 3 * 7"))


@query(
    f"""WITH {MANIFEST}
    SELECT exchange_id, {_ODD} AS extraction_timestamp, snapshot_path FROM manifest WHERE NOT loaded"""
)
def backlog_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full-history backlog by bitmaps of what each load wrote, merged; one load is noted twice."""
    ticks = bind.ticks(spark, sf_dir)
    index = loaded_index.LoadedIndex(spark, scratch_dir(spark, "index"))
    target = _odd(_target(ticks))
    for load_id, part in (("load-1", "symbol < 'U15'"), ("load-2", "symbol >= 'U15'"), ("load-2", "symbol >= 'U15'")):
        index.add(target.filter(part), load_id)
    return loaded_index.backlog_indexed(_odd(bind.manifest(ticks)), index.read()).select(*CHOSEN)


@query(f"WITH {LATEST} SELECT {TICKER_COLUMNS} FROM latest")
def backlog_load_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings are loaded by full history, as the table's bitmap index has it; a third load finds nothing."""
    root = scratch_dir(spark, "indexed")
    lake, tickers = SnapshotLake(spark, f"{root}/lake"), TickerTable(spark, f"{root}/tickers", indexed=True)
    ticks = bind.ticks(spark, sf_dir)
    extract(_target(ticks), lake, "raw_tickers", "run-1", 1000)
    load_backlog(lake, tickers, "load-1", style="files")
    extract(ticks.filter(~bind.is_loaded(ticks)), lake, "raw_tickers", "run-2", 2000)
    load_backlog(lake, tickers, "load-2", style="files")
    load_backlog(lake, tickers, "load-3", style="files")
    return tickers.read().drop("date")


@query(_LOOKBACK)
def backlog_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = bind.ticks(spark, sf_dir)
    loaded = backlog.loaded_timestamps(_target(ticks))
    return backlog.backlog_lookback(bind.manifest(ticks), loaded).select(*CHOSEN)


@query(_FULL)
def backlog_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By text flags in mixed spelling, as sidecars hold them."""
    manifest = bind.manifest(bind.ticks(spark, sf_dir))
    spelled = F.when(F.col("loaded"), "True").when(F.col("exchange_id") == "view", "False")
    return backlog.backlog_flag(manifest.withColumn("loaded", spelled)).select(*CHOSEN)


@query(
    f"""WITH {LOOKBACK}
    SELECT exchange_id, extraction_timestamp, snapshot_path FROM lookback WHERE exchange_id <> 'signup'
    UNION ALL
    SELECT exchange_id, extraction_timestamp, snapshot_path FROM manifest WHERE exchange_id = 'signup'"""
)
def backlog_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One venue is new to the table and gets everything, the others their lookback."""
    ticks = bind.ticks(spark, sf_dir)
    target = _target(ticks).filter(F.col("exchange_id") != "signup")
    return backlog.backlog(bind.manifest(ticks), target).select(*CHOSEN)


@query(
    f"""WITH {LATEST}
    SELECT 'snapshots' AS what, count(DISTINCT (exchange_id, extraction_timestamp)) AS n FROM latest
    UNION ALL SELECT 'missing', 0 UNION ALL SELECT 'rows', 0 UNION ALL SELECT 'columns', 13"""
)
def empty_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything is loaded: no rows, all columns."""
    ticks = bind.ticks(spark, sf_dir)
    manifest = bind.manifest(ticks)
    missing = stored(backlog.backlog(manifest, ticks, style="files"), "backlog")
    rows = flatten.transform(backlog.load_rows(bind.records(ticks), missing))
    return counts(snapshots=manifest, missing=missing, rows=rows).unionByName(
        spark.range(1).select(F.lit("columns").alias("what"), F.lit(len(rows.columns)).cast("bigint").alias("n"))
    )


@query(
    f"""WITH {LOOKBACK}
    SELECT {TICKER_COLUMNS} FROM latest SEMI JOIN lookback USING (exchange_id, extraction_timestamp)"""
)
def backlog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker rows of the missing snapshots, chosen by lookback."""
    ticks = bind.ticks(spark, sf_dir)
    missing = stored(backlog.backlog(bind.manifest(ticks), _target(ticks)), "backlog")
    chosen = backlog.load_rows(ticks, missing)
    return flatten.transform(bind.records(envelope.latest_ticks(chosen)))


def counts(**frames: DataFrame) -> DataFrame:
    """(what, n): how many rows each has."""
    return reduce(
        DataFrame.unionByName,
        [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n") for name, df in frames.items()],
    )


@query(f"WITH {LATEST} SELECT {TICKER_COLUMNS} FROM latest")
def backlog_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two jobs end to end: land, load by table comparison, land the rest, load again, repeat.

    The last load looks at the recent window of the table only; it must change nothing.
    """
    root = scratch_dir(spark, "backlog")
    lake, tickers = SnapshotLake(spark, f"{root}/lake"), TickerTable(spark, f"{root}/tickers")
    ticks = bind.ticks(spark, sf_dir)
    extract(_target(ticks), lake, "raw_tickers", "run-1", 1000)
    load_backlog(lake, tickers, "load-1", style="files")
    extract(ticks.filter(~bind.is_loaded(ticks)), lake, "raw_tickers", "run-2", 2000)
    load_backlog(lake, tickers, "load-2", style="files")
    load_backlog(lake, tickers, "load-3", style="objects")
    return tickers.read().drop("date")


@query(
    f"""WITH {LATEST}
    SELECT count(DISTINCT (exchange_id, extraction_timestamp)) AS lines, 0 AS broken, count(*) AS symbols FROM latest"""
)
def load_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load counted while it wrote, its landed lines being read once."""
    root = scratch_dir(spark, "observed")
    lake, tickers = SnapshotLake(spark, f"{root}/lake"), TickerTable(spark, f"{root}/tickers")
    extract(bind.ticks(spark, sf_dir), lake, "raw_tickers", "run-1", 1000)
    watch = Observation()
    load_backlog(lake, tickers, "load-1", by_flag=True, watch=watch)
    counted = tuple(counts_of(watch)[c] for c in ("lines", "broken", "symbols"))
    return spark.createDataFrame([counted], "lines long, broken int, symbols long")


@query(
    f"""WITH {LOOKBACK}
    SELECT {TICKER_COLUMNS} FROM latest SEMI JOIN (
      SELECT exchange_id, extraction_timestamp FROM loaded
      UNION SELECT exchange_id, extraction_timestamp FROM lookback) USING (exchange_id, extraction_timestamp)"""
)
def backlog_load_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second landing is loaded by lookback against the days of the table that the window touches."""
    root = scratch_dir(spark, "recent")
    lake, tickers = SnapshotLake(spark, f"{root}/lake"), TickerTable(spark, f"{root}/tickers")
    ticks = bind.ticks(spark, sf_dir)
    extract(_target(ticks), lake, "raw_tickers", "run-1", 1000)
    load_backlog(lake, tickers, "load-1", by_flag=True)
    extract(ticks.filter(~bind.is_loaded(ticks)), lake, "raw_tickers", "run-2", 2000)
    load_backlog(lake, tickers, "load-2", style="objects")
    return tickers.read().drop("date")


@query(
    f"""WITH {MANIFEST}
    SELECT 'loaded' AS what, count(*) AS n FROM loaded
    UNION ALL SELECT 'pending', count(*) FROM manifest WHERE NOT loaded
    UNION ALL SELECT 'quarantined', count(*) FROM manifest WHERE NOT loaded
    UNION ALL SELECT 'rows', count(*) FROM latest SEMI JOIN loaded USING (exchange_id, extraction_timestamp)"""
)
def lake_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of some snapshots are cut off after they were landed: set aside, and not marked as loaded."""
    root = scratch_dir(spark, "broken")
    lake, tickers = SnapshotLake(spark, f"{root}/lake"), TickerTable(spark, f"{root}/tickers")
    ticks = bind.ticks(spark, sf_dir)
    whole = envelope.envelopes(_target(ticks))
    lake.land(whole, "raw_tickers", "run-1", 1000, keys=ticks.select(*backlog.KEY))
    cut = envelope.envelopes(ticks.filter(~bind.is_loaded(ticks)))
    text = F.to_json(F.struct("metadata", "data"))
    half = cut.select(
        F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int")).alias("value"),
        F.col("metadata.exchange_id").alias("exchange_id"),
    )
    folder = f"{root}/lake/snapshots/dataset=raw_tickers/run_timestamp=1000/run_id=run-1"
    half.write.mode("append").partitionBy("exchange_id").text(folder)
    load_backlog(lake, tickers, "load-1", by_flag=True)
    state = lake.manifest()
    return counts(
        loaded=state.filter("loaded"), pending=state.filter("NOT loaded"), quarantined=lake.quarantined(), rows=tickers.read()
    )


@query(
    f"""WITH {MANIFEST}
    SELECT 'landed' AS what, count(*) AS n FROM loaded
    UNION ALL SELECT 'pending', 0
    UNION ALL SELECT 'rows', count(*) FROM latest"""
)
def reland_fewer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loaded run is landed again with fewer snapshots: it is replaced as a whole, and nothing is loaded twice."""
    root = scratch_dir(spark, "reland")
    lake, tickers = SnapshotLake(spark, f"{root}/lake"), TickerTable(spark, f"{root}/tickers")
    ticks = bind.ticks(spark, sf_dir)
    extract(ticks, lake, "raw_tickers", "run-1", 1000)
    load_backlog(lake, tickers, "load-1", by_flag=True)
    extract(_target(ticks), lake, "raw_tickers", "run-1", 1000)
    # The table has them all; the same load again replaces what it wrote.
    load_backlog(lake, tickers, "load-2", style="files")
    lake.mark_loaded(lake.pending_in(tickers.read()))
    state = lake.manifest()
    return counts(landed=state, pending=state.filter("NOT loaded"), rows=tickers.read())


@query(f"WITH {LATEST} SELECT {TICKER_COLUMNS} FROM latest")
def two_runs_same_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs that share an instant keep what each landed."""
    root = scratch_dir(spark, "runs")
    lake, tickers = SnapshotLake(spark, f"{root}/lake"), TickerTable(spark, f"{root}/tickers")
    ticks = bind.ticks(spark, sf_dir)
    extract(_target(ticks), lake, "raw_tickers", "run-1", 1000)
    extract(ticks.filter(~bind.is_loaded(ticks)), lake, "raw_tickers", "run-2", 1000)
    load_backlog(lake, tickers, "load-1", by_flag=True)
    return tickers.read().drop("date")


@query(
    f"""WITH {LATEST}
    SELECT {TICKER_COLUMNS} FROM latest
    WHERE exchange_id = 'click' AND extraction_timestamp = (SELECT max(extraction_timestamp) FROM latest WHERE exchange_id = 'click')"""
)
def single_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One given snapshot of a venue, its newest."""
    lake = SnapshotLake(spark, scratch_dir(spark, "single"))
    ticks = bind.ticks(spark, sf_dir)
    extract(ticks, lake, "raw_tickers", "run-1", 1000)
    newest = ticks.filter("exchange_id = 'click'").agg(F.max("extraction_timestamp")).first()[0]
    return load_one(spark, lake, "raw_tickers", "click", newest)


def _write_files(ticks: DataFrame, root: str, names: tuple[str, ...] = ("raw/tickers",)) -> None:
    """Snapshots and sidecars as another program leaves them: one JSON line a file, by venue and instant.

    ``names`` are what files are called below their venue, before the instant, in turn by the hour.
    """
    key = [F.col("metadata.exchange_id").alias("venue"), F.col("metadata.timestamp").alias("instant")]
    text = F.to_json(F.struct("metadata", "data"))
    nested = envelope.envelopes(ticks).select(*key, text.alias("value"))
    manifest = bind.manifest(ticks)
    side = F.to_json(F.struct(F.col("run_id"), F.col("extraction_timestamp").cast("string").alias("timestamp"), F.col("loaded").cast("string").alias("loaded")))
    sides = manifest.select(F.col("exchange_id").alias("venue"), F.col("extraction_timestamp").cast("bigint").alias("instant"), side.alias("value"))

    def write(batches):
        # Each row becomes one file in the shared folder, through Arrow's file systems.
        from pyarrow import fs

        for batch in batches:
            for venue, instant, value, suffix in zip(*(batch.column(c).to_pylist() for c in ("venue", "instant", "value", "suffix")), strict=True):
                store, path = fs.FileSystem.from_uri(root) if ":" in root.split("/")[0] else (fs.LocalFileSystem(), root)
                name = f"{path}/{venue}/{names[instant // 3_600_000 % len(names)]}_{instant}{suffix}"
                store.create_dir(name.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(name) as out:
                    out.write(value.encode())
            yield batch.slice(0, 0)

    both = nested.withColumn("suffix", F.lit(".json")).unionByName(sides.withColumn("suffix", F.lit(".meta.json")))
    both.mapInArrow(write, both.schema).write.format("noop").mode("overwrite").save()


@query(
    f"""WITH {MANIFEST}
    SELECT 'files' AS what, count(*) AS n FROM manifest
    UNION ALL SELECT 'loaded', count(*) FROM manifest WHERE NOT loaded
    UNION ALL SELECT 'left', 0
    UNION ALL SELECT 'rows', count(*) FROM latest ANTI JOIN loaded USING (exchange_id, extraction_timestamp)"""
)
def files_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of another program: listed, paired with sidecars, chosen by flag, read, noted; then nothing is left."""
    root = scratch_dir(spark, "files")
    tickers = TickerTable(spark, f"{root}/tickers")
    _write_files(bind.ticks(spark, sf_dir), f"{root}/landing")
    listed = files.snapshot_manifest(spark, f"{root}/landing", multi_line=False)
    loaded = load_files(spark, f"{root}/landing", tickers, "load-1", f"{root}/state", multi_line=False)
    left = load_files(spark, f"{root}/landing", tickers, "load-2", f"{root}/state", multi_line=False)
    return counts(files=listed, loaded=loaded, left=left, rows=tickers.read())


ODD_NAMES = ("with space/tickers", "tick%41ers", "raw/tick[1]ers", "börse #1+{a,b}?")


@query(
    f"""WITH {MANIFEST}
    SELECT 'files' AS what, count(*) AS n FROM manifest
    UNION ALL SELECT 'loaded', count(*) FROM manifest WHERE NOT loaded
    UNION ALL SELECT 'again', 0 UNION ALL SELECT 'third', 0
    UNION ALL SELECT 'rows', count(*) FROM latest ANTI JOIN loaded USING (exchange_id, extraction_timestamp)"""
)
def files_odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that URLs or patterns would change: paired with their sidecars, loaded, and not loaded again."""
    root = scratch_dir(spark, "odd")
    tickers = TickerTable(spark, f"{root}/tickers")
    _write_files(bind.ticks(spark, sf_dir), f"{root}/landing", ODD_NAMES)
    listed = files.snapshot_manifest(spark, f"{root}/landing", multi_line=False)
    loads = {
        what: load_files(spark, f"{root}/landing", tickers, load_id, f"{root}/state", multi_line=False)
        for what, load_id in (("loaded", "load-1"), ("again", "load-2"), ("third", "load-3"))
    }
    return counts(files=listed, **loads, rows=tickers.read())


@query(f"WITH {LATEST} SELECT {TICKER_COLUMNS} FROM latest")
def files_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files chosen in two numbered plans and streamed into the table: each plan is taken once."""
    root = scratch_dir(spark, "planned")
    tickers = TickerTable(spark, f"{root}/tickers")
    _write_files(bind.ticks(spark, sf_dir), f"{root}/landing", ODD_NAMES)
    listed = files.snapshot_manifest(spark, f"{root}/landing", multi_line=False)
    for number, part in enumerate(("NOT coalesce(loaded, 'false') = 'true'", "loaded = 'true'")):
        planned.write_plan(listed.filter(part), f"{root}/plans/plan={number}")
        ingest_plans(spark, f"{root}/plans", tickers, f"{root}/checkpoint", f"{root}/broken").awaitTermination()
    return tickers.read().drop("date")


@query(
    f"""WITH {MANIFEST}
    SELECT 'skipped' AS what, 2 AS n UNION ALL SELECT 'rows', count(*) FROM latest"""
)
def files_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of paths of which some are absent: the others are read."""
    root = scratch_dir(spark, "absent")
    ticks = bind.ticks(spark, sf_dir)
    for name, part in (("a", bind.is_loaded(ticks)), ("b", ~bind.is_loaded(ticks))):
        envelope.envelopes(ticks.filter(part)).write.json(f"{root}/{name}")
    names = [f"{root}/{x}" for x in ("gone", "a", "never", "b")]
    rows = flatten.transform(files.read_snapshots(spark, names, multi_line=False))
    absent = spark.createDataFrame([(n,) for n in files.skipped(spark, names)], "name string")
    return counts(skipped=absent, rows=rows)
