"""Queries over snapshots: build, name, land, scan, flatten."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions import paths
from ticklake.functions.times import stamp, to_epoch_ms
from ticklake.operators import envelope, flatten, metrics, unknown
from ticklake.plans.domain_sql import LATEST, MANIFEST, TICKER_COLUMNS, TICKS
from ticklake.plans.registry import query
from ticklake.session import scratch_dir, stored
from ticklake.sources import bind, files
from ticklake.sources.lake import SnapshotLake

LATEST_TICKERS = f"WITH {LATEST} SELECT {TICKER_COLUMNS} FROM latest"


@query(LATEST_TICKERS)
def transform_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each symbol's latest ticker in each snapshot, in the table contract."""
    return flatten.transform(bind.records(envelope.latest_ticks(bind.ticks(spark, sf_dir))))


@query(LATEST_TICKERS)
def transform_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from nested snapshots that went through JSON text."""
    nested = envelope.envelopes(bind.ticks(spark, sf_dir))
    return flatten.transform(flatten.parse_json_text(envelope.to_json_text(nested)))


@query(
    f"""WITH {LATEST}
    SELECT exchange_id, extraction_timestamp, count(*) AS record_count,
           array_to_string(list_sort(list(symbol))[1:5], ',') AS sample
    FROM latest GROUP BY 1, 2"""
)
def snapshot_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many symbols each snapshot carries, and its first five."""
    sampled = envelope.sample_symbols(envelope.envelopes(bind.ticks(spark, sf_dir)))
    return sampled.withColumn("sample", F.array_join("sample", ","))


@query(
    f"""WITH {TICKS}
    SELECT DISTINCT exchange_id, exchange_id || '/raw/tickers_' || extraction_timestamp || '.json' AS path,
           exchange_id || '/raw/tickers_' || extraction_timestamp || '.meta.json' AS sidecar,
           'tickers_' || extraction_timestamp || '.json' AS file_name,
           exchange_id || '/raw' AS directory, exchange_id = 'view' AS is_view_asset
    FROM ticks"""
)
def snapshot_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logical names of the snapshots and their parts."""
    key = bind.ticks(spark, sf_dir).select("exchange_id", "extraction_timestamp").distinct()
    asset = paths.asset_path(F.concat(F.col("exchange_id"), F.lit("_raw_tickers")))
    path = F.col("path")
    return key.select(paths.snapshot_path(asset, F.col("extraction_timestamp")).alias("path")).select(
        paths.exchange_of(path).alias("exchange_id"),
        "path",
        paths.sidecar_path(path).alias("sidecar"),
        paths.file_name(path).alias("file_name"),
        paths.directory(path).alias("directory"),
        paths.under_prefix(path, "view/raw/tickers").alias("is_view_asset"),
    )


@query(
    """SELECT event_id AS tick_id,
           strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%y-%m-%d %H:%M:%S.%f') AS dt,
           CASE WHEN event_id % 5 < 3 THEN epoch_us(ts) // 1000 END AS ms
    FROM events"""
)
def run_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants in the five forms snapshots carry, brought to one, and the readable stamp."""
    ticks = bind.ticks(spark, sf_dir)
    ms = F.col("ticker_timestamp_ms")
    form = F.col("tick_id") % 5
    raw = (
        F.when(form == 0, F.concat(ms, F.lit(".7")))
        .when(form == 1, ms.cast("string"))
        .when(form == 2, F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSSxxx"))
        .when(form == 3, "")
        .otherwise("n/a")
    )
    return ticks.select("tick_id", stamp(ms).alias("dt"), to_epoch_ms(raw).alias("ms"))


@query(LATEST_TICKERS)
def land_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land every snapshot, land the same run again, read back: once is twice."""
    lake = SnapshotLake(spark, scratch_dir(spark, "land"))
    nested = envelope.envelopes(bind.ticks(spark, sf_dir))
    for _ in range(2):
        lake.land(nested, "raw_tickers", "run-1", 1_700_000_000_000)
    return flatten.transform(lake.snapshots())


@query(
    f"""WITH {MANIFEST}
    SELECT snapshot_path AS file_path, CASE WHEN loaded THEN 'true' END AS loaded,
           CASE WHEN loaded THEN 'run-' || extraction_timestamp END AS run_id
    FROM manifest"""
)
def manifest_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data files with their sidecars by name; what was never loaded has lost its sidecar here."""
    manifest = bind.manifest(bind.ticks(spark, sf_dir))
    path = F.col("snapshot_path")
    names = manifest.select(F.explode(F.array(path, paths.sidecar_path(path))).alias("file_path"), "*")
    is_sidecar = paths.is_sidecar(F.col("file_path"))
    sidecars = names.filter(is_sidecar & F.col("loaded")).select(
        "file_path", F.col("loaded").cast("string").alias("loaded"), "run_id"
    )
    return files.pair(names.filter(~is_sidecar), sidecars).orderBy("file_path")


@query(
    f"""WITH {MANIFEST}
    SELECT 'corrupt' AS state, count(*) AS snapshots, NULL::BIGINT AS tickers FROM manifest WHERE NOT loaded
    UNION ALL
    SELECT 'readable', (SELECT count(*) FROM loaded), count(*) FROM latest SEMI JOIN loaded
      USING (exchange_id, extraction_timestamp)"""
)
def corrupt_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots cut off in the middle are set aside, the others are read."""
    ticks = bind.ticks(spark, sf_dir)
    manifest = bind.manifest(ticks).select("exchange_id", "extraction_timestamp", "loaded")
    nested = envelope.envelopes(ticks).select(
        F.col("metadata.exchange_id").alias("exchange_id"),
        F.col("metadata.timestamp").alias("extraction_timestamp"),
        F.to_json(F.struct("metadata", "data")).alias("text"),
    )
    text = F.col("text")
    whole = F.when(F.col("loaded"), text).otherwise(F.expr("left(text, length(text) div 2)"))
    path = scratch_dir(spark, "corrupt")
    written = nested.join(manifest, ["exchange_id", "extraction_timestamp"]).select(whole.alias("value"))
    written.write.text(path)
    scanned = files.read_snapshots(
        spark, path, multi_line=False, on_corrupt="quarantine", glob="*.txt"
    )
    good, bad = files.split_corrupt(scanned)
    tickers = F.sum(F.size("data")).cast("bigint").alias("tickers")
    count = F.count(F.lit(1)).alias("snapshots")
    # A snapshot may be spread over several lines.
    readable = good.agg(F.count_distinct("metadata").alias("snapshots"), tickers).select(F.lit("readable").alias("state"), "snapshots", "tickers")
    corrupt = bad.agg(count).select(
        F.lit("corrupt").alias("state"), "snapshots", F.lit(None).cast("bigint").alias("tickers")
    )
    return corrupt.unionByName(readable)


@query(
    f"""WITH {TICKS}
    SELECT exchange_id, max(extraction_timestamp) AS newest_ms,
           max(exchange_id || '/raw/tickers_' || extraction_timestamp || '.json') AS last_name
    FROM ticks GROUP BY 1"""
)
def latest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest snapshot of each venue, by its instant and by its file name."""
    manifest = bind.manifest(bind.ticks(spark, sf_dir))
    newest = metrics.latest_entries(manifest, by_time=None, by_name=F.col("snapshot_path"))
    return newest.select(
        "exchange_id",
        F.col("by_time.extraction_timestamp").alias("newest_ms"),
        F.col("by_name.snapshot_path").alias("last_name"),
    )


@query(
    f"""WITH {LATEST}
    SELECT count(DISTINCT (exchange_id, extraction_timestamp)) AS files, count(*) AS records FROM latest"""
)
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and records of a full load."""
    rows = envelope.latest_ticks(bind.ticks(spark, sf_dir))
    source = F.concat_ws("_", "exchange_id", "extraction_timestamp")
    return metrics.load_summary(rows.select(source.alias("source_path")))


@query(
    f"""WITH {LATEST}
    SELECT count(*) AS row_count, 13::BIGINT AS column_count, '{TICKER_COLUMNS}' AS columns FROM latest"""
)
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.batch_summary(transform_tickers(spark, sf_dir))


@query(
    f"""WITH {LATEST}
    SELECT exchange_id, exchange_id <> 'click' AS exchange_mismatch, count(*) AS tickers
    FROM latest GROUP BY 1, 2"""
)
def exchange_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of another venue than the configured one are flagged and kept."""
    flagged = flatten.with_mismatch(transform_tickers(spark, sf_dir), "click")
    return flagged.groupBy("exchange_id", "exchange_mismatch").agg(F.count(F.lit(1)).alias("tickers"))


@query(
    f"""WITH {LATEST}
    SELECT symbol, ticker_timestamp_ms, last, bid, ask, high, low, volume, base_volume, quote_volume,
           exchange_id, extraction_timestamp FROM latest"""
)
def drop_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues that send no readable time: that column goes, the other stays."""
    rows = transform_tickers(spark, sf_dir)
    silent = rows.withColumn("ticker_datetime", F.lit(None).cast("string"))
    return flatten.drop_all_null(silent)


@query(
    f"""WITH {LATEST}
    SELECT count(DISTINCT (exchange_id, extraction_timestamp)) AS snapshots, 0 AS "rows", 13 AS columns FROM latest"""
)
def empty_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots without any ticker give no rows, but all columns."""
    nested = envelope.envelopes(bind.ticks(spark, sf_dir))
    emptied = nested.withColumn("data", F.map_filter("data", lambda k, v: v["last"] < 0))
    flat = flatten.transform(emptied)
    return emptied.agg(F.count_distinct("metadata").alias("snapshots")).join(
        flat.agg(F.count(F.lit(1)).cast("int").alias("rows"), F.lit(len(flat.columns)).alias("columns")), F.lit(True)
    )


@query(
    f"""WITH {LATEST}
    SELECT symbol, ticker_timestamp_ms, ticker_datetime, last,
           CASE WHEN exchange_id <> 'view' THEN bid END AS bid,
           CASE WHEN exchange_id <> 'view' THEN ask END AS ask,
           CASE WHEN exchange_id <> 'view' THEN high END AS high,
           CASE WHEN exchange_id <> 'view' THEN low END AS low,
           volume, base_volume, quote_volume, exchange_id, extraction_timestamp
    FROM latest"""
)
def hetero_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One venue publishes fewer fields; nested and flat inputs meet in one contract."""
    ticks = bind.ticks(spark, sf_dir)
    is_view = F.col("exchange_id") == "view"
    poor = bind.records(envelope.latest_ticks(ticks.filter(is_view))).drop("bid", "ask", "high", "low")
    rich = flatten.as_records(envelope.envelopes(ticks.filter(~is_view)))
    return flatten.to_tickers(flatten.union_records(rich, poor))


@query(f"WITH {LATEST} SELECT {TICKER_COLUMNS} FROM latest ORDER BY exchange_id, extraction_timestamp, symbol LIMIT 5")
def sample_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five-row sample shown with a load."""
    order = ["exchange_id", "extraction_timestamp", "symbol"]
    return metrics.sample_head(transform_tickers(spark, sf_dir), order)



@query(
    f"""WITH {LATEST}
    SELECT 'fee' AS field, 'BIGINT' AS kind, count(*) AS tickers, count(DISTINCT exchange_id) AS venues FROM latest WHERE tick_id % 3 <> 0
    UNION ALL SELECT 'note', 'STRING', count(*), count(DISTINCT exchange_id) FROM latest WHERE exchange_id = 'click'
    UNION ALL SELECT 'depth', 'OBJECT<level: BIGINT>', count(*), count(DISTINCT exchange_id) FROM latest"""
)
def unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed tickers with fields that the contract doesn't have: which, of what type, how often."""
    return unknown.report(unknown.ticker_fields(_with_extras(spark, sf_dir)))


@query(
    f"""WITH {LATEST}
    SELECT exchange_id, extraction_timestamp, symbol, last,
           CASE WHEN tick_id % 3 <> 0 THEN (tick_id % 10)::VARCHAR END AS fee, '{{"level":' || tick_id % 4 || '}}' AS depth FROM latest"""
)
def kept_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows as ever, with what the contract doesn't have beside them."""
    lines = stored(_with_extras(spark, sf_dir), "lines")
    rows = flatten.transform(flatten.parse_json_text(lines))
    beside = unknown.extras(unknown.ticker_fields(lines))
    both = rows.join(beside, ["exchange_id", "extraction_timestamp", "symbol"], "left")
    return both.select("exchange_id", "extraction_timestamp", "symbol", "last", F.try_element_at("extras", F.lit("fee")).alias("fee"), F.try_element_at("extras", F.lit("depth")).alias("depth"))


def _with_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots as JSON text, whose tickers have a fee (two of three), a note (one venue) and a nested depth."""
    ticks = envelope.latest_ticks(bind.ticks(spark, sf_dir).select("exchange_id", "extraction_timestamp", "symbol", "tick_id", "last"))
    ticker = F.struct(
        "symbol",
        "last",
        F.when(F.col("tick_id") % 3 != 0, F.col("tick_id") % 10).alias("fee"),
        F.when(F.col("exchange_id") == "click", F.lit("n")).alias("note"),
        F.struct((F.col("tick_id") % 4).alias("level")).alias("depth"),
    )
    nested = ticks.groupBy("exchange_id", "extraction_timestamp").agg(F.map_from_entries(F.collect_list(F.struct("symbol", ticker))).alias("data"))
    metadata = F.struct(F.col("extraction_timestamp").alias("timestamp"), "exchange_id").alias("metadata")
    return nested.select(F.to_json(F.struct(metadata, "data")).alias("value"))
