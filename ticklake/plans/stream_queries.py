"""Queries that run a stream to its end and return what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.contracts import OHLCV
from ticklake.operators import backlog, envelope, flatten
from ticklake.operators.writers import TickerTable
from ticklake.plans.backlog_queries import counts
from ticklake.plans.domain_sql import LATEST, LOOKBACK, MANIFEST, TICKER_COLUMNS
from ticklake.plans.quality_queries import BARS
from ticklake.plans.registry import query
from ticklake.plans.snapshot_queries import LATEST_TICKERS
from ticklake.session import scratch_dir
from ticklake.sources import bind
from ticklake.streaming import ingest, lookback


def _land(ticks: DataFrame, path: str, copies: int = 1) -> None:
    """Append the ticks' snapshots as JSON lines, each ``copies`` times."""
    nested = envelope.envelopes(ticks)
    for _ in range(copies):
        nested.write.mode("append").json(path)


@query(LATEST_TICKERS)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing zone to table as a stream, in two polls: what batch gives, nothing twice."""
    root = scratch_dir(spark, "stream")
    ticks = bind.ticks(spark, sf_dir)
    table = TickerTable(spark, f"{root}/tickers")
    for part in (bind.is_loaded(ticks), ~bind.is_loaded(ticks)):
        _land(ticks.filter(part), f"{root}/landing")
        ingest.ingest(spark, f"{root}/landing", table, f"{root}/checkpoint").awaitTermination()
    return table.read().drop("date")


def _dedup_run(spark: SparkSession, root: str, table: TickerTable) -> None:
    rows = flatten.transform(ingest.stream_snapshots(spark, f"{root}/landing"))
    unique = ingest.dedup_stream(rows)
    ingest.start_ingest(unique, table, f"{root}/checkpoint").awaitTermination()


@query(LATEST_TICKERS)
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every snapshot arrives twice, each row is kept once."""
    root = scratch_dir(spark, "dedup")
    table = TickerTable(spark, f"{root}/tickers")
    _land(bind.ticks(spark, sf_dir), f"{root}/landing", copies=2)
    _dedup_run(spark, root, table)
    return table.read().drop("date")


@query(
    f"""WITH {MANIFEST}
    SELECT {TICKER_COLUMNS} FROM latest SEMI JOIN (
      SELECT exchange_id, extraction_timestamp FROM manifest
      WHERE loaded OR extraction_timestamp >
        (SELECT max(extraction_timestamp) FROM loaded) - 21600000) USING (exchange_id, extraction_timestamp)"""
)
def stream_late_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What arrives second is cut where it is older than the newest of the first minus six hours."""
    root = scratch_dir(spark, "late")
    ticks = bind.ticks(spark, sf_dir)
    table = TickerTable(spark, f"{root}/tickers")
    for part in (bind.is_loaded(ticks), ~bind.is_loaded(ticks)):
        _land(ticks.filter(part), f"{root}/landing")
        _dedup_run(spark, root, table)
    return table.read().drop("date")


@query(
    f"""WITH {LATEST},
    bars AS ({BARS.format(
        bucket="ticker_timestamp_ms // 21600000 * 21600000", source="latest",
        order="ticker_timestamp_ms, extraction_timestamp")})
    SELECT * FROM bars
    WHERE "timestamp" + 21600000 <= (SELECT max(ticker_timestamp_ms) FROM latest) - 21600000"""
)
def stream_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour candles of landed tickers, each written once its window can no longer change."""
    root = scratch_dir(spark, "bars")
    _land(bind.ticks(spark, sf_dir), f"{root}/landing")
    rows = flatten.transform(ingest.stream_snapshots(spark, f"{root}/landing"))
    candles = ingest.stream_bars(rows, "6 hours")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/bars/batch_id={batch_id}")

    ingest.start(candles, write, f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(OHLCV.struct).parquet(f"{root}/bars").select(*OHLCV.columns)


@query(LATEST_TICKERS)
def stream_two_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landing zones feed one table, each with its own checkpoint; neither replaces the other's rows."""
    root = scratch_dir(spark, "zones")
    ticks = bind.ticks(spark, sf_dir)
    table = TickerTable(spark, f"{root}/tickers")
    for zone, part in (("a", bind.is_loaded(ticks)), ("b", ~bind.is_loaded(ticks))):
        _land(ticks.filter(part), f"{root}/{zone}")
        ingest.ingest(spark, f"{root}/{zone}", table, f"{root}/checkpoint-{zone}").awaitTermination()
    return table.read().drop("date")


@query(
    f"""WITH {MANIFEST}
    SELECT 'broken' AS what, count(*) AS n FROM manifest WHERE NOT loaded
    UNION ALL SELECT 'rows', count(*) FROM latest SEMI JOIN loaded USING (exchange_id, extraction_timestamp)"""
)
def stream_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines cut off in the landing zone are set aside, the others arrive."""
    root = scratch_dir(spark, "cut")
    ticks = bind.ticks(spark, sf_dir)
    table = TickerTable(spark, f"{root}/tickers")
    _land(ticks.filter(bind.is_loaded(ticks)), f"{root}/landing")
    text = F.to_json(F.struct("metadata", "data"))
    half = F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int")).alias("value")
    cut = envelope.envelopes(ticks.filter(~bind.is_loaded(ticks))).select(half)
    cut.write.text(f"{root}/landing/cut")
    query = ingest.ingest(spark, f"{root}/landing", table, f"{root}/checkpoint", quarantine=f"{root}/quarantine", glob="*.{json,txt}")
    query.awaitTermination()
    broken = spark.read.schema("_corrupt_record string").parquet(f"{root}/quarantine")
    return counts(broken=broken, rows=table.read())


@query(LATEST_TICKERS)
def stream_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query that polls every second, stopped once it has taken what is there."""
    root = scratch_dir(spark, "timed")
    table = TickerTable(spark, f"{root}/tickers")
    _land(bind.ticks(spark, sf_dir), f"{root}/landing")
    query = ingest.ingest(spark, f"{root}/landing", table, f"{root}/checkpoint", every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return table.read().drop("date")


@query(
    f"""WITH {LOOKBACK}
    SELECT exchange_id, extraction_timestamp, snapshot_path FROM lookback
    UNION ALL SELECT exchange_id, extraction_timestamp, snapshot_path FROM manifest WHERE loaded AND exchange_id = 'signup'"""
)
def stream_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed snapshots streamed in two loads, each venue by its own window.

    The table has all but one venue when the stream begins; that venue's loaded part is streamed first, and gets it all.
    """
    root = scratch_dir(spark, "lookback")
    ticks = bind.ticks(spark, sf_dir)
    landed = bind.manifest(ticks).select("exchange_id", "extraction_timestamp", "snapshot_path", "loaded")
    late = (F.col("exchange_id") == "signup") & F.col("loaded")
    in_table = backlog.loaded_timestamps(ticks.filter(bind.is_loaded(ticks) & (F.col("exchange_id") != "signup")))
    for part in (late, ~late):
        landed.filter(part).drop("loaded").write.mode("append").parquet(f"{root}/landed")
        arriving = spark.readStream.schema(landed.drop("loaded").schema).parquet(f"{root}/landed")
        chosen = lookback.lookback_stream(arriving, in_table).writeStream.format("parquet").option("path", f"{root}/chosen")
        with lookback.state_store(spark):
            chosen.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(landed.drop("loaded").schema).parquet(f"{root}/chosen")
