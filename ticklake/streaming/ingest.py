"""Poll landed snapshots, append their rows, forget nothing and double nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ticklake.contracts import SNAPSHOT, TICKER
from ticklake.operators.bars import chronological
from ticklake.operators.flatten import transform
from ticklake.operators.writers import TickerTable
from ticklake.sources import planned
from ticklake.sources.files import CORRUPT, parsed

WATERMARK = "6 hours"
DEDUP_SALTS = 16


def stream_snapshots(
    spark: SparkSession,
    path: str,
    files_per_trigger: int | None = None,
    on_corrupt: str = "fail",
    glob: str = "*.json",
) -> DataFrame:
    """JSON-lines snapshots as they arrive; the schema is given, never inferred.

    A line that cannot be read stops the stream, or with ``on_corrupt="quarantine"`` comes along as its text in
    ``_corrupt_record``, all else NULL.
    """
    keep = on_corrupt == "quarantine"
    schema = T.StructType([*SNAPSHOT.fields, T.StructField(CORRUPT, T.StringType())]) if keep else SNAPSHOT
    reader = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("mode", "PERMISSIVE" if keep else "FAILFAST")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def with_event_time(rows: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    instant = F.timestamp_millis("extraction_timestamp")
    return rows.withColumn("extraction_time", instant).withWatermark("extraction_time", watermark)


def dedup_stream(
    rows: DataFrame,
    keys: tuple[str, ...] = TICKER.key,
    watermark: str = WATERMARK,
    salts: int = DEDUP_SALTS,
) -> DataFrame:
    """Each key once, as long as its copies arrive within the watermark; later ones are cut.

    Two stages: copies of one key first meet in one of ``salts`` groups, by the input split they
    come from, and only the survivors meet as one key. So the copies of a hot key are spread over
    tasks, and one task sees at most ``salts`` of them per batch.
    """
    timed = with_event_time(rows, watermark)
    salted = timed.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    first = salted.dropDuplicatesWithinWatermark([*keys, "_salt"])
    return first.drop("_salt").dropDuplicatesWithinWatermark(list(keys))


def start(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Hand each micro-batch to ``write``. Without ``every`` the query takes what is there and stops."""
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def batch_load_id(batch: DataFrame, n: int, name: str = "ingest") -> str:
    """Load id of a micro-batch: its query's own id, which lives in the checkpoint, and its number.

    A batch replayed after a failure has the same id and replaces itself; other streams, and the same one
    with a new checkpoint, have others and add to the table.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{name}-{query}-{n:08d}"


def start_ingest(
    rows: DataFrame,
    table: TickerTable,
    checkpoint: str,
    name: str = "ingest",
    every: str | None = None,
) -> StreamingQuery:
    """Append each micro-batch of ticker rows to the table under its own load id."""
    return start(rows, lambda batch, n: table.append(batch, batch_load_id(batch, n, name)), checkpoint, every)


def ingest(
    spark: SparkSession,
    path: str,
    table: TickerTable,
    checkpoint: str,
    every: str | None = None,
    files_per_trigger: int | None = None,
    name: str = "ingest",
    quarantine: str | None = None,
    glob: str = "*.json",
) -> StreamingQuery:
    """Landing zone -> ticker table, the streaming twin of the batch transform.

    Lines that cannot be read stop the stream, or are written to the folder ``quarantine`` under the load id
    of their batch, and the others are appended.
    """
    if quarantine is None:
        return start_ingest(transform(stream_snapshots(spark, path, files_per_trigger, glob=glob)), table, checkpoint, name, every)
    scanned = stream_snapshots(spark, path, files_per_trigger, "quarantine", glob)
    return _start_split(scanned, table, checkpoint, every, name, quarantine)


def _start_split(scanned: DataFrame, table: TickerTable, checkpoint: str, every: str | None, name: str, quarantine: str) -> StreamingQuery:
    def write(batch: DataFrame, n: int) -> None:
        load_id = batch_load_id(batch, n, name)
        broken = batch.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)
        broken.write.mode("overwrite").parquet(f"{quarantine}/load_id={load_id}")
        table.append(transform(batch.filter(F.col(CORRUPT).isNull()).select("metadata", "data")), load_id)

    return start(scanned, write, checkpoint, every)


def ingest_plans(
    spark: SparkSession,
    plans: str,
    table: TickerTable,
    checkpoint: str,
    quarantine: str,
    multi_line: bool = False,
    every: str | None = None,
    name: str = "plans",
) -> StreamingQuery:
    """Load the files named by the plans ``plan=<n>`` below a folder, each plan once, as they are written.

    Unlike a stream over a landing zone it lists nothing: whoever chooses files writes the plans.
    """
    scanned = parsed(planned.stream_plans(spark, plans, lines=not multi_line).filter("NOT missing"), SNAPSHOT)
    return _start_split(scanned, table, checkpoint, every, name, quarantine)


def stream_bars(ticks: DataFrame, width: str, watermark: str = WATERMARK) -> DataFrame:
    """Candles per tumbling window, each emitted once the watermark has passed it.

    Ordered by ticker instant, and of one instant by the snapshot it came with.
    """
    rank = chronological(("ticker_timestamp_ms", "extraction_timestamp"))
    timed = ticks.withColumn("tick_instant", F.timestamp_millis("ticker_timestamp_ms"))
    grouped = (
        timed.withWatermark("tick_instant", watermark)
        .groupBy(F.window("tick_instant", width), F.col("exchange_id").alias("exchange"), "symbol")
        .agg(
            F.min_by("last", rank).alias("open"),
            F.max("last").alias("high"),
            F.min("last").alias("low"),
            F.max_by("last", rank).alias("close"),
            F.sum("base_volume").alias("volume"),
        )
    )
    start = F.unix_millis("window.start").alias("timestamp")
    return grouped.select(start, "open", "high", "low", "close", "volume", "exchange", "symbol")
