import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ticklake.operators.flatten import transform
from ticklake.operators.writers import TickerTable
from ticklake.session import scratch_dir
from ticklake.streaming import ingest

from .conftest import rows
from .test_snapshots import full, snapshot

HOUR = 3_600_000


def land(folder, name, *snapshots):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("".join(json.dumps(s) + "\n" for s in snapshots))


def at(hour, *symbols, exchange="binance"):
    return snapshot(*[full(s, 5.0) for s in symbols], timestamp=hour * HOUR, exchange=exchange)


def poll(spark, folder, root, table, dedup=False, **options):
    snapshots = ingest.stream_snapshots(spark, str(folder), **options)
    stream = transform(snapshots)
    stream = ingest.dedup_stream(stream, salts=4) if dedup else stream
    query = ingest.start_ingest(stream, table, f"{root}/checkpoint")
    query.awaitTermination()
    return query


def setup(spark, tmp_path):
    root = scratch_dir(spark, "stream")
    return tmp_path / "landing", root, TickerTable(spark, f"{root}/tickers")


def test_polls_pick_up_only_what_is_new_and_equal_batch(spark, tmp_path):
    folder, root, table = setup(spark, tmp_path)
    land(folder, "a", at(1, "A", "B"), at(2, "A"))
    poll(spark, folder, root, table)
    poll(spark, folder, root, table)
    land(folder, "b", at(3, "C"))
    poll(spark, folder, root, table, files_per_trigger=1)
    batch = transform(spark.read.schema(ingest.SNAPSHOT).json(str(folder)))
    assert rows(table.read().drop("date")) == rows(batch) and batch.count() == 4


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    folder, root, table = setup(spark, tmp_path)
    land(folder, "a", at(1, "A", "B"))
    poll(spark, folder, root, table)
    for name in ("0", ".0.crc"):  # as if the stream had died before it noted its first batch
        (Path(root) / "checkpoint" / "commits" / name).unlink()
    poll(spark, folder, root, table)
    assert table.read().count() == 2


def test_streams_into_one_table_keep_each_others_rows(spark, tmp_path):
    folder, root, table = setup(spark, tmp_path)
    for zone in ("x", "y"):
        land(tmp_path / zone, "a", at(1, zone))
        ingest.ingest(spark, str(tmp_path / zone), table, f"{root}/{zone}").awaitTermination()
    assert rows(table.read(), "symbol") == [("x",), ("y",)]


def test_broken_lines_stop_a_stream_or_are_set_aside(spark, tmp_path):
    folder, root, table = setup(spark, tmp_path)
    land(folder, "a", at(1, "A"))
    (folder / "b.json").write_text('{"metadata": {"timestamp": 5}, "da\n')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE|FAILFAST"):
        ingest.ingest(spark, str(folder), table, f"{root}/strict").awaitTermination()
    ingest.ingest(spark, str(folder), table, f"{root}/kept", quarantine=f"{root}/q").awaitTermination()
    assert rows(table.read(), "symbol") == [("A",)]
    assert spark.read.parquet(f"{root}/q").count() == 1


def test_copies_within_the_watermark_are_dropped_and_late_rows_cut(spark, tmp_path):
    folder, root, table = setup(spark, tmp_path)
    land(folder, "a", at(10, "A", "B"), at(10, "A"))
    land(folder, "a2", at(10, "A"))
    poll(spark, folder, root, table, dedup=True)
    land(folder, "b", at(10, "A"), at(9, "A"), at(4, "A"), at(5, "A"), at(11, "A"))
    poll(spark, folder, root, table, dedup=True)
    hours = F.col("extraction_timestamp") / HOUR
    # The newest of the first poll is 10, so 4 lies at its cut, and only what is above it stays.
    assert rows(table.read(), "symbol", hours.cast("int").alias("hour")) == [
        ("A", 10), ("A", 11), ("A", 5), ("A", 9), ("B", 10),
    ]


def test_hot_key_is_deduplicated(spark, tmp_path):
    folder, root, table = setup(spark, tmp_path)
    for i in range(6):
        land(folder, f"f{i}", *[at(1, "HOT") for _ in range(50)], at(1, f"S{i}"))
    poll(spark, folder, root, table, dedup=True)
    assert [r[0] for r in rows(table.read(), "symbol")] == ["HOT", *[f"S{i}" for i in range(6)]]


def test_a_running_query_keeps_polling(spark, tmp_path):
    folder, root, table = setup(spark, tmp_path)
    land(folder, "a", at(1, "A"))
    query = ingest.ingest(spark, str(folder), table, f"{root}/checkpoint", every="1 second")
    try:
        query.processAllAvailable()
        land(folder, "b", at(2, "B"))
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(table.read(), "symbol") == [("A",), ("B",)]


def test_candles_wait_for_the_watermark(spark, tmp_path):
    folder, root, _ = setup(spark, tmp_path)
    late = [full("A", p) | {"timestamp": t} for p, t in ((1.0, 0), (3.0, 10), (2.0, 20))]
    newest = full("A", 9.0) | {"timestamp": 20 * HOUR}
    land(folder, "a", *[snapshot(t, timestamp=i) for i, t in enumerate([*late, newest])])
    stream = ingest.stream_bars(transform(ingest.stream_snapshots(spark, str(folder))), "1 hour")
    out = f"{root}/bars"
    query = ingest.start(stream, lambda b, n: b.write.mode("overwrite").parquet(f"{out}/batch={n}"), f"{root}/checkpoint")
    query.awaitTermination()
    assert rows(spark.read.parquet(out).drop("batch")) == [(0, 1.0, 3.0, 1.0, 2.0, 33.0, "binance", "A")]
