"""Snapshot files as another program lands them: one indented object per file, a sidecar beside it."""

import json

import pytest
from pyspark.sql import functions as F

from ticklake.operators.backlog import backlog_flag, backlog_full
from ticklake.operators.flatten import transform
from ticklake.operators.writers import TickerTable
from ticklake.plans.pipeline import load_files
from ticklake.session import scratch_dir
from ticklake.sources import files, planned
from ticklake.streaming.ingest import ingest_plans

from .conftest import rows
from .test_snapshots import full, snapshot


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "binance" / "raw"
    folder.mkdir(parents=True)
    for ms, loaded in ((100000000, "false"), (200000000, "true"), (300000000, "false")):
        body = snapshot(full("BTC/USDT", 1.0), full("ETH/USDT", 2.0), timestamp=ms + 0.7)
        (folder / f"tickers_{ms}.json").write_text(json.dumps(body, indent=2))
        side = {"run_id": f"r{ms}", "timestamp": f"{ms}.7", "dt": "", "run_timestamp": str(ms), "loaded": loaded}
        (folder / f"tickers_{ms}.meta.json").write_text(json.dumps(side, indent=2))
    return tmp_path


def names(df):
    return [r[0].rsplit("/", 1)[1] for r in rows(df, "file_path")]


def test_all_files_flatten_without_merging(spark, landing):
    found = files.read_snapshots(spark, str(landing))
    assert transform(found).count() == 6
    assert rows(transform(found), "extraction_timestamp")[0] == (100000000,)


def test_backlog_by_sidecar_flag(spark, landing):
    data = files.read_snapshots(spark, str(landing)).select("file_path")
    paired = files.pair(data, files.read_sidecars(spark, str(landing)))
    assert names(backlog_flag(paired, "files")) == ["tickers_100000000.json", "tickers_300000000.json"]


def test_backlog_by_sidecar_instant(spark, landing):
    data = files.read_snapshots(spark, str(landing)).select("file_path")
    paired = files.pair(data, files.read_sidecars(spark, str(landing))).withColumn("exchange_id", F.lit("binance"))
    loaded = spark.createDataFrame([("binance", 100000000)], "exchange_id string, extraction_timestamp long")
    assert names(backlog_full(paired, loaded)) == ["tickers_200000000.json", "tickers_300000000.json"]


def test_an_unreadable_or_missing_sidecar_counts_as_unloaded(spark, landing):
    folder = landing / "binance" / "raw"
    (folder / "tickers_200000000.meta.json").write_text("{oops")
    (folder / "tickers_400000000.json").write_text(json.dumps(snapshot(timestamp=4)))
    data = files.read_snapshots(spark, str(landing)).select("file_path")
    paired = files.pair(data, files.read_sidecars(spark, str(landing)))
    assert len(names(backlog_flag(paired, "files"))) == 4
    loaded = spark.createDataFrame([], "exchange_id string, extraction_timestamp long")
    by_table = backlog_full(paired.withColumn("exchange_id", F.lit("binance")), loaded)
    assert names(by_table) == ["tickers_100000000.json", "tickers_300000000.json"]


def test_missing_source_policies(spark, tmp_path):
    gone = str(tmp_path / "gone")
    assert files.read_snapshots(spark, gone).count() == 0
    assert files.read_snapshots(spark, gone, on_corrupt="quarantine").count() == 0
    assert files.list_files(spark, gone).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_snapshots(spark, gone, on_missing="error")


def test_corrupt_data_fails_or_is_set_aside(spark, landing):
    (landing / "binance" / "raw" / "tickers_500000000.json").write_text('{"metadata": {"timestamp": 5}, "data": {"BTC')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        transform(files.read_snapshots(spark, str(landing))).collect()
    good, bad = files.split_corrupt(files.read_snapshots(spark, str(landing), on_corrupt="quarantine"))
    assert transform(good).count() == 6
    assert names(bad) == ["tickers_500000000.json"] and bad.count() == 1


def test_listing(spark, landing):
    found = files.list_files(spark, str(landing), "*.meta.json")
    assert found.count() == 3 and found.filter("length > 0 AND modified_at IS NOT NULL").count() == 3


def test_absent_paths_of_a_list_are_left_out(spark, landing):
    names = [str(landing / "gone"), str(landing / "binance"), str(landing / "gone2")]
    assert transform(files.read_snapshots(spark, names)).count() == 6
    assert files.skipped(spark, names) == [names[0], names[2]]


def test_incremental_load_reads_and_notes_only_what_is_chosen(spark, landing, tmp_path):
    table, state = TickerTable(spark, scratch_dir(spark, "files")), scratch_dir(spark, "state")
    (landing / "binance" / "raw" / "tickers_500000000.json").write_text('{"metadata": {"timestamp": 5}, "data": {"BTC')
    loaded = load_files(spark, str(landing), table, "l1", state)
    assert names(loaded) == ["tickers_100000000.json", "tickers_300000000.json"]
    assert rows(table.read(), "extraction_timestamp") == [(100000000,)] * 2 + [(300000000,)] * 2
    assert names(spark.read.parquet(f"{state}/quarantine")) == ["tickers_500000000.json"]
    # Again under its id: the same plan, the same rows. Under the next: only what could not be read.
    load_files(spark, str(landing), table, "l1", state)
    assert table.read().count() == 4
    assert load_files(spark, str(landing), table, "l2", state).count() == 0
    assert load_files(spark, str(landing), table, "l3", state, by_flag=False).count() == 1
    assert table.read().count() == 6


ODD = ["with space/tick_1000.json", "tick%41ers_2000.json", "tick[1]ers_3000.json", "börse+#{a,b}?_4000.json", "plain_5000.json"]


@pytest.mark.parametrize("multi_line", [True, False])
def test_any_name_is_loaded_once(spark, tmp_path, multi_line):
    """Names that patterns or URLs would change are listed, paired, read and noted like others."""
    root = tmp_path / "landing [x] 50%"
    for name in ODD:
        file = root / "venue é" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        ms = int(name.removesuffix(".json").rsplit("_", 1)[1])
        file.write_text(json.dumps(snapshot(full("A/B", 1.0), timestamp=ms), indent=2 if multi_line else None))
    side = {"run_id": "r", "timestamp": "1000", "loaded": "true"}
    (root / "venue é" / "with space" / "tick_1000.meta.json").write_text(json.dumps(side))
    manifest = files.snapshot_manifest(spark, str(root), multi_line=multi_line)
    assert rows(manifest, "extraction_timestamp", "run_id", "loaded") == [(1000, "r", "true")] + [(ms, None, None) for ms in (2000, 3000, 4000, 5000)]
    assert {r.exchange_id for r in manifest.collect()} == {"venue é"}
    table = TickerTable(spark, str(tmp_path / "table"))
    loaded = [load_files(spark, str(root), table, f"l-{i}", str(tmp_path / "state"), multi_line=multi_line).count() for i in range(3)]
    assert loaded == [4, 0, 0]
    assert rows(table.read(), "extraction_timestamp") == [(2000,), (3000,), (4000,), (5000,)]


def test_planned_files_that_are_gone_are_left_out(spark, landing, tmp_path):
    listed = files.list_files(spark, str(landing), "tickers_?00000000.json").select("file_path")
    planned.write_plan(listed, str(tmp_path / "plan"))
    (landing / "binance" / "raw" / "tickers_100000000.json").unlink()
    assert planned.read_plan(spark, str(tmp_path / "plan")).filter("missing").count() == 1
    assert transform(files.split_corrupt(files.read_planned(spark, str(tmp_path / "plan")))[0]).count() == 4
    assert planned.read_plan(spark, str(tmp_path / "never")).count() == 0


def test_paths_have_one_spelling(spark, landing):
    scanned = files.read_snapshots(spark, str(landing)).select("file_path")
    assert rows(scanned) == rows(files.list_files(spark, str(landing), "tickers_?00000000.json"), "file_path")


def test_stream_of_plans_takes_each_once(spark, landing, tmp_path):
    plans, table = str(tmp_path / "plans"), TickerTable(spark, str(tmp_path / "table"))
    listed = files.list_files(spark, str(landing), "tickers_?00000000.json").select("file_path")

    def run():
        ingest_plans(spark, plans, table, str(tmp_path / "checkpoint"), multi_line=True, quarantine=str(tmp_path / "bad")).awaitTermination()
        return rows(table.read().select("extraction_timestamp").distinct(), "extraction_timestamp")

    planned.write_plan(listed.filter("file_path LIKE '%1000%'"), f"{plans}/plan=0")
    assert run() == [(100000000,)]
    planned.write_plan(listed.filter("file_path LIKE '%2000%'"), f"{plans}/plan=1")
    planned.write_plan(listed.filter("file_path LIKE '%3000%'"), f"{plans}/plan=2")
    assert run() == run() == [(100000000,), (200000000,), (300000000,)]
    assert table.read().count() == 6
