"""The bitmap index of loaded instants, compaction of closed days, and candles that loads add to."""

import random
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ticklake.operators import backlog, bars, candles, loaded_index
from ticklake.operators.writers import TickerTable
from ticklake.session import write_new

from .conftest import rows

DAY = 86_400_000
BASE = 20_000 * DAY  # 2024-10-04


def pairs(spark, values):
    return spark.createDataFrame(values, "exchange_id string, extraction_timestamp long")


def test_index_equals_anti_join(spark, tmp_path):
    rng = random.Random(1)
    venues = ["a", "b", "ü/c", None]
    instants = [BASE + rng.randrange(3 * DAY) // g * g for g in (1, 1000, 60_000) for _ in range(60)] + [0, 1, 999, 1000, 32_768_000, -1, -1000, -1001, None]
    every = [(v, t) for v in venues for t in instants]
    loads = {f"l-{i}": [p for p in every if rng.random() < 0.3] for i in range(3)}
    index = loaded_index.LoadedIndex(spark, str(tmp_path / "index"))
    manifest = pairs(spark, every).withColumn("snapshot_path", F.lit("x"))
    assert loaded_index.backlog_indexed(manifest, index.read()).count() == backlog.stamped(manifest).count()
    for load_id, values in loads.items():
        index.add(pairs(spark, values + values[:3]), load_id)
    loads["l-1"] = loads["l-1"][:10]  # a repeated load replaces what it noted
    index.add(pairs(spark, loads["l-1"]), "l-1")
    loaded = backlog.loaded_timestamps(pairs(spark, [p for values in loads.values() for p in values]))
    got = loaded_index.backlog_indexed(manifest, index.read())
    assert got.columns == manifest.columns
    assert rows(got) == rows(backlog.backlog_full(manifest, loaded))


def tickers(spark, days, load, symbols=("A", "B")):
    values = [(s, v, BASE + d * DAY + load, float(load)) for d in days for v in ("x", "y z") for s in symbols]
    return spark.createDataFrame(values, "symbol string, exchange_id string, extraction_timestamp long, last double")


def content(table):
    return rows(table.read(), "exchange_id", "symbol", "extraction_timestamp", "last", "date")


def files(path):
    return sorted(str(f) for f in Path(path).rglob("*.parquet") if "/_entries/" not in str(f))


@pytest.fixture
def table(spark, tmp_path):
    table = TickerTable(spark, str(tmp_path / "table"), indexed=True)
    for load in range(4):
        table.append(tickers(spark, [0, 1, 2], load), f"l-{load}")
    table.append(tickers(spark, [0], 9).withColumn("extraction_timestamp", F.lit(None).cast("long")), "l-none")
    return table


CLOSED = date(2024, 10, 6)  # days 0 and 1


def test_compaction_keeps_rows_and_drops_files(spark, table):
    before, many = content(table), len(files(table.path))
    assert table.compact(CLOSED) and content(table) == before
    assert table.vacuum() == 2 * 2 * 4 and content(table) == before
    assert len(files(table.path)) < many
    assert table.compact(CLOSED) is None and content(table) == before  # nothing new
    table.vacuum()
    assert content(table) == before
    assert rows(table.recent(0), "date") == [r for r in rows(table.read(), "date") if r[0] == date(2024, 10, 6)]


def test_crash_before_and_after_the_pointer(spark, table, monkeypatch):
    before = content(table)
    monkeypatch.setattr(TickerTable, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        table.compact(CLOSED)
    assert content(table) == before
    monkeypatch.undo()
    assert table.compact(CLOSED)
    assert content(table) == before  # no vacuum yet: both copies are there, one counts
    with pytest.raises(Exception, match="FileAlreadyExists|already exists"):
        table._switch(0, table._entries(table._pointer()).limit(0))  # a second writer with the same number
    assert content(table) == before
    write_new(spark, f"{table.path}/_pointer/1", "")  # a writer lost before its pointer had a name
    assert content(table) == before
    table.append(tickers(spark, [0, 1, 2], 3), "l-3")
    table.vacuum()
    assert content(table) == before


@pytest.mark.parametrize("vacuumed", [False, True])
def test_repeated_and_late_loads_after_compaction(spark, table, vacuumed):
    table.compact(CLOSED)
    if vacuumed:
        table.vacuum()
    table.append(tickers(spark, [0, 1, 2], 1, ("A", "C")), "l-1")  # again, with another symbol
    table.append(tickers(spark, [1], 7), "l-7")  # late, into a closed day
    want = sorted([r for r in content(table) if r[2] is None], key=str)
    plain = [(v, s, BASE + d * DAY + n, float(n), date.fromordinal(date(2024, 10, 4).toordinal() + d)) for v in ("x", "y z") for n in range(4) for d in range(3) for s in (("A", "C") if n == 1 else ("A", "B"))]
    plain += [(v, s, BASE + DAY + 7, 7.0, date(2024, 10, 5)) for v in ("x", "y z") for s in "AB"]
    assert sorted(content(table), key=str) == sorted(want + plain, key=str)
    table.compact(CLOSED)
    assert sorted(content(table), key=str) == sorted(want + plain, key=str)
    table.vacuum()
    assert sorted(content(table), key=str) == sorted(want + plain, key=str)
    manifest = pairs(spark, [(v, BASE + d * DAY + n) for v in ("x", "y z") for d in range(3) for n in (0, 1, 5, 7)])
    full = backlog.backlog_full(manifest, backlog.loaded_timestamps(table.read()))
    assert rows(loaded_index.backlog_indexed(manifest, table.loaded_index())) == rows(full)
    fresh = TickerTable(spark, table.path, indexed=True)
    fresh.index = loaded_index.LoadedIndex(spark, table.path + "/_loaded_anew")
    assert rows(fresh.loaded_index().select("date")) and rows(loaded_index.backlog_indexed(manifest, fresh.loaded_index())) == rows(full)


def ticks(spark, seed, n=120):
    rng = random.Random(seed)
    values = [
        (seed * 1000 + i, rng.choice("xy"), rng.choice("AB"), BASE + rng.randrange(2 * DAY) // 1000 * 1000, rng.choice([None, 1.0, 2.5, 9.0]), float(rng.randrange(9)))
        for i in range(n)
    ]
    return spark.createDataFrame(values, "tick_id long, exchange_id string, symbol string, ticker_timestamp_ms long, last double, base_volume double")


@pytest.mark.parametrize("order", [(1, 2, 3), (3, 1, 2, 1), (2, 2, 3, 1)])
def test_candles_from_loads_in_any_order(spark, tmp_path, order):
    store = candles.CandleStore(spark, str(tmp_path / "candles"), DAY // 4)
    assert store.read().count() == 0
    for load in order:
        store.add(ticks(spark, load), f"l-{load}")
    every = ticks(spark, 1).unionByName(ticks(spark, 2)).unionByName(ticks(spark, 3))
    assert rows(store.read()) == rows(bars.bars(every, DAY // 4))


def test_candles_of_untouched_days_are_not_rewritten(spark, tmp_path):
    store = candles.CandleStore(spark, str(tmp_path / "candles"), DAY // 4)
    store.add(ticks(spark, 1), "l-1")
    old = {f for f in files(tmp_path) if "/candles/candles/" in f and "date=2024-10-04" in f}
    late = ticks(spark, 2).filter(F.col("ticker_timestamp_ms") >= BASE + DAY)
    assert store.add(late, "l-2") == ["exchange=x/date=2024-10-05", "exchange=y/date=2024-10-05"]
    assert old and old <= set(files(tmp_path))
    assert rows(store.read()) == rows(bars.bars(ticks(spark, 1).unionByName(late), DAY // 4))
    # A load that comes again without any tick takes back what it brought.
    store.add(late.limit(0), "l-2")
    assert rows(store.read()) == rows(bars.bars(ticks(spark, 1), DAY // 4))
    store.add(late.limit(0), "l-1")
    assert store.read().count() == 0
